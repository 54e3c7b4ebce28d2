"""Tables with a key whose changes touch only the buckets that hold a changed key.

A bucket is a part of a :class:`siltwork.published.Published` table, chosen by a hash of the key.  An upsert reads and
rewrites the buckets its source falls in, an insert reads their keys and adds a folder to them; all other buckets keep
their files and are in no plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltwork.operators.keys import number_rows
from siltwork.operators.merge import one_per_key
from siltwork.published import Manifest, Published, fit
from siltwork.shared import write_shared

BUCKETS, MOST_BUCKETS = 64, 1 << 17
ROWS_PER_BUCKET = 4_000_000
FOLDERS_PER_BUCKET = 16


class KeyedTable:
    """A published table with one row a key.

    ``buckets`` is the number to begin with.  With ``span``, whole-number keys of one run of that length share a
    bucket, so that a source of neighbouring keys (the newest orders, say) touches few.  Beyond ``rows_per_bucket`` rows in the largest bucket the table is dealt
    anew over twice as many or more, so that the work of all such steps stays in proportion to the rows; a
    bucket of more than ``folders_per_bucket`` folders is rewritten as one.  Rows with a null in the key never
    conflict and all stay, unless ``nulls_equal``.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: Sequence[str],
        buckets: int = BUCKETS,
        rows_per_bucket: int = ROWS_PER_BUCKET,
        folders_per_bucket: int = FOLDERS_PER_BUCKET,
        nulls_equal: bool = False,
        span: int | None = None,
    ):
        if span is not None and len(key) != 1:
            raise ValueError("span needs a single key column")
        self.span = span
        self.spark, self.table, self.key = spark, Published(spark, path), list(key)
        self.buckets, self.rows_per_bucket, self.folders_per_bucket = buckets, rows_per_bucket, folders_per_bucket
        self.nulls_equal = nulls_equal

    def read(self) -> DataFrame:
        return self.table.read()

    def bucket(self, buckets: int) -> Column:
        hashed = F.xxhash64(*self.key) if self.span is None else F.xxhash64(F.floor(F.col(self.key[0]) / self.span))
        return F.pmod(hashed, F.lit(buckets)).cast("string")

    def open(self, schema: StructType) -> Manifest:
        """The latest version; an empty one where there is none."""
        held = self.table.manifest()
        if held is None:
            held = self.table.commit(None, schema, {}, {}, {"buckets": self.buckets})
        return held

    def touched(self, held: Manifest, rows: DataFrame) -> list[str]:
        """Buckets that ``rows`` fall in; as many as there are buckets at most."""
        return sorted(r[0] for r in rows.select(self.bucket(held.notes["buckets"])).distinct().collect())

    def same_key(self, left: DataFrame, right: DataFrame) -> Column:
        pairs = [(left[k], right[k]) for k in self.key]
        return reduce(and_, (a.eqNullSafe(b) if self.nulls_equal else a == b for a, b in pairs))

    def _keyed_once(self, held: Manifest, source: DataFrame, order_by: Sequence[str], latest: bool, on_duplicate: str) -> DataFrame:
        """Source rows in the table's columns, one a key, written: they are read several times."""
        fitted = fit(source, held.schema)
        if self.nulls_equal:
            return write_shared(fitted.dropDuplicates(self.key), "incoming")
        return write_shared(one_per_key(fitted, self.key, order_by, latest, on_duplicate), "incoming")

    def upsert(self, source: DataFrame, order_by: Sequence[str] = (), on_duplicate: str = "choose", **notes: Any) -> list[str]:
        """Replace rows of the source's keys and add the others; the buckets that were rewritten.

        Of a key repeated in the source its last row in ``order_by`` is used, or the job fails
        with ``on_duplicate="fail"``.
        """
        held = self.open(source.schema)
        incoming = self._keyed_once(held, source, order_by, True, on_duplicate)
        touched = self.touched(held, incoming)
        if not touched:
            return []
        old = self.table.read_parts(held, touched)
        kept = old.join(incoming.select(*self.key), self.same_key(old, incoming), "left_anti")
        parts, rows = self.table.stage(kept.unionByName(incoming), self.bucket(held.notes["buckets"]))
        self._settle(self.table.commit(held, held.schema, {**held.parts, **parts}, {**held.rows, **rows}, {**held.notes, **notes}))
        return touched

    def insert_ignore(self, source: DataFrame, order_by: Sequence[str] = (), **notes: Any) -> DataFrame:
        """Add source rows whose key is new, the first of a key in ``order_by``; these rows.

        Of the table only the keys in the buckets that the source falls in are read.
        """
        held = self.open(source.schema)
        return self.add(held, self._keyed_once(held, source, order_by, False, "choose"), **notes)

    def fresh(self, held: Manifest, incoming: DataFrame) -> DataFrame:
        old = self.table.read_parts(held, self.touched(held, incoming)).select(*self.key)
        return incoming.join(old, self.same_key(incoming, old), "left_anti")

    def add(self, held: Manifest, incoming: DataFrame, **notes: Any) -> DataFrame:
        """Add the rows of ``incoming`` (one a key, written) whose key is new; these rows."""
        parts, rows = self.table.stage(self.fresh(held, incoming), self.bucket(held.notes["buckets"]))
        added = self.table.read_parts(Manifest(0, held.schema, parts, rows), parts)
        both = {p: held.parts.get(p, []) + parts.get(p, []) for p in {**held.parts, **parts}}
        counts = {p: held.rows.get(p, 0) + rows.get(p, 0) for p in both}
        if parts or notes:
            self._settle(self.table.commit(held, held.schema, both, counts, {**held.notes, **notes}))
        return added

    def _settle(self, held: Manifest) -> None:
        """Deal anew over more buckets where one is too large, and rewrite buckets of many folders."""
        buckets = held.notes["buckets"]
        largest = max(held.rows.values(), default=0)
        if largest > self.rows_per_bucket and buckets < MOST_BUCKETS:
            while buckets < MOST_BUCKETS and sum(held.rows.values()) > buckets * self.rows_per_bucket // 2:
                buckets *= 2
            buckets = max(buckets, 2 * held.notes["buckets"])
            parts, rows = self.table.stage(self.table.read_parts(held, held.parts), self.bucket(buckets))
            self.table.commit(held, held.schema, parts, rows, {**held.notes, "buckets": buckets})
            return
        many = [p for p, folders in held.parts.items() if len(folders) > self.folders_per_bucket]
        if many:
            parts, rows = self.table.stage(self.table.read_parts(held, many), self.bucket(buckets))
            self.table.commit(held, held.schema, {**held.parts, **parts}, {**held.rows, **rows}, held.notes)


class KeyMap:
    """Surrogate ids that stay: a natural key keeps the id it was given first.

    New keys get the ids after the highest one, in key order; null is a key like others.  The highest id stands in the
    manifest, so no table is scanned for it, and keys that were given ids by a writer that was lost before its
    commit get them again.
    """

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str] = ("name",), id_col: str = "id", **options: Any):
        self.key, self.id_col = list(key), id_col
        self.held = KeyedTable(spark, path, key, nulls_equal=True, **options)

    def assign(self, rows: DataFrame) -> DataFrame:
        """Give ids to the keys in ``rows`` that have none; the map, as :meth:`read`."""
        names = write_shared(rows.select(*self.key).distinct(), "names")
        schema = names.withColumn(self.id_col, F.lit(0).cast("long")).schema
        manifest = self.held.open(schema)
        fresh = self.held.fresh(manifest, fit(names, StructType(manifest.schema.fields[:-1])))
        last = manifest.notes.get("last_id", 0)
        numbered = number_rows(fresh, self.key, self.id_col).withColumn(self.id_col, F.col(self.id_col) + last)
        written = write_shared(numbered, "numbered")
        count = written.count()
        if count:
            self.held.add(manifest, written, last_id=last + count)
        return self.read()

    def read(self) -> DataFrame:
        return self.held.read().select(self.id_col, *self.key)


class KeyIndex:
    """Keys of all batches so far, to find those that repeat over batches."""

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], **options: Any):
        self.key = list(key)
        self.held = KeyedTable(spark, path, key, **options)

    def register(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """``key``, ``copies`` in this batch, ``first_batch`` and ``repeated`` for each key of the batch; new keys are kept.

        A key is repeated when the batch holds it twice or an earlier batch has it.  Rows with a null in the key
        never conflict and are not listed.  A batch that is registered again gets the answers it got first.
        """
        keys = batch.where(reduce(and_, (F.col(k).isNotNull() for k in self.key))).groupBy(*self.key).agg(F.count("*").alias("copies"))
        manifest = self.held.open(keys.select(*self.key, F.lit(batch_id).cast("long").alias("first_batch")).schema)
        incoming = write_shared(keys.withColumn("first_batch", F.lit(batch_id).cast("long")), "batch-keys")
        seen = self.held.table.read_parts(manifest, self.held.touched(manifest, incoming)).withColumnRenamed("first_batch", "_first")
        self.held.add(manifest, fit(incoming, manifest.schema))
        known = incoming.join(seen, self.key, "left")
        first = F.coalesce(F.least("_first", "first_batch"), F.col("first_batch"))
        return known.select(*self.key, "copies", first.alias("first_batch"), ((F.col("copies") > 1) | (first < batch_id)).alias("repeated"))
