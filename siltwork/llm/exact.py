"""Exact duplicates against a persistent digest index."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.operators.keys import COPY, tell_copies_apart
from siltwork.published import Manifest, Published
from siltwork.shared import shared_path, write_shared

SPACES = " \t\n\x0b\f\r"
BUCKETS, MOST_BUCKETS = 64, 100_000
BUCKET_ROWS = 2_000_000  # at about 100 bytes
BUCKET_FILES = 16


def normalised(text: Column) -> Column:
    """The text without space and tab to carriage return; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


class DigestIndex:
    """Digests seen so far, as a table bucketed and sorted by digest.

    The files below ``path`` outlast the session; opening the path again
    registers them, with the folder and the number of buckets noted in a manifest there.  A new index gets
    ``buckets``, or else one for each ``bucket_rows`` digests of the first batch
    and ``BUCKETS`` at least.  ``absorb`` holds a batch against the index by a sort-merge
    anti-join on the buckets and appends what is new.  Where a batch would bring more than ``bucket_rows`` digests to a
    bucket, or its file would be more than the ``BUCKET_FILES``th of a bucket, the index is written anew first, in twice as
    many buckets or more, or as many: one file a bucket, in a folder that the manifest names once it is
    whole.  A batch that is replayed after its append gets the same answers.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None, bucket_rows: int = BUCKET_ROWS):
        self.spark = spark
        self.path = path or shared_path(spark, "digest-index")
        self.buckets, self.bucket_rows = buckets, bucket_rows
        self.layout = Published(spark, f"{self.path}/layout")
        self.table = ""

    def _register(self, folder: str, buckets: int) -> str:
        """The catalog's name of the digests in a folder."""
        where = f"{self.path}/{folder}"
        name = f"digests_{hashlib.md5(where.encode()).hexdigest()}"
        quoted = where.replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (digest STRING, keep_id BIGINT, points BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{quoted}'"
        )
        return name

    def _note(self, held: Manifest | None, **notes: object) -> Manifest:
        schema = held.schema if held else self.spark.range(0).schema
        return self.layout.commit(held, schema, {}, {}, {**(held.notes if held else {}), **notes})

    def _insert(self, rows: DataFrame, table: str, buckets: int) -> None:
        # By the bucket itself, so a bucket gets one file however many tasks write; the writer sorts.
        bucket = F.pmod(F.hash("digest"), F.lit(buckets))
        rows.repartitionByRange(buckets, bucket).write.insertInto(table)

    def open(self, digests: int = 0) -> None:
        """Register the table, with room for about that many digests more."""
        held = self.layout.manifest()
        if held is None:
            buckets = self.buckets or min(max(BUCKETS, -(-digests // self.bucket_rows)), MOST_BUCKETS)
            held = self._note(None, buckets=buckets, folder="digests", rows=0, batches=0)
        buckets, rows = held.notes["buckets"], held.notes["rows"]
        self.table = self._register(held.notes["folder"], buckets)
        wanted = min(-(-(rows + digests) // self.bucket_rows), MOST_BUCKETS)
        if rows and (wanted > buckets or held.notes["batches"] >= BUCKET_FILES):
            while buckets < wanted:
                buckets *= 2
            folder = f"digests-{held.version}-{uuid.uuid4().hex}"
            table = self._register(folder, buckets)
            self._insert(self.read().distinct(), table, buckets)
            self._note(held, buckets=buckets, folder=folder, batches=1)
            self.table = table
        self.buckets = buckets

    def read(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def absorb(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` for each row, and new digests appended.

        Texts are equal when their normalised forms are.  Of equal texts new to
        the index, the row with the most code points in its original text
        stays, then the smallest id, null last; where the index has the text, its row
        stays.  Of rows repeated whole, one stays.  Null and empty texts are
        equal.  ``group_size`` counts rows of this batch.  Extra columns are not read.
        """
        text = F.coalesce(text_col, F.lit(""))
        narrow = docs.select(
            F.col(id_col).alias("doc_id"),
            F.sha2(normalised(F.col(text_col)), 256).alias("digest"),
            F.char_length(text).cast("bigint").alias("points"),
        )
        # Written first: telling copies apart reads its input twice, and texts are to be read and hashed once.
        rows = write_shared(tell_copies_apart(write_shared(narrow, "hashed")), "digests")
        best = F.min(F.struct((-F.col("points")).alias("points"), F.col("doc_id").isNull().alias("no_id"), "doc_id"))
        groups = rows.groupBy("digest").agg(best.alias("best"), F.count("*").alias("group_size"))
        groups = groups.select("digest", "group_size", F.col("best.doc_id").alias("keep_id"), (-F.col("best.points")).alias("points"))
        groups = write_shared(groups, "groups")
        self.open(groups.count())
        new = groups.select("digest", "keep_id", "points").join(self.read().hint("merge").select("digest"), "digest", "left_anti")
        new = write_shared(new, "new")
        fresh = new.count()
        if fresh:
            self._insert(new, self.table, self.buckets)
            held = self.layout.manifest()
            self._note(held, rows=held.notes["rows"] + fresh, batches=held.notes["batches"] + 1)
        stays = groups.select("digest", "group_size").join(self.read().hint("merge"), "digest")
        stays = write_shared(stays.withColumnRenamed("points", "_most"), "stays")
        kept = (F.col(COPY) == 1) & F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("_most"))
        return rows.join(stays, "digest").select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.col("digest").alias("text_sha256"))


def drop_copies(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they came; see :meth:`DigestIndex.absorb`."""
    id_, digest = "__sw_id", "__sw_digest"
    said = index.absorb(docs, id_col, text_col).groupBy(F.col("doc_id").alias(id_), F.col("text_sha256").alias(digest))
    said = write_shared(said.agg(F.max("kept").alias("kept"), F.count("*").alias("rows")), "decisions")
    gone = said.where(~F.col("kept")).select(id_, digest)
    twice = said.where(F.col("kept") & (F.col("rows") > 1)).select(id_, digest)
    marked = docs.withColumn("__sw_key", F.sha2(normalised(F.col(text_col)), 256))
    same = F.col(id_col).eqNullSafe(F.col(id_)) & (F.col("__sw_key") == F.col(digest))
    columns = [f"`{c.replace('`', '``')}`" for c in docs.columns]
    if twice.isEmpty():
        return marked.join(gone, same, "left_anti").select(*columns)
    # Rows of one id whose texts differ in white space only count as one text; the longest of them stays, then any one.
    once = marked.join(twice, same, "left_semi").withColumn("__sw_row", F.monotonically_increasing_id())
    once = write_shared(once, "repeated")
    rest = marked.join(gone.unionByName(twice), same, "left_anti")
    longest = F.max(F.struct(F.char_length(F.coalesce(text_col, F.lit(""))).alias("n"), F.col("__sw_row").alias("row")))["row"].alias("__sw_row")
    stays = once.groupBy(id_col, "__sw_key").agg(longest).select("__sw_row")
    return rest.select(*columns).unionByName(once.join(stays, "__sw_row", "left_semi").select(*columns))
