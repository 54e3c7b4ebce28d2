"""What has been processed of a published table: whole folders by part, and single rows in the others.

A part whose folders are all done is finished: it is in no plan, and costs the ledger a line.  Rows that are
processed one by one are kept as ids until their folder has none left; then the folder is done and
the ids go, so that the ledger stays as small as what is in the open.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltwork.operators.keyed import KeyedTable
from siltwork.published import PART, Manifest, Published
from siltwork.shared import write_shared

FOLDER = "_folder"


def open_folders(held: Manifest, done: Mapping[str, list[str]]) -> dict[str, list[str]]:
    """Of each part that is not finished, the folders that are not done."""
    left = {part: [f for f in folders if f not in set(done.get(part, []))] for part, folders in held.parts.items()}
    return {part: folders for part, folders in left.items() if folders}


def read_folders(source: Published, held: Manifest, folders: Mapping[str, list[str]]) -> DataFrame:
    return source.read_parts(Manifest(held.version, held.schema, dict(folders), {}), folders)


class Ledger:
    """The ledger at ``path`` of one published table, whose rows ``id_col`` names."""

    def __init__(self, spark: SparkSession, path: str, id_col: str = "id"):
        self.spark, self.id_col = spark, id_col
        self.marks = Published(spark, f"{path}/marks")
        self.singles = KeyedTable(spark, f"{path}/singles", [id_col], buckets=16)

    def done(self) -> dict[str, list[str]]:
        held = self.marks.manifest()
        return held.notes["done"] if held else {}

    def _single_ids(self, held: Manifest) -> DataFrame:
        self.singles.open(StructType([held.schema[self.id_col]]))
        return self.singles.read().select(self.id_col)

    def waiting(self, source: Published) -> DataFrame:
        """Rows that are not processed; finished parts and done folders are not read."""
        held = source.manifest()
        rows = read_folders(source, held, open_folders(held, self.done()))
        return rows.join(self._single_ids(held), self.id_col, "left_anti").select(*held.schema.names)

    def marked(self, source: Published, status_col: str, status: str) -> DataFrame:
        """All rows, those processed with ``status``; rows of done folders are joined with nothing."""
        held, done = source.manifest(), self.done()
        left = open_folders(held, done)
        over = {part: [f for f in folders if f not in set(left.get(part, []))] for part, folders in held.parts.items()}
        finished = read_folders(source, held, over).withColumn(status_col, F.lit(status))
        ids = self._single_ids(held).withColumn("_single", F.lit(True))
        rows = read_folders(source, held, left).join(ids, self.id_col, "left")
        rows = rows.withColumn(status_col, F.when(F.col("_single"), status).otherwise(F.col(status_col)))
        return finished.select(*held.schema.names).unionByName(rows.select(*held.schema.names))

    def mark(self, source: Published, ids: DataFrame) -> None:
        """Single rows are processed; null ids and ids that are marked already change nothing."""
        held = source.manifest()
        self._single_ids(held)
        self.singles.insert_ignore(ids.select(self.id_col).where(F.col(self.id_col).isNotNull()).distinct())
        self._compact(source, held)

    def finish(self, held: Manifest) -> None:
        """Everything in this version of the source is processed."""
        self._commit_done(held.parts)
        self._keep_singles(self.singles.table.manifest(), None)

    def _commit_done(self, done: Mapping[str, list[str]]) -> None:
        before = self.marks.manifest()
        schema = before.schema if before else self.spark.range(0).schema
        self.marks.commit(before, schema, {}, {}, {"done": dict(done)})

    def _compact(self, source: Published, held: Manifest) -> None:
        """Folders of which no row waits are done, and ids of rows in them go.

        Done folders are committed first: were the writer lost before the ids went, they would name rows nobody reads.
        """
        done = self.done()
        left = open_folders(held, done)
        rows = read_folders(source, held, left).select(self.id_col, F.regexp_extract(F.input_file_name(), rf"(data/[^/]+/{PART}=[^/]+)/", 1).alias(FOLDER))
        waits = rows.join(self._single_ids(held), self.id_col, "left_anti").select(FOLDER).distinct().collect()  # a row for each folder at most
        waits = {r[FOLDER] for r in waits}
        over = {part: [f for f in folders if f not in waits] for part, folders in left.items()}
        over = {part: folders for part, folders in over.items() if folders}
        if not over:
            return
        self._commit_done({part: [*done.get(part, []), *over.get(part, [])] for part in {**done, **over}})
        still = rows.where(F.col(FOLDER).isin(sorted(waits))).select(self.id_col) if waits else None
        self._keep_singles(self.singles.table.manifest(), still)

    def _keep_singles(self, held: Manifest | None, still: DataFrame | None) -> None:
        """Keep the single ids of the rows in ``still``; none without it."""
        if held is None:
            return
        if still is None:
            self.singles.table.commit(held, held.schema, {}, {}, held.notes)
            return
        kept = write_shared(self.singles.read().join(still, self.id_col, "left_semi"), "single-ids")
        parts, rows = self.singles.table.stage(kept, self.singles.bucket(held.notes["buckets"]))
        self.singles.table.commit(held, held.schema, parts, rows, held.notes)
