"""Tables as versions: folders of Parquet files, and a manifest that names the folders of a version.

A change writes its rows below ``data`` first and then one manifest, by a rename that fails where the
version is there already.  A reader takes the highest manifest, so it sees the version before a change or the one
after it, whole, at whatever step the writer is lost.  Of two writers that start from one version, the second to
commit gets :class:`Conflict` and changes nothing.

Rows are filed under parts (days, buckets), each a list of folders; a change names new folders for the
parts it touches and leaves the files of all others as they are.  The driver holds one manifest: a line for each part.

The file system must rename atomically, as Spark's own stream checkpoints need it too.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PART = "__sw_part"
WHOLE = "all"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # the name Spark's writer gives a null part
DIGITS = 12
KEPT_VERSIONS, GRACE_SECONDS = 2, 24 * 3600


class Conflict(RuntimeError):
    """Another writer has committed a version since this change began."""


@dataclass(frozen=True)
class Manifest:
    version: int
    schema: StructType
    parts: dict[str, list[str]]
    rows: dict[str, int]
    notes: dict[str, Any] = field(default_factory=dict)


class Files:
    """The few file calls a manifest needs, through the file system Spark itself uses."""

    def __init__(self, spark: SparkSession, base: str):
        self._jvm, self._gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._fs = self._path(base).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> dict[str, int]:
        """Names in a folder with their times of change in milliseconds; none where there is no folder."""
        where = self._path(folder)
        if not self._fs.exists(where):
            return {}
        return {s.getPath().getName(): s.getModificationTime() for s in self._fs.listStatus(where)}

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        stream = self._fs.create(self._path(path), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def rename_new(self, source: str, target: str) -> bool:
        """Rename in one step; False where the target is there already."""
        fs = self._jvm.org.apache.hadoop.fs
        context = fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        options = self._gateway.new_array(getattr(fs, "Options$Rename"), 0)
        try:
            context.rename(self._path(source), self._path(target), options)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


class Published:
    """A versioned table below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.files = Files(spark, self.path)

    def _manifest_path(self, version: int) -> str:
        return f"{self.path}/manifests/{version:0{DIGITS}}.json"

    def versions(self) -> list[int]:
        return sorted(int(n.split(".")[0]) for n in self.files.names(f"{self.path}/manifests") if n.endswith(".json") and not n.startswith((".", "_")))

    def manifest(self, version: int | None = None) -> Manifest | None:
        """The given version, or the latest; None where nothing was published."""
        if version is None:
            version = max(self.versions(), default=None)
            if version is None:
                return None
        held = json.loads(self.files.read(self._manifest_path(version)))
        return Manifest(version, StructType.fromJson(held["schema"]), held["parts"], held["rows"], held["notes"])

    def stage(self, df: DataFrame, part: Column | None = None) -> tuple[dict[str, list[str]], dict[str, int]]:
        """Write rows that no reader sees yet; folders and row counts by part.

        Rows are rebalanced by part, where adaptive execution splits a part that holds many.
        """
        folder = f"data/{uuid.uuid4().hex}"
        if part is None:  # written as it is, so that an empty result is a folder too
            whole = f"{folder}/{PART}={WHOLE}"
            df.write.parquet(f"{self.path}/{whole}")
            return {WHOLE: [whole]}, {WHOLE: self.spark.read.schema(df.schema).parquet(f"{self.path}/{whole}").count()}
        named = df.withColumn(PART, part.cast("string")).hint("rebalance", PART)
        named.write.partitionBy(PART).parquet(f"{self.path}/{folder}")
        written = [n for n in self.files.names(f"{self.path}/{folder}") if n.startswith(f"{PART}=")]
        if not written:
            return {}, {}
        counted = self.spark.read.parquet(f"{self.path}/{folder}").groupBy(F.col(PART).cast("string").alias("part")).count().collect()  # a row a part
        rows = {NO_VALUE if r["part"] is None else r["part"]: r["count"] for r in counted}
        return {n.partition("=")[2]: [f"{folder}/{n}"] for n in written}, rows

    def commit(
        self,
        base: Manifest | None,
        schema: StructType,
        parts: Mapping[str, list[str]],
        rows: Mapping[str, int],
        notes: Mapping[str, Any] | None = None,
    ) -> Manifest:
        """Make a version out of staged folders: the one that follows ``base``."""
        version = base.version + 1 if base else 1
        text = json.dumps({"schema": schema.jsonValue(), "parts": dict(parts), "rows": dict(rows), "notes": dict(notes or {})})
        draft = f"{self.path}/drafts/{uuid.uuid4().hex}.json"
        target = self._manifest_path(version)
        self.files.write(draft, text)
        if base is None:
            self.files.write(f"{self.path}/manifests/_folder", "")
        if not self.files.rename_new(draft, target):
            self.files.delete(draft)
            raise Conflict(f"version {version} of {self.path} was committed by another writer")
        return self.manifest(version)

    def read(self, parts: Iterable[str] | None = None, version: int | None = None) -> DataFrame:
        """Rows of the latest or the given version, of some parts or all; only their files are in the plan."""
        held = self.manifest(version)
        if held is None:
            raise ValueError(f"nothing was published at {self.path}")
        return self.read_parts(held, held.parts if parts is None else parts)

    def read_parts(self, held: Manifest, parts: Iterable[str]) -> DataFrame:
        folders = [f"{self.path}/{f}" for p in parts for f in held.parts.get(p, [])]
        if not folders:
            return self.spark.createDataFrame([], held.schema)
        return self.spark.read.schema(held.schema).parquet(*folders)

    def replace(self, df: DataFrame, **notes: Any) -> Manifest:
        """A version that holds the rows of ``df`` alone, which may read the version before."""
        base = self.manifest()
        parts, rows = self.stage(df)
        return self.commit(base, df.schema, parts, rows, {**(base.notes if base else {}), **notes})

    def append(self, df: DataFrame, part: Column | None = None, **notes: Any) -> Manifest:
        """A version with the rows of ``df`` added under their parts; no file that is there is read."""
        base = self.manifest()
        parts, rows = self.stage(df if base is None else fit(df, base.schema), part)
        schema = base.schema if base else df.schema
        held, counts = (base.parts, base.rows) if base else ({}, {})
        both = {p: held.get(p, []) + parts.get(p, []) for p in [*held, *(p for p in parts if p not in held)]}
        sums = {p: counts.get(p, 0) + rows.get(p, 0) for p in both}
        return self.commit(base, schema, both, sums, {**(base.notes if base else {}), **notes})

    def expire(self, keep: int = KEPT_VERSIONS, grace_seconds: float = GRACE_SECONDS) -> int:
        """Drop all versions but the last ``keep``, and folders that none of these names; how many folders went.

        Folders younger than ``grace_seconds`` stay: a writer may be about to commit them.
        """
        versions = self.versions()
        for version in versions[:-keep]:
            self.files.delete(self._manifest_path(version))
        named = {f.split("/")[1] for v in versions[-keep:] for folders in self.manifest(v).parts.values() for f in folders}
        before = (time.time() - grace_seconds) * 1000
        gone = [n for n, changed in self.files.names(f"{self.path}/data").items() if n not in named and changed <= before]
        for name in gone:
            self.files.delete(f"{self.path}/data/{name}")
        for name, changed in self.files.names(f"{self.path}/drafts").items():
            if changed <= before:
                self.files.delete(f"{self.path}/drafts/{name}")
        return len(gone)


def publish(df: DataFrame, table: str, path: str | None = None) -> Manifest:
    """Make ``df`` the content of a catalog table, in one step for its readers.

    The rows become a version of the published table at ``path`` (beside the warehouse's tables where none is
    given), and then the catalog's location of ``table`` is set to that version's folder.  The name exists throughout, and a
    writer lost at any step leaves the version before.  ``df`` may read the table it replaces.
    """
    spark = df.sparkSession
    held = Published(spark, path or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table}__versions")
    known = spark.catalog.tableExists(table)
    if known and [(f.name, f.dataType) for f in spark.table(table).schema] != [(f.name, f.dataType) for f in df.schema]:
        raise ValueError(f"{table} has other columns; publish them under a new name")
    made = held.replace(df)
    location = f"{held.path}/{made.parts[WHOLE][0]}"
    if known:
        quoted = location.replace("'", "\\'")
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{quoted}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path=location, source="parquet", schema=df.schema)
    return made


def fit(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema``, in its order and types; other columns go, a missing one is an error."""
    return df.select(*(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields))
