"""Tables written to the folder every executor can reach.

A step that must see the same rows twice (numbering rows in order, for one)
writes them once and reads them back.  The written table also cuts lineage, so
a lost executor costs a re-read and not a recomputation with other sampled
range bounds.  The folder is the one the cluster names in
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

FOLDER_SETTING = "spark.checkpoint.dir"

_local_folders: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder of this application below ``spark.checkpoint.dir``.

    Where the setting is missing, a local-mode session gets a temporary folder
    of its own; any other master must name one, because a machine-local path
    would not be visible to the executors.
    """
    app_id = spark.sparkContext.applicationId
    folder = spark.conf.get(FOLDER_SETTING, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {FOLDER_SETTING} to a folder all executors share")
        if app_id not in _local_folders:
            _local_folders[app_id] = tempfile.mkdtemp(prefix="siltwork-")
        folder = _local_folders[app_id]
    return f"{folder.rstrip('/')}/siltwork/{app_id}"


def shared_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def write_shared(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet and return the written table."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete every table this application wrote through :func:`write_shared`."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(shared_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
