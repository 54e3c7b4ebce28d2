"""A corpus from raw documents to packed bins; each stage works on what the one before kept.

Stages return all columns of their input, extra ones too, but for the last. Null, empty and very
long texts, null ids, ties and repeated rows are treated as the operator of the
stage says; of rows repeated whole, exact dedup keeps one.  An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.llm.decontamination import drop_contaminated
from siltwork.llm.exact import DigestIndex, drop_copies
from siltwork.llm.near import near_duplicates
from siltwork.llm.packing import pack_documents
from siltwork.llm.shipping import ship
from siltwork.llm.toxicity import keep_civil
from siltwork.shared import write_shared

STAGE_WORDS = 5


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored toxic go; the model learns from the labels of documents that are not held out."""
    ship(spark)
    return keep_civil(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays."""
    ship(spark)
    return drop_copies(docs, DigestIndex(spark))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each group of near-duplicates over five-word shingles stays.

    Rows are decided by a written number, so rows of one id and rows without an id are told apart.
    """
    ship(spark)
    docs = write_shared(docs.withColumn("__sw_row", F.monotonically_increasing_id()), "numbered")
    groups = near_duplicates(docs, id_col="__sw_row", width=STAGE_WORDS).selectExpr("doc_id AS __sw_row", "component_id AS __sw_group")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__sw_row"))["__sw_row"].alias("__sw_row")
    kept = docs.select("doc_id", "__sw_row").join(groups, "__sw_row").groupBy("__sw_group").agg(first)
    kept = write_shared(kept.select("__sw_row"), "decisions")
    return docs.join(kept, "__sw_row", "left_semi").drop("__sw_row")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    ship(spark)
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A bin and a place in it for every byte of every document."""
    ship(spark)
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact_dedup),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packing),
]

# Learned scores, iterated components and a greedy packing: not for SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_shared(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return docs
