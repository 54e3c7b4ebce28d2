"""Repeated lines: windows of three lines that stand elsewhere too are removed where they come later."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwork.shared import write_shared

WINDOW = 3


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW) -> DataFrame:
    """``doc_id``, ``n_lines``, ``removed_lines``, ``text`` for each row.

    Lines end at line feeds; they are compared without spaces, tabs and carriage
    returns at their ends, and blank lines are skipped when windows are formed.  Of the places of a window of
    ``width`` lines, the first stays: smallest id (null last), then text checksum,
    then line.  Lines covered by a later place are removed, and blank lines
    with them where they stand between two covered ones of a window, but not what the first place
    of the same window in the same text covers, so a run of equal lines leaves
    ``width`` of them.  Other first places do not protect a line.

    Null texts stay null with 0 lines; texts of fewer than ``width`` lines stay
    as they are.  Rows repeated whole count as one text and come out alike.
    Extra columns are not read.

    What is shuffled for windows is a hash and a place for each; the windows
    found once are dropped first.  Texts move only to meet their removals.
    """
    text = F.coalesce(text_col, F.lit(""))
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text, F.lit(3)).alias("mark"))
    trimmed = F.transform(F.split("text", "\n", -1), lambda line, i: F.struct(F.btrim(line, F.lit(" \t\r")).alias("line"), i.alias("at")))
    full = F.filter(trimmed, lambda x: x["line"] != "")
    windows = F.transform(
        F.when(F.size("full") >= width, F.sequence(F.lit(0), F.size("full") - width)),
        lambda i: F.struct(
            F.xxhash64(*[F.col("full")[i + k]["line"] for k in range(width)]).alias("a"),
            F.xxhash64(F.lit(1), *[F.col("full")[i + k]["line"] for k in range(width)]).alias("b"),
            F.col("full")[i]["at"].alias("first"),
            F.col("full")[i + width - 1]["at"].alias("last"),
        ),
    )
    lined = docs.select("doc_id", "mark", full.alias("full"))
    places = lined.select("doc_id", "mark", F.explode(windows).alias("w")).select("doc_id", "mark", "w.*")
    places = write_shared(places, "windows")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark", "first", "last")
    seen = places.groupBy("a", "b").agg(F.min(order).alias("lead"), F.count("*").alias("places")).where("places > 1")
    seen = write_shared(seen.select("a", "b", *[F.col(f"lead.{c}").alias(f"lead_{c}") for c in ("doc_id", "mark", "first", "last")]), "repeats")
    found = places.join(seen, ["a", "b"])
    own = F.col("doc_id").eqNullSafe(F.col("lead_doc_id")) & (F.col("mark") == F.col("lead_mark"))
    later = found.where(~(own & (F.col("first") == F.col("lead_first"))))
    # what the first place covers in the same text stays
    start = F.when(own, F.greatest(F.col("first"), F.col("lead_last") + 1)).otherwise(F.col("first"))
    covered = later.select("doc_id", "mark", start.alias("first"), "last").where("first <= last").distinct()
    covered = covered.groupBy("doc_id", "mark").agg(F.collect_list(F.sequence("first", "last")).alias("runs"))
    merged = F.array_distinct(F.flatten("runs"))
    covered = write_shared(covered.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), merged.alias("gone")), "removals")
    # one way at every size: removals grow with the input, so they are not broadcast
    out = docs.join(covered.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")), "left")
    # lines are split once for a text, and places compared by hash: linear in the lines of a text
    kept = F.transform(
        F.array(F.split("text", "\n", -1)),
        lambda lines: F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "gone"), lambda i: lines[i]),
    )[0]
    clean = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return out.select(
        "doc_id",
        F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n", -1))).alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).alias("removed_lines"),
        clean.alias("text"),
    )
