"""Benchmark questions in documents, re-worded in their numbers, names and units too.

Words become templates: numbers, names and units turn into typed placeholders,
other words stay.  Windows of template words are hash-joined between documents
and benchmark, and what the placeholders stood for is compared: one value in the
benchmark must stand for one value in the document throughout.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltwork.llm import words as W
from siltwork.shared import write_shared

WINDOW = 8
LITERALS = 4
COVERAGE = 0.5
CONSISTENT = 0.8
ENOUGH = 6  # windows that tell whatever the length of the item: 13 words in a row
INDEX_WINDOWS = 4_000_000  # at 8 bytes: what is sent to executors has 32 MB at most

# Units of measure, in lower case.
UNITS = """
    mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers
    g kg mg lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons
    s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years
    l ml liter liters litre litres gallon gallons percent degree degrees mph kmh dollar dollars euro euros cent cents usd eur
""".split()

DIGIT = np.zeros(256, bool)
DIGIT[ord("0") : ord("9") + 1] = True
PART = W.LETTER | DIGIT
UPPER = np.zeros(256, bool)
UPPER[ord("A") : ord("Z") + 1] = True
STOP = np.zeros(256, bool)
STOP[[ord(c) for c in ".!?:;\n"]] = True
NUMBER, NAME, UNIT = (np.uint64(k) for k in (0x51ED270B, 0x2545F491, 0x9E6C63D0))


def _literal_hashes(words: list[str]) -> np.ndarray:
    raw = np.frombuffer(" ".join(words).encode(), np.uint8)
    starts, ends, _ = W.runs(PART[raw], np.array([0, len(raw)]))
    return np.sort(W.run_hashes(W.PLAIN_VALUES[W.lowered(raw)], starts, ends))


UNIT_HASHES = _literal_hashes(UNITS)


def _capital(raw: np.ndarray, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """True where a capital letter stands at a byte: ASCII, or Latin as UTF-8 writes it with 0xC3."""
    low = raw[np.minimum(at + 1, ends - 1)]
    return UPPER[raw[at]] | ((raw[at] == 0xC3) & (low >= 0x80) & (low <= 0x9E) & (low != 0x97))


def templates(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Template word hashes, hashes of what stands there, and first word of each row.

    A word is a run of letters and digits.  Words that begin with a digit are numbers
    (points and commas inside a number part it); a word that begins with a
    capital, goes on without one and does not begin a sentence is a name, and a
    run of names is one; a unit word after a number is a unit.
    """
    starts, ends, first = W.runs(PART[raw], offsets)
    values = W.PLAIN_VALUES[W.lowered(raw)]
    actual = W.run_hashes(values, starts, ends)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    number = DIGIT[raw[starts]]
    capital = _capital(raw, starts, ends)
    after = starts + np.where(raw[starts] >= 0xC0, 2, 1)
    capital &= (after < ends) & ~_capital(raw, np.minimum(after, ends - 1), ends)
    stops = np.concatenate([[0], np.cumsum(STOP[raw])])
    gap_from = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    begins = stops[starts] > stops[np.minimum(gap_from, starts)]
    begins[np.unique(first[:-1][np.diff(first) > 0])] = True
    name = capital & ~begins & ~number
    after_number = np.zeros(len(starts), bool)
    after_number[1:] = number[:-1] & (rows[1:] == rows[:-1])
    at = np.minimum(np.searchsorted(UNIT_HASHES, actual), len(UNIT_HASHES) - 1)
    unit = after_number & (UNIT_HASHES[at] == actual) & ~number
    kind = actual.copy()
    kind[number], kind[name], kind[unit] = NUMBER, NAME, UNIT
    follows = np.zeros(len(starts), bool)
    follows[1:] = (name[1:] & name[:-1] | number[1:] & number[:-1]) & (rows[1:] == rows[:-1])
    if follows.any():  # a run of names or numbers is one placeholder, its value that of the run
        group = np.cumsum(~follows) - 1
        keep = ~follows
        scale = np.where(follows, actual * W.STEP, actual)
        merged = np.zeros(int(keep.sum()), np.uint64)
        np.add.at(merged, group, scale)
        kind, actual = kind[keep], merged
        first = np.searchsorted(rows[keep], np.arange(len(offsets)))
    return kind, actual, first


def _windows(kind: np.ndarray, actual: np.ndarray, first: np.ndarray, size: np.ndarray | int, literals: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, place, size and hash of each window of ``size`` words, one number or one for each row.

    With few literal words, what stands there is hashed too.
    """
    slot = (kind == NUMBER) | (kind == NAME) | (kind == UNIT)
    plain = np.concatenate([[0], np.cumsum(~slot)])
    ends = np.arange(len(kind))
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    limit = first[row + 1]
    size = np.broadcast_to(size, len(first) - 1)[row]
    whole = ends + size <= limit
    poor = plain[np.minimum(ends + size, len(kind))] - plain[ends] < np.minimum(literals, size)
    made = [size.astype(np.uint64), size.astype(np.uint64) + W.STEP]
    for k in range(int(size.max(initial=0))):
        inside = k < size
        at = np.minimum(ends + k, len(kind) - 1)
        for j, source in enumerate((kind, actual)):
            made[j] = np.where(inside, made[j] * W.STEP + source[at], made[j])
    out = W.mix(np.where(poor, made[1], made[0]))
    return row[whole], (ends - first[row])[whole], size[whole], out[whole]


def _matches(width: int, literals: int, index: np.ndarray | None, sizes: list[int] | None = None):
    """Column function: text to its windows (place, size, hash, slot values), only those in ``index`` if there is one.

    Windows have each of ``sizes``; without sizes they have ``width`` words, or all where a text has fewer.
    """
    kind_ = "array<struct<place:int,size:int,hash:bigint,slots:array<bigint>>>"

    @F.arrow_udf(kind_)
    def matches(texts: pa.Array) -> pa.Array:
        known = index.value if index is not None else None
        bounds, places, wides, hashes, lengths, values = [np.zeros(1, np.int64)], [], [], [], [np.zeros(1, np.int64)], []
        for _, raw, offsets in W.text_chunks(texts):
            kind, actual, first = templates(raw, offsets)
            if len(kind) and (sizes is None or sizes):
                parts = []
                for size in sizes if sizes is not None else [np.minimum(width, np.diff(first))]:
                    part = _windows(kind, actual, first, size, literals)
                    if known is not None and len(known):
                        hit = known[np.minimum(np.searchsorted(known, part[3]), len(known) - 1)] == part[3]
                        part = tuple(x[hit] for x in part)
                    parts.append(part)
                row, place, wide, made = (np.concatenate(x) for x in zip(*parts))
                if len(parts) > 1:
                    order = np.argsort(row, kind="stable")
                    row, place, wide, made = row[order], place[order], wide[order], made[order]
                slot = (kind == NUMBER) | (kind == NAME) | (kind == UNIT)
                slots_at = np.flatnonzero(slot)
                start = first[row] + place
                stop = start + wide
                low, high = np.searchsorted(slots_at, start), np.searchsorted(slots_at, stop)
                n = high - low
                take = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(n) else np.zeros(0, np.int64)
                values.append(actual[slots_at[take.astype(np.int64)]].view(np.int64))
                lengths.append(n)
                places.append(place.astype(np.int32))
                wides.append(wide.astype(np.int32))
                hashes.append(made.view(np.int64))
                counts = np.bincount(row, minlength=len(offsets) - 1)
            else:
                counts = np.zeros(len(offsets) - 1, np.int64)
            bounds.append(counts)
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        slots = pa.ListArray.from_arrays(pa.array(np.cumsum(np.concatenate(lengths)).astype(np.int32)), pa.array(join(values, np.int64)))
        inner = pa.StructArray.from_arrays([pa.array(join(places, np.int32)), pa.array(join(wides, np.int32)), pa.array(join(hashes, np.int64)), slots], ["place", "size", "hash", "slots"])
        return pa.ListArray.from_arrays(pa.array(np.cumsum(np.concatenate(bounds)).astype(np.int32)), inner)

    return matches


def _runs(offset: Column, words: Column) -> Column:
    """Runs a match can belong to, by how far its place in the text is from that in the item.

    The text as a whole, the same offset, and offsets within a quarter, half and
    all of the item's words, in buckets that overlap by half: words put in or left out move the
    offset a little, the next variant on a page by the item's length.
    """
    runs = [F.struct(F.lit(0).alias("scale"), F.lit(0).cast("bigint").alias("at")), F.struct(F.lit(1).alias("scale"), offset.cast("bigint").alias("at"))]
    for k, part in enumerate((4, 2, 1)):
        size = F.ceil(words / part)
        for shifted, moved in enumerate((offset, offset + F.floor(size / 2))):
            runs.append(F.struct(F.lit(2 + 2 * k + shifted).alias("scale"), F.floor(moved / size).alias("at")))
    return F.array(*runs)


def _agreement(both: DataFrame, keys: list[str]) -> DataFrame:
    """For each key the distinct windows met, slots in them, those with the main value of each item value, and those with equal values."""
    both = both.select(*keys, "hash", F.explode_outer(F.arrays_zip("item_slots", "slots")).alias("s"))
    # One row for each item value: how many windows back each value of the document.
    pairs = both.groupBy(*keys, F.col("s.item_slots").alias("own"), F.col("s.slots").alias("theirs")).agg(
        F.count("*").alias("n"), F.collect_set("hash").alias("hashes")
    )
    values = pairs.where("own IS NOT NULL").groupBy(*keys, "own").agg(F.max("n").alias("main"), F.sum("n").alias("n"), F.max(F.when(F.col("own") == F.col("theirs"), F.col("n"))).alias("same"))
    agree = values.groupBy(*keys).agg(
        F.sum("main").alias("main"), F.sum("n").alias("n"), F.sum(F.coalesce("same", F.lit(0))).alias("same")
    )
    windows = pairs.groupBy(*keys).agg(F.size(F.array_distinct(F.flatten(F.collect_list("hashes")))).alias("windows"))
    out = windows.alias("w").join(agree.alias("a"), [F.col(f"w.{k}").eqNullSafe(F.col(f"a.{k}")) for k in keys], "left")
    return out.select("w.*", "main", "n", "same")


def benchmark_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    width: int = WINDOW,
    literals: int = LITERALS,
    coverage: float = COVERAGE,
    consistent: float = CONSISTENT,
    enough: int = ENOUGH,
    index_windows: int = INDEX_WINDOWS,
) -> DataFrame:
    """Pairs of a document and a benchmark item it contains.

    ``doc_id``, ``item_id``, ``windows`` (distinct template windows of the item found),
    ``item_windows``, ``coverage``, ``consistency``, ``verbatim`` (all slot values equal).
    A pair counts from ``coverage`` of the item's windows, or ``enough`` of them, and
    ``consistent`` of its slots, over the document or within one run of it (:func:`_runs`), so that an
    item is found beside variants of it; the figures are those of the document if it agrees as a
    whole, or else of the run with the most windows.  A window with fewer than ``literals`` literal words matches only
    with the values that stand there, so tables of numbers do not match each other.

    Benchmark windows up to ``index_windows`` go to the executors as one sorted
    array, and only windows in it become rows; beyond, all windows are
    joined by hash.  Windows are 64-bit hashes; slots are compared by value.

    Null and empty texts and items have no windows and no pair; items with fewer words
    than a window are one window, and texts have windows of those sizes too, so that a short
    item is found wherever it stands: one of a single word in each text with that word.
    Items with equal texts are each reported.  Rows of one id count as one document, so
    repeated rows give one pair; null ids do, too.  Extra columns are not read.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).alias("item_id"), F.explode(_matches(width, literals, None)("text")).alias("w"))
    items = items.select("item_id", F.col("w.place").alias("item_place"), F.col("w.size").alias("size"), F.col("w.hash").alias("hash"), F.col("w.slots").alias("item_slots"))
    items = write_shared(items, "items")
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())  # the width, and those of shorter items
    index = None
    if items.select("hash").distinct().count() <= index_windows:
        known = items.select("hash").distinct().toArrow().column("hash").to_numpy().view(np.uint64)
        index = spark.sparkContext.broadcast(np.sort(known))
    found = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.explode(_matches(width, literals, index, sizes)(text_col)).alias("w"))
    found = found.select("doc_id", "text_key", F.col("w.place").alias("place"), F.col("w.hash").alias("hash"), F.col("w.slots").alias("slots"))
    found = write_shared(found.distinct(), "windows")
    totals = items.groupBy("item_id").agg(F.countDistinct("hash").alias("item_windows"), F.max(F.col("item_place") + F.col("size")).alias("words"))

    def judged(both: DataFrame, keys: list[str]) -> DataFrame:
        out = _agreement(both, keys).alias("p").join(totals.alias("t"), F.col("p.item_id").eqNullSafe(F.col("t.item_id")))
        out = out.select(
            *[F.col(f"p.{k}").alias(k) for k in keys],
            F.col("windows").cast("bigint").alias("windows"),
            "item_windows",
            (F.col("windows") / F.col("item_windows")).alias("coverage"),
            F.coalesce(F.col("main") / F.col("n"), F.lit(1.0)).alias("consistency"),
            F.coalesce(F.col("same") == F.col("n"), F.lit(True)).alias("verbatim"),
        )
        return out.where((F.col("coverage") >= coverage) | (F.col("windows") >= enough))

    # A passage that a document repeats, with the same slot values, counts once.
    whole = write_shared(judged(found.select("doc_id", "hash", "slots").distinct().join(items, "hash"), ["doc_id", "item_id"]), "pairs")
    agrees = F.col("consistency") >= consistent
    # What does not agree over the document can still hold the item at one place, beside variants of it.
    unsure = whole.where(~agrees).select(F.col("doc_id").alias("_doc"), F.col("item_id").alias("_item"))
    of_doc, of_item = F.col("doc_id").eqNullSafe(F.col("_doc")), F.col("item_id").eqNullSafe(F.col("_item"))
    both = found.join(unsure.select("_doc").distinct(), of_doc, "left_semi").join(items, "hash").join(unsure, of_doc & of_item, "left_semi")
    both = both.alias("p").join(totals.alias("t"), F.col("p.item_id").eqNullSafe(F.col("t.item_id"))).select("p.*", "t.words")
    both = both.withColumn("run", F.explode(_runs(F.col("place") - F.col("item_place"), F.col("words"))))
    runs = judged(both, ["doc_id", "item_id", "text_key", "run"]).where(agrees)
    best = runs.groupBy("doc_id", "item_id").agg(F.max(F.struct("windows", "consistency", "verbatim", "item_windows", "coverage")).alias("best"))
    return whole.where(agrees).unionByName(best.select("doc_id", "item_id", "best.*"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows without a benchmark item, all columns as they came."""
    gone = benchmark_matches(docs, benchmark, id_col, text_col).select(F.col("doc_id").alias("__sw_id")).distinct()
    gone = write_shared(gone, "contaminated")
    return docs.join(gone, F.col(id_col).eqNullSafe(F.col("__sw_id")), "left_anti")
