"""Phrases whose words belong together, for each language, by best-first growth of prefixes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltwork.llm import words as W
from siltwork.llm.tokens import codes_of, hashes_of, joined
from siltwork.shared import write_shared

TOP, LEAST = 2000, 10
FIRST_WAVE, WIDEN = 2, 8  # the first wave settles scores of 2 * TOP pairs, each further one of 8 times as many
MOST_BITS = 1 << 27  # of a broadcast filter: 16 MB
BUCKET_BITS = 4096 * 8  # of one bitmap of Spark's
HELD, SENT = 1 << 20, 1 << 16  # hashes a task holds before it counts them, and those in one batch to Spark
UNKNOWN = "und"
MILLION = 1_000_000

# Characters that end a piece, and those that part its words.
PIECE_ENDS = ".,;:!?\n\x0b\x0c\r"
BLANKS = " \t"

BREAK = np.zeros(256, bool)
BREAK[[ord(c) for c in PIECE_ENDS]] = True
WORD = ~BREAK
WORD[[ord(c) for c in BLANKS]] = False

COUNTED = "lang string, phrase string, n bigint, h bigint"


class Filter:
    """A bitmap over hashes: every member passes, and a few others, which an exact join removes later."""

    def __init__(self, members: DataFrame, most_bits: int = MOST_BITS):
        """``members`` has the hashes in ``h``; the bitmap has 16 bits for each of them, and ``most_bits`` at most."""
        wanted = max(16 * members.count(), BUCKET_BITS)
        self.bits = min(1 << (wanted - 1).bit_length(), most_bits)
        place = F.pmod(F.col("h"), F.lit(self.bits))
        parts = members.groupBy(F.floor(place / BUCKET_BITS).alias("part")).agg(F.bitmap_construct_agg(place % BUCKET_BITS).alias("bitmap"))
        self.bitmap = np.zeros(max(self.bits // 8, BUCKET_BITS // 8), np.uint8)
        for row in parts.collect():  # 4 KB each, most_bits in all
            start = row["part"] * (BUCKET_BITS // 8)
            self.bitmap[start : start + BUCKET_BITS // 8] = np.frombuffer(bytes(row["bitmap"]), np.uint8)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes & np.uint64(self.bits - 1)
        return (self.bitmap[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _paired(a: np.ndarray, a_size: int, b: np.ndarray, b_size: int) -> tuple[np.ndarray, int]:
    """One number for each pair of numbers, exact, and how many there may be."""
    if a_size * b_size >= 1 << 62:
        values, a = np.unique(a, return_inverse=True)
        a_size = len(values)
    return a * b_size + b, a_size * b_size


def _pair_hash(hashes: np.ndarray) -> np.ndarray:
    return W.mix(hashes[:-1] * W.STEP + hashes[1:])


def _lang_hashes(names: pa.Array) -> np.ndarray:
    """A 64-bit number for each language name."""
    return np.array([int.from_bytes(blake2b(x.encode(), digest_size=8).digest(), "big") for x in names.to_pylist()], np.uint64)


def _counted(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """``h`` and ``n`` of hashes, in batches that take little memory on their way."""
    found, times = np.unique(np.concatenate(held), return_counts=True)
    found, times = found.view(np.int64), times.astype(np.int64)
    for at in range(0, len(found), SENT):
        yield pa.RecordBatch.from_arrays([pa.array(found[at : at + SENT]), pa.array(times[at : at + SENT])], names=["h", "n"])


def _grams(width: int, heads, tails, often):
    """Row function: counts of phrases of ``width`` words in a chunk, by language.

    ``heads``, ``tails`` and ``often`` are broadcast filters.  Of pairs both words must be in ``heads``; of triples
    the first two words must be in ``heads`` or the last two in ``tails``.  Without ``often`` a pair or triple comes
    out as the hash of language and phrase, counted over ``HELD`` of them and more, with it as strings, where that
    hash is in it.  ``h`` is the hash of a word or pair.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many_held = [], 0
        for batch in batches:
            named = pc.fill_null(batch.column("lang"), UNKNOWN).dictionary_encode()
            langs, marks = named.indices.to_numpy(), _lang_hashes(named.dictionary)
            for at, raw, offsets in W.text_chunks(batch.column("_text")):
                starts, ends, first = W.runs(WORD[raw], offsets)
                size = len(starts) - width + 1
                if size <= 0:
                    continue
                low = W.LOWER[raw]
                hashes = hashes_of(low, starts, ends)
                row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
                breaks = np.concatenate([[0], np.cumsum(BREAK[raw], dtype=np.int32)])[starts]  # piece ends before each word
                whole = (row[:size] == row[width - 1 :]) & (breaks[:size] == breaks[width - 1 :])
                h = hashes
                if width == 2:
                    known = heads.value.holds(hashes)
                    whole &= known[:-1] & known[1:]
                    h = _pair_hash(hashes)
                elif width == 3:
                    pairs = _pair_hash(hashes)
                    whole &= heads.value.holds(pairs[:-1]) | tails.value.holds(pairs[1:])
                    h = W.mix(pairs[:-1] * W.STEP + hashes[2:])
                places = np.flatnonzero(whole)
                if width > 1:
                    mixed = W.mix(h[places] + marks[langs[at + row[places]]])
                    if often is None:
                        held.append(mixed)
                        many_held += len(mixed)
                        if many_held >= HELD:
                            yield from _counted(held)
                            held, many_held = [], 0
                        continue
                    places = places[often.value.holds(mixed)]
                if not len(places):
                    continue
                used = np.unique(np.concatenate([places + k for k in range(width)]))
                codes = np.zeros(len(starts), np.int64)
                codes[used], lead = codes_of(low, starts[used], ends[used], hashes[used])
                key, many = langs[at + row[places]].astype(np.int64), len(named.dictionary)
                for k in range(width):
                    key, many = _paired(key, many, codes[places + k], len(lead))
                _, found, times = np.unique(key, return_index=True, return_counts=True)
                found = places[found]
                phrases = joined(low, starts, ends, [found + k for k in range(width)])
                names = named.dictionary.take(pa.array(langs[at + row[found]]))
                yield pa.RecordBatch.from_arrays(
                    [names.cast(pa.string()), phrases.cast(pa.string()), pa.array(times.astype(np.int64)), pa.array(h[found].view(np.int64))],
                    names=["lang", "phrase", "n", "h"],
                )
        if held:
            yield from _counted(held)

    return count


def _write(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a shared table of as many files as there are cores, or fewer.

    Its rows are dealt once more, so that the step before keeps its tasks: a file system may start a process for the
    mode of each file (Hadoop's local one does), and a large shuffle would write thousands of small files.
    """
    spark = df.sparkSession
    files = spark.sparkContext.defaultParallelism
    adaptive = spark.conf.get("spark.sql.adaptive.enabled") == "true"  # the hint needs it
    return write_shared(df.hint("rebalance").coalesce(files) if adaptive else df.repartition(files), label)


def _words(texts: DataFrame, least: int) -> DataFrame:
    """``lang``, ``phrase``, ``n``, ``h`` of the words found ``least`` times or more; with null as phrase all others of a language."""
    words = texts.mapInArrow(_grams(1, None, None, None), COUNTED).groupBy("lang", "phrase").agg(F.sum("n").alias("n"), F.max("h").alias("h"))
    often = words.withColumn("phrase", F.when(F.col("n") >= least, F.col("phrase")))
    return often.groupBy("lang", "phrase").agg(F.sum("n").alias("n"), F.max("h").alias("h"))


def _frequent(texts: DataFrame, width: int, least: int, heads: Filter, tails: Filter | None = None) -> DataFrame:
    """``lang``, ``phrase``, ``n``, ``h`` of the phrases that pass the filters and occur ``least`` times or more.

    Hashes are counted first, and strings only of those found often enough: nearly all phrases are rare, and a
    hash is a long.  Tasks have counted their own, so these are dealt without another hash table.  Phrases that share a hash add up there, so none is missed; the counts are those of the strings.
    """
    send = texts.sparkSession.sparkContext.broadcast
    ends = send(heads), send(tails)
    hashes = texts.mapInArrow(_grams(width, *ends, None), "h bigint, n bigint").repartition("h").groupBy("h").agg(F.sum("n").alias("n"))
    often = Filter(_write(hashes.where(F.col("n") >= least).select("h"), "frequent-hashes"))
    counted = texts.mapInArrow(_grams(width, *ends, send(often)), COUNTED)
    return counted.groupBy("lang", "phrase").agg(F.sum("n").alias("n"), F.max("h").alias("h")).where(F.col("n") >= least)


def _wide(name: str) -> str:
    return f"CAST({name} AS DECIMAL(16,0))"


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)) in decimals of 38 digits: exact for counts below 10**15."""
    return F.expr(f"CAST((CAST({MILLION} AS DECIMAL(7,0)) * ({_wide(a)} * {_wide(a)})) div ({_wide(left)} * {_wide(right)}) AS BIGINT)")


def _thresholds(pairs: DataFrame, wanted: int) -> DataFrame:
    """For each language the largest score that at least ``wanted`` pairs reach, or 0 where there are fewer.

    A language has a million and one scores at most, so the window is over a bounded number of rows.
    """
    by_score = pairs.groupBy("lang", "score").agg(F.count("*").alias("pairs"))
    reached = F.sum("pairs").over(Window.partitionBy("lang").orderBy(F.col("score").desc()))
    enough = by_score.withColumn("reached", reached)
    return enough.groupBy("lang").agg(F.coalesce(F.max(F.when(F.col("reached") >= wanted, F.col("score"))), F.lit(0)).alias("floor"))


def _pairs(texts: DataFrame, words: DataFrame, least: int) -> DataFrame:
    """Pairs of words found ``least`` times or more, scored, with the bound of what grows from them as ``bound``.

    A phrase that begins with the pair xy occurs f(xy) times at most, and what follows x in it as often as itself
    at least: cut after x, its score is f(xy) / f(x) at most.
    """
    often = words.where(F.col("phrase").isNotNull())
    pairs = _frequent(texts, 2, least, Filter(often.select("h")))
    split = pairs.select("lang", "phrase", F.col("n").alias("a"), "h", F.substring_index("phrase", " ", 1).alias("x"), F.substring_index("phrase", " ", -1).alias("y"))
    first = often.select("lang", F.col("phrase").alias("x"), F.col("n").alias("l"))
    second = often.select("lang", F.col("phrase").alias("y"), F.col("n").alias("r"))
    scored = split.join(first, ["lang", "x"]).join(second, ["lang", "y"])
    return scored.select("lang", "phrase", "a", "h", "l", "r", _score("a", "l", "r").alias("score"), F.expr(f"CAST({MILLION} * {_wide('a')} div l AS BIGINT)").alias("bound"))


def _wave(texts: DataFrame, pairs: DataFrame, least: int) -> DataFrame:
    """What survives of the phrases that reach their language's ``floor``; ``pairs`` carry it.

    Grown are all pairs whose bound reaches the floor, and, since a triple may drop them, all triples that end
    with a pair that reaches it: every triple of either kind is counted in full.
    """
    reaching = pairs.where(F.col("score") >= F.col("floor"))
    heads, tails = Filter(pairs.where(F.col("bound") >= F.col("floor")).select("h")), Filter(reaching.select("h"))
    triples = _frequent(texts, 3, least, heads, tails)
    word = lambda k: F.split_part("phrase", F.lit(" "), F.lit(k))
    split = triples.select("lang", "phrase", F.col("n").alias("a"), F.concat_ws(" ", word(1), word(2)).alias("xy"), F.concat_ws(" ", word(2), word(3)).alias("yz"))
    split = _write(split, "triples")
    left = pairs.select("lang", F.col("phrase").alias("xy"), F.col("a").alias("f_xy"), F.col("l").alias("f_x"), "floor")
    right = pairs.select("lang", F.col("phrase").alias("yz"), F.col("a").alias("f_yz"), F.col("r").alias("f_z"))
    cuts = split.join(left, ["lang", "xy"]).join(right, ["lang", "yz"]).withColumns({"s1": _score("a", "f_x", "f_yz"), "s2": _score("a", "f_xy", "f_z")})
    second = F.col("s2") < F.col("s1")
    scored = cuts.select(
        "lang", "phrase", "a", F.when(second, F.col("f_xy")).otherwise(F.col("f_x")).alias("l"),
        F.when(second, F.col("f_z")).otherwise(F.col("f_yz")).alias("r"), F.least("s1", "s2").alias("score"), "floor",
    )
    longer = split.select("lang", F.explode(F.array("xy", "yz")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = reaching.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (_decimal("longer", 100) < _decimal("a", 50)))
    kept = kept.select(*scored.columns)
    return _write(kept.unionByName(scored.where(F.col("score") >= F.col("floor"))), "survivors")


def _decimal(name: str, factor: int) -> Column:
    return F.expr(f"CAST({factor} AS DECIMAL(3,0)) * {_wide(name)}")


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    top: int = TOP,
    least: int = LEAST,
) -> DataFrame:
    """``lang``, ``rank`` from 1, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: each language's ``top`` phrases.

    Phrases have 2 or 3 words, occur ``least`` times or more, and are scored and dropped as the README
    states.  They grow from prefixes, best first: words, then pairs of frequent words, then triples from those
    pairs whose bound (the best score that anything grown from them can have) reaches the score to be
    settled in this wave.  A language is settled when ``top`` of its phrases survive with that score or more, as
    all others score less; else its next wave takes a lower score, and at 0 everything is grown.  Counts are
    exact: a filter of hashes, broadcast with ``MOST_BITS`` bits at most, only spares phrases that cannot come in.

    Null and empty texts have no words; a null language is ``und``.  Repeated rows count each time.
    Phrases of one score and count go in byte order.  An empty table gives an empty one.  Extra columns
    are not read.
    """
    texts = docs.select(F.coalesce(F.col(lang_col), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    words = _write(_words(texts, least), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    pairs = _write(_pairs(texts, words, least), "pairs")
    waves, wanted = [], FIRST_WAVE * top
    while not pairs.isEmpty():
        floors = _write(_thresholds(pairs, wanted), "floors")
        found = _wave(texts, pairs.join(floors, "lang"), least)
        by_lang = found.groupBy("lang", "floor").agg(F.count("*").alias("rows"))
        settled = _write(by_lang.where((F.col("rows") >= top) | (F.col("floor") == 0)).select("lang"), "settled")
        none = floors.where("floor = 0").select("lang")  # nothing is left to grow, whether or not something survived
        settled = settled.unionByName(none).distinct()
        waves.append(found.join(settled, "lang", "left_semi"))
        pairs = _write(pairs.join(settled, "lang", "left_anti"), "pairs")
        texts = texts.join(pairs.select("lang").distinct(), "lang", "left_semi")
        wanted *= WIDEN
    if not waves:
        return docs.sparkSession.createDataFrame([], "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = reduce(DataFrame.unionByName, waves).withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
