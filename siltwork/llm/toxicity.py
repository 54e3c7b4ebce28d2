"""Toxic passages: maximum-scoring segments over word log-odds, calibrated as extreme values.

A word's log-odds of standing in a toxic document come from counts with
Dirichlet priors in levels: the prior of a word is the estimate of its first
six bytes, theirs that of the first five, then four, then the rate of
toxic documents.  So an unseen word with a telling stem is scored by its stem.
Words of both signs count; only those whose log-odds do not differ from 0 by
more than their error are neutral.

Each word scores its log-odds less a drift, its k-th occurrence in the text a k-th
of the log-odds, as those are of standing in a document at all; and one linear scan finds all
maximal-scoring segments, the passages.  By the extreme-value law for such
segments, a clean text of n words has about ``K n exp(-lambda S)`` passages of
score S or more.  A document's evidence is the logarithm of the sum of
``exp(lambda S) / (K n)`` over its passages; a logistic curve turns it into a
probability.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltwork.llm import words as W
from siltwork.llm.folds import bounded, held_out
from siltwork.shared import write_shared

SAMPLE_DOCS = 30_000
MODEL_TOKENS = 500_000
PREFIXES = (4, 5, 6)  # bytes
PRIOR = 6.0
SURE = 2.0  # standard errors by which a token's log-odds must differ from 0
DRIFT = 0.5
REJECT = 0.7
NO_PASSAGE = -12.0

SCORES = T.StructType(
    [
        T.StructField("score", T.DoubleType()),
        T.StructField("words", T.LongType()),
        T.StructField(
            "passages",
            T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())])),
        ),
    ]
)


def tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[W.Words, list[np.ndarray]]:
    """Letter words, and for each word the hashes of its prefixes and of the whole, shortest first.

    A word no longer than a prefix stands for it.
    """
    found, values = W.letter_words(raw, offsets)
    levels = []
    for size in PREFIXES:
        ends = np.minimum(found.starts + size, found.ends)
        levels.append(W.mix(W.run_hashes(values, found.starts, ends) + np.uint64(size)))
    levels.append(found.hashes)
    return found, levels


def segments(scores: np.ndarray, places: np.ndarray, drift: float, falls: np.ndarray | None = None) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments of a row of words, in one pass.

    ``scores`` are those of the words at ``places`` with a positive balance.  ``falls``
    is what the words between each of them and the one before lose together;
    without it every other word scores ``-drift``.  Returned are first place, last place and sum.
    """
    if falls is None:
        falls = drift * np.diff(places, prepend=-1) - drift
    left: list[float] = []  # running sum before each segment that may still grow
    right: list[float] = []
    lower: list[int] = []  # the nearest earlier segment that starts lower, so that a search skips what lies between
    spans: list[tuple[int, int]] = []
    total = 0.0
    for score, place, fall in zip(scores.tolist(), places.tolist(), falls.tolist()):
        total -= fall
        low, first = total, place
        total += score
        high = total
        at = len(left) - 1
        while True:
            while at >= 0 and left[at] >= low:
                at = lower[at]
            if at < 0 or right[at] >= high:
                break
            low, first = left[at], spans[at][0]
            before = lower[at]
            del left[at:], right[at:], lower[at:], spans[at:]
            at = before
        left.append(low)
        right.append(high)
        lower.append(at)
        spans.append((first, place))
    return [(a, b, high - low) for (a, b), low, high in zip(spans, left, right)]


def occurrence(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """1 for a word's first occurrence in its row, 2 for the second, and so on."""
    order = np.lexsort((np.arange(len(hashes)), hashes, rows))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (rows[order][1:] != rows[order][:-1])
    starts = np.flatnonzero(fresh)
    out = np.empty(len(order), np.int64)
    out[order] = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order)))) + 1
    return out


@dataclass
class Model:
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))  # sorted token hashes
    odds: np.ndarray = field(default_factory=lambda: np.zeros(0))
    rate: float = 1.0  # lambda
    log_k: float = 0.0
    slope: float = 0.0
    base: float = -50.0
    drift: float = DRIFT

    def word_odds(self, levels: list[np.ndarray]) -> np.ndarray:
        """Log-odds by the longest known token of each word, 0 where none is known."""
        out = np.zeros(len(levels[0]))
        if not len(self.keys):
            return out
        for level in levels:
            at = np.minimum(np.searchsorted(self.keys, level), len(self.keys) - 1)
            known = self.keys[at] == level
            out[known] = self.odds[at[known]]
        return out

    def balance(self, found: W.Words, levels: list[np.ndarray]) -> np.ndarray:
        """What each word scores: a k-th of its log-odds at its k-th occurrence, less the drift."""
        odds = self.word_odds(levels)
        known = np.flatnonzero(odds)
        odds[known] /= occurrence(found.hashes[known], found.rows[known])
        return odds - self.drift

    def rows(self, texts: pa.Array):
        """Word count, byte spans and scores of the passages of each row."""
        for _, raw, offsets in W.text_chunks(texts):
            found, levels = tokens(raw, offsets)
            scores = self.balance(found, levels)
            good = np.flatnonzero(scores > 0)
            sums = np.concatenate([[0.0], np.cumsum(scores)])
            bounds = np.searchsorted(good, found.first)
            for row, n in enumerate(found.counts.tolist()):
                at = good[bounds[row] : bounds[row + 1]]
                first = found.first[row]
                falls = sums[np.concatenate([[first], at[:-1] + 1])] - sums[at] if len(at) else at
                spans = segments(scores[at], at - first, self.drift, falls) if len(at) else []
                yield n, [(int(found.starts[first + a] - offsets[row]), int(found.ends[first + b] - offsets[row]), s) for a, b, s in spans]

    def evidence(self, n: int, scores: list[float]) -> float:
        """Logarithm of the summed significance of the passages, at least ``NO_PASSAGE``."""
        if not scores:
            return NO_PASSAGE
        return max(NO_PASSAGE, float(np.logaddexp.reduce(self.rate * np.array(scores))) - np.log(n) - self.log_k)

    def probability(self, evidence: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * evidence + self.base, -50, 50))))


def score_of(model: Model, spark):
    """Column function: text to probability, word count and significant passages.

    Passages are byte spans of the UTF-8 text that are expected less than once
    in a clean text of that length.
    """
    shared = spark.sparkContext.broadcast(model)  # MODEL_TOKENS tokens at most

    @F.arrow_udf(SCORES)
    def score(texts: pa.Array) -> pa.Array:
        model = shared.value
        out = []
        for n, spans in model.rows(texts):
            kept = [{"start": a, "end": b, "score": s} for a, b, s in spans if model.rate * s > np.log(n) + model.log_k]
            out.append({"score": model.probability(model.evidence(n, [s for _, _, s in spans])), "words": n, "passages": kept})
        kind = pa.struct([("score", pa.float64()), ("words", pa.int64()), ("passages", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])))])
        return pa.array(out, kind)

    return score


@F.arrow_udf(T.LongType())
def likeness(texts: pa.Array) -> pa.Array:
    """One MinHash value over five-word shingles: near copies mostly share it."""
    out = []
    for _, raw, offsets in W.text_chunks(texts):
        found, bounds = W.shingle_sets(W.words(raw, offsets), 5)
        least = np.zeros(len(bounds) - 1, np.uint64)
        full = np.diff(bounds) > 0
        least[full] = found[bounds[:-1][full]]
        out.append(least.view(np.int64))
    return pa.array(np.concatenate(out) if out else np.zeros(0, np.int64))


def _count_tokens(batches):
    """Rows of a word's token hashes and the numbers of toxic and clean texts it is in, summed over chunks."""
    for batch in batches:
        toxic = np.array(batch.column("toxic").to_pylist(), bool)
        for first, raw, offsets in W.text_chunks(batch.column("text")):
            found, levels = tokens(raw, offsets)
            rows = found.rows
            order = np.lexsort((found.hashes, rows))
            fresh = np.ones(len(order), bool)
            fresh[1:] = (found.hashes[order][1:] != found.hashes[order][:-1]) | (rows[order][1:] != rows[order][:-1])
            picked = order[fresh]
            _, at, same = np.unique(found.hashes[picked], return_index=True, return_inverse=True)
            is_toxic = toxic[first + rows[picked]]
            counts = [np.bincount(same, weights=w, minlength=len(at)).astype(np.int64) for w in (is_toxic, ~is_toxic)]
            columns = [pa.array(level[picked][at].view(np.int64)) for level in levels] + [pa.array(c) for c in counts]
            yield pa.RecordBatch.from_arrays(columns, [*(f"t{k}" for k in range(len(levels))), "bad", "good"])


def _token_odds(texts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes and log-odds of the tokens that tell for either side, and of those below one that tells."""
    levels = len(PREFIXES) + 1
    schema = ", ".join(f"t{k} bigint" for k in range(levels)) + ", bad bigint, good bigint"
    names = [f"t{k}" for k in range(levels)]
    counted = texts.mapInArrow(_count_tokens, schema).groupBy(*names).agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    counted = write_shared(counted, "tokens")
    bad, all_ = texts.agg(F.sum(F.col("toxic").cast("int")), F.count("*")).first()
    base = bad / all_
    share, kept = F.lit(base), None
    for k in range(levels):
        sums = counted.groupBy(*names[: k + 1]).agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        if k:
            sums = sums.join(before, names[k - 1])
            share = F.col("share")
        now = (F.col("bad") + PRIOR * share) / (F.col("bad") + F.col("good") + PRIOR)
        odds = F.log(now / (1 - now)) - float(np.log(base / (1 - base)))
        weight = F.col("bad") + F.col("good") + PRIOR
        tells = F.abs(odds) > SURE / F.sqrt(weight * now * (1 - now))  # the error of log-odds from that many texts
        if k:
            tells = tells | F.col("tells")  # else the word would be taken for its stem
        before = sums.select(F.col(names[k]), now.alias("share"), odds.alias("odds"), tells.alias("tells"))
        telling = before.where("tells").select(F.col(names[k]).alias("token"), "odds")
        before = before.drop("odds")
        kept = telling if kept is None else kept.unionByName(telling)
    # A word no longer than its prefix gives one token at two levels.
    kept = kept.groupBy("token").agg(F.min("odds").alias("odds")).orderBy(F.abs("odds").desc(), "token").limit(most).toArrow()
    keys = kept.column("token").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], kept.column("odds").to_numpy()[order]


def _decay(scores: np.ndarray, counts: np.ndarray) -> float:
    """The lambda at which the mean of ``exp(lambda * score)`` over words of clean texts is 1."""
    share = counts / counts.sum()
    mean = lambda rate: float((share * np.exp(np.clip(rate * scores, -700, 700))).sum())
    low, high = 0.0, 1.0
    while mean(high) < 1 and high < 8:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if mean(middle) < 1 else (low, middle)
    return max(low, 0.1)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and base by Newton's method with a little shrinkage."""
    design, coef = np.stack([x, np.ones_like(x)], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ coef, -30, 30)))
        slope = design.T @ (y - p) - 0.01 * coef
        bend = (design * (p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        coef = coef + step
        if np.abs(step).max() < 1e-8:
            break
    return float(max(coef[0], 0.0)), float(coef[1])


def _passage_scores(model: Model):
    @F.arrow_udf(T.StructType([T.StructField("n", T.LongType()), T.StructField("s", T.ArrayType(T.DoubleType()))]))
    def passages(texts: pa.Array) -> pa.Array:
        return pa.array([{"n": n, "s": [s for _, _, s in spans]} for n, spans in model.rows(texts)], pa.struct([("n", pa.int64()), ("s", pa.list_(pa.float64()))]))

    return passages


def _score_counts(model: Model):
    """Task function: word counts by score, in steps of a tenth."""

    def count(batches):
        seen = np.zeros(512, np.int64)
        for batch in batches:
            for _, raw, offsets in W.text_chunks(batch.column("text")):
                steps = np.rint(model.balance(*tokens(raw, offsets)) * 10).astype(int) + 256
                seen += np.bincount(np.clip(steps, 0, 511), minlength=512)
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(used - 256), pa.array(seen[used])], ["step", "n"])

    return count


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS, most_tokens: int = MODEL_TOKENS) -> Model:
    """Learn from labelled rows that are not held out, ``sample_docs`` of them at most.

    Near copies with one label count once.  Three quarters of the sample give the
    words, the rest the calibration.  The driver gets ``most_tokens`` tokens, and
    a word count and passage scores for each row of the calibration part.
    """
    marks = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out("doc_id"))
    marks = bounded(marks.groupBy(F.col("doc_id").alias("__id")).agg((F.max("toxic") == 1).alias("toxic")), F.col("__id"), sample_docs)
    marks = F.broadcast(marks)  # sample_docs ids and flags, so texts do not move
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).where("text IS NOT NULL").join(marks, "__id")
    rows = write_shared(rows.select("__id", "toxic", "text", likeness("text").alias("like")), "labelled")
    once = rows.groupBy("like", "toxic").agg(F.min("__id").alias("__id"))
    sample = write_shared(rows.join(once, ["like", "toxic", "__id"]).dropDuplicates(["__id"]), "labelled")
    classes = {r["toxic"] for r in sample.select("toxic").distinct().collect()}
    if classes != {True, False}:
        return Model()
    part = F.pmod(F.xxhash64(F.col("like"), F.lit(5)), F.lit(4))
    learn, rest = sample.where(part > 0).select("text", "toxic"), sample.where(part == 0).select("text", "toxic")
    if {r["toxic"] for r in learn.select("toxic").distinct().collect()} != {True, False}:
        learn = sample.select("text", "toxic")
    keys, odds = _token_odds(learn, most_tokens)
    model = Model(keys, odds)
    clean = rest.where("NOT toxic").select("text").mapInArrow(_score_counts(model), "step bigint, n bigint")
    steps = clean.groupBy("step").agg(F.sum("n").alias("n")).toArrow()
    if steps.num_rows:
        by_step, n = steps.column("step").to_numpy() / 10, steps.column("n").to_numpy()
        model.rate = _decay(by_step, n)
    held = rest.select("toxic", _passage_scores(model)("text").alias("p")).select("toxic", "p.*").toArrow().to_pylist()
    most = [model.rate * max(r["s"]) - np.log(r["n"]) for r in held if r["s"] and not r["toxic"]]
    bare = sum(not r["toxic"] for r in held)
    if most and bare:
        # the chance that a clean text has a passage above its median is known: this sets K
        middle = float(np.median(most))
        model.log_k = middle + float(np.log(len(most) / 2 / bare))
    x = np.array([model.evidence(r["n"], r["s"]) for r in held])
    y = np.array([float(r["toxic"]) for r in held])
    if len(set(y.tolist())) == 2:
        model.slope, model.base = _logistic(x, y)
    else:
        model.slope, model.base = 1.0, 0.0
    return model


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Model | None = None) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted``, ``words``, ``passages`` for each row, from its text alone.

    Null, empty and wordless texts have no passage and the lowest score.  Where the labels
    do not show both classes nothing is learned and every score is about 0.
    Labels without an id or value are left out; of several labels for an id the highest
    counts.  A null document id is not held out.  Repeated rows are scored each.
    Extra columns are not read.
    """
    model = model or fit(docs, labels, id_col, text_col)
    found = docs.select(
        F.col(id_col).alias("doc_id"),
        held_out(id_col).alias("held_out"),
        score_of(model, docs.sparkSession)(text_col).alias("said"),
    )
    score = F.col("said.score")
    return found.select("doc_id", "held_out", score.alias("score"), (score >= REJECT).cast("int").alias("predicted"), "said.words", "said.passages")


def keep_civil(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows whose score is below ``REJECT``, all columns as they came."""
    model = fit(docs, labels, id_col, text_col)
    said = docs.withColumn("__sw_said", score_of(model, docs.sparkSession)(text_col))
    return said.where(F.col("__sw_said.score") < REJECT).drop("__sw_said")
