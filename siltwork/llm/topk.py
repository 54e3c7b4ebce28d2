"""Exact top-k inner products by MaxScore over shards of postings."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltwork.shared import write_shared

SCALE = 256
EVERY, TOP = 50, 5
SHARD_ROWS, LEAST_ROWS = 262_144, 256
CELLS_PER_CORE = 2
STRIPE = 4096  # rows traversed at once
SEED_TERMS, SEED_ROWS = 8, 16
EXACT_FLOAT = 2.0**53
LAST = np.iinfo(np.int64).max


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, in doubles, as long."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def _usable(vector: Column, scale: int) -> Column:
    """No null, no component that is null or not finite, and a squared length that keeps scores within a long."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    length = F.aggregate(vector, F.lit(0.0), lambda total, x: total + F.pow(F.floor(x.cast("double") * scale).cast("double"), F.lit(2.0)))
    return vector.isNotNull() & ~bad & (length < 2.0**62)


class Shard:
    """Vectors of one shard as a posting list for each component (a query's term), zeros where a vector has none.

    ``high`` and ``low`` bound the values of a list; ``strong`` names the rows at both of its ends, where a
    query's first candidates come from.
    """

    def __init__(self, ids: np.ndarray, rows: np.ndarray, lists: np.ndarray):
        self.ids, self.rows = ids, rows
        self.peak = float(np.abs(lists).max(initial=0))
        self.kind = np.float64 if self.peak * self.peak * max(len(lists), 1) < EXACT_FLOAT else np.int64
        self.lists = lists.astype(self.kind)
        self.high, self.low = lists.max(1, initial=0), lists.min(1, initial=0)
        self.norm = math.sqrt(float((lists.astype(np.float64) ** 2).sum(0).max(initial=0)))
        order = np.argsort(lists, axis=1, kind="stable")
        self.strong = (order[:, -SEED_ROWS:], order[:, :SEED_ROWS])


class Best:
    """The ``top`` best candidates of one query so far; ``floor`` is the score that others must reach."""

    def __init__(self, top: int):
        self.top, self.floor = top, None
        self.score, self.id, self.row = (np.zeros(0, np.int64) for _ in range(3))

    def offer(self, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        score = np.concatenate([self.score, score.astype(np.int64)])
        ids, rows = np.concatenate([self.id, ids]), np.concatenate([self.row, rows])
        order = np.lexsort((rows, ids, -score))[: self.top]
        self.score, self.id, self.row = score[order], ids[order], rows[order]
        if len(order) == self.top:
            self.floor = int(self.score[-1])


def max_score(shard: Shard, query: np.ndarray, own_row: int, top: int) -> Best:
    """The ``top`` rows of a shard by inner product with ``query``, all but ``own_row``; equal scores by smaller id.

    The query's terms stand in falling order of their score bounds.  Those from the first on whose
    bounds left over reach ``floor`` are essential: only rows of their lists can come in.  Their lists are
    traversed; the remaining, non-essential lists are probed one block of terms after the other, for rows whose
    score so far plus the bound of what is left still reaches ``floor``.  A bound is the smaller of the sum of
    the lists' own bounds and the product of the lengths of what is left of the query and of the longest vector.
    """
    best = Best(top)
    size = min(len(query), len(shard.lists))
    bounds = np.maximum(query[:size] * shard.high[:size], query[:size] * shard.low[:size])
    terms = np.argsort(-bounds, kind="stable")
    terms = terms[query[terms] != 0]
    exact = shard.kind if float(np.abs(query).max(initial=0)) * shard.peak * max(size, 1) < EXACT_FLOAT else np.int64
    q = query[terms].astype(exact)
    lists = shard.lists if exact == shard.kind else shard.lists.astype(exact)
    tail = lambda x: np.concatenate([np.cumsum(x[::-1])[::-1], [0]])
    lengths = np.sqrt(tail(query[terms].astype(np.float64) ** 2)) * shard.norm
    left = np.minimum(tail(bounds[terms].astype(np.float64)), lengths) * (1 + 1e-9) + 1 + lengths[0] * 1e-12  # rounded up
    left[-1] = 0
    seen = np.zeros(len(shard.rows), bool)

    strong = [shard.strong[0 if query[t] > 0 else 1][t] for t in terms[:SEED_TERMS].tolist()]
    if strong:  # the strongest rows of the first lists, for a floor to begin with
        seeds = np.unique(np.concatenate(strong))
        seen[seeds] = True
        seeds = seeds[shard.rows[seeds] != own_row]
        best.offer(q @ lists[np.ix_(terms, seeds)], shard.ids[seeds], shard.rows[seeds])

    for begin in range(0, len(shard.rows), STRIPE):
        stripe = slice(begin, begin + STRIPE)
        needed = -math.inf if best.floor is None else best.floor
        essential = int(np.argmax(left < needed)) if (left < needed).any() else len(terms)
        score = q[:essential] @ lists[terms[:essential], stripe]
        near = np.flatnonzero((score + left[essential] >= needed) & ~seen[stripe] & (shard.rows[stripe] != own_row))
        score = score[near]
        at = essential
        while at < len(terms) and len(near):
            to = min(len(terms), at + max(4, (len(terms) - at) // 3))
            score = score + q[at:to] @ lists[np.ix_(terms[at:to], near + begin)]
            competes = score + left[to] >= needed
            near, score, at = near[competes], score[competes], to
        best.offer(score, shard.ids[near + begin], shard.rows[near + begin])
    return best


def _vectors(batches: list[pa.RecordBatch]) -> np.ndarray:
    """Components by vectors; a shorter vector counts as 0 in what it lacks."""
    sizes = np.concatenate([b.column("v").value_lengths().to_numpy(False) for b in batches])
    values = np.concatenate([b.column("v").flatten().to_numpy() for b in batches])
    out = np.zeros((int(sizes.max(initial=0)), len(sizes)), np.int64)
    ends = np.cumsum(sizes)
    out[np.arange(len(values)) - np.repeat(ends - sizes, sizes), np.repeat(np.arange(len(sizes)), sizes)] = values
    return out


def _cells(top: int):
    """Row function over rows sorted by cell, candidates first: each query against the shard before it."""

    def ids_of(batch: pa.RecordBatch) -> np.ndarray:
        ids = batch.column("vec_id")
        return np.where(ids.is_null().to_numpy(False), LAST, ids.fill_null(0).to_numpy())

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, gathered, shard = None, [], None
        for batch in batches:
            cells, asks = batch.column("cell").to_numpy(), batch.column("asks").to_numpy(False)
            edges = np.flatnonzero((cells[1:] != cells[:-1]) | (asks[1:] != asks[:-1])) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(cells)]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if cells[a] != cell:
                    cell, gathered, shard = cells[a], [], None
                if not asks[a]:
                    gathered.append(part)
                    continue
                if shard is None:
                    if not gathered:
                        continue
                    shard = Shard(np.concatenate([ids_of(x) for x in gathered]), np.concatenate([x.column("row").to_numpy() for x in gathered]), _vectors(gathered))
                    gathered = []
                queries, rows = _vectors([part]), part.column("row").to_numpy()
                found = [max_score(shard, queries[:, k], int(rows[k]), top) for k in range(len(rows))]
                each = [len(f.row) for f in found]
                ids = np.concatenate([f.id for f in found])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(rows, each)),
                        pa.array(np.repeat(part.column("vec_id").to_numpy(), each)),
                        pa.array(ids, mask=ids == LAST),
                        pa.array(np.concatenate([f.row for f in found])),
                        pa.array(np.concatenate([f.score for f in found])),
                    ],
                    names=["query_row", "query_id", "vec_id", "row", "score"],
                )

    return search


def top_k(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    every: int = EVERY,
    top: int = TOP,
    scale: int = SCALE,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id``, ``score``: for each query the ``top`` rows by integer inner product.

    Components become floor(``scale`` * x); rows whose id is divisible by ``every`` are the queries,
    all rows but its own the candidates of each.  Candidates are dealt into shards of ``shard_rows``
    at most by a hash of the row, and queries go to every shard in blocks; shards and blocks are
    chosen so that both sides are copied about as often.  A task keeps one shard and streams queries past it
    (:func:`max_score`); the best of the shards are merged by query.

    Vectors that are null, hold a null or non-finite component, or whose squared length is 2**62 or
    more (their scores are no longs) take no part.  Vectors of other lengths count as 0 in what they
    lack, empty ones in all.  Equal scores go by smaller id, null last.  A row with a null id is a candidate, no
    query.  Rows are told apart, not ids: a repeated row is a candidate of its copies, and each copy of a query is
    answered.  An empty table gives an empty one; extra columns are not read.
    """
    spark: SparkSession = vectors.sparkSession
    vector = F.col(vector_col)
    kept = vectors.where(_usable(vector, scale)).select(F.col(id_col).cast("bigint").alias("vec_id"), quantised(vector, scale).alias("v"))
    rows = write_shared(kept.withColumn("row", F.monotonically_increasing_id()), "vectors")
    asks = F.col("vec_id") % every == 0
    size = rows.agg(F.count("*").alias("rows"), F.count_if(asks).alias("queries")).first()
    n, queries = size["rows"], max(size["queries"], 1)
    wanted = max(CELLS_PER_CORE * spark.sparkContext.defaultParallelism, -(-n // shard_rows))
    shards = max(1, -(-n // shard_rows), min(math.isqrt(wanted * n // queries), -(-n // LEAST_ROWS)))
    blocks = min(-(-wanted // shards), queries)
    every_ = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    dealt = F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")
    candidates = rows.select("*", F.lit(False).alias("asks"), dealt.alias("shard"), every_(blocks).alias("block"))
    block = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).cast("int")
    asked = rows.where(asks).select("*", F.lit(True).alias("asks"), every_(shards).alias("shard"), block.alias("block"))
    cell = (F.col("block") * shards + F.col("shard")).alias("cell")
    cells = candidates.unionByName(asked).select(cell, "asks", "row", "vec_id", "v")
    placed = cells.repartition(shards * blocks, "cell").sortWithinPartitions("cell", "asks")
    best = placed.mapInArrow(_cells(top), "query_row bigint, query_id bigint, vec_id bigint, row bigint, score bigint")
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    merged = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return merged.select("query_id", "rank", "vec_id", "score")
