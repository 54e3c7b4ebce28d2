"""Ranked lexical search the other way round: documents stream through an index over the items."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltwork.llm import words as W
from siltwork.llm.tokens import codes_of, hashes_of, same_bytes
from siltwork.shared import write_shared

TOP = 10
INDEX_POSTINGS = 1_000_000  # (item, term) pairs of one broadcast index: about 50 MB with terms of 20 bytes
CELLS = 1 << 21  # scores held at once
LAST = np.iinfo(np.int64).max

TERM = np.zeros(256, bool)
TERM[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True


def _terms(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, starts, ends and first term of each row, hashes."""
    starts, ends, first = W.runs(TERM[raw], offsets)
    low = W.LOWER[raw]
    return low, starts, ends, first, hashes_of(low, starts, ends)


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.column("_item")
        for at, raw, offsets in W.text_chunks(batch.column("_text")):
            low, starts, ends, first, hashes = _terms(raw, offsets)
            if not len(starts):
                continue
            codes, lead = codes_of(low, starts, ends, hashes)
            owner = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
            pairs = np.unique(owner * len(lead) + codes)
            run = lead[pairs % len(lead)]
            terms = [low[a:b].tobytes() for a, b in zip(starts[run].tolist(), ends[run].tolist())]
            names = rows.take(pa.array(at + pairs // len(lead)))
            yield pa.RecordBatch.from_arrays([names, pa.array(terms, pa.binary())], names=["_item", "term"])


class TermIndex:
    """Terms of a block of items, found by hash and compared in full; and the items of each term."""

    def __init__(self, postings: pa.Table):
        items, owner = np.unique(postings.column("_item").to_numpy(), return_inverse=True)
        texts = postings.column("term").to_pylist()
        terms = sorted(set(texts))
        sizes = np.array([len(t) for t in terms], np.int64)
        raw = np.frombuffer(b"\0".join(terms) + b"\0", np.uint8)
        starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        hashes = hashes_of(raw, starts, starts + sizes)
        order = np.argsort(hashes, kind="stable")
        self.raw, self.hashes = raw, hashes[order]
        self.starts, self.ends = starts[order], (starts + sizes)[order]
        self.items = items
        place = {terms[k]: n for n, k in enumerate(order.tolist())}
        term = np.array([place[t] for t in texts], np.int64)
        by_term = np.argsort(term, kind="stable")
        self.owners = owner[by_term]
        self.first = np.searchsorted(term[by_term], np.arange(len(terms) + 1))

    def find(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Place of each run among the terms, -1 where it is none."""
        at = np.searchsorted(self.hashes, hashes)
        found = np.full(len(hashes), -1)
        open_ = np.flatnonzero(at < len(self.hashes))
        while len(open_):  # once, but for terms that share a hash
            open_ = open_[self.hashes[at[open_]] == hashes[open_]]
            same = same_bytes(low, starts[open_], ends[open_], self.raw, self.starts[at[open_]], self.ends[at[open_]])
            found[open_[same]] = at[open_[same]]
            open_ = open_[~same]
            at[open_] += 1
            open_ = open_[at[open_] < len(self.hashes)]
        return found


def _counts(index):
    """Row function: for each document its id, length in terms, and the index terms it holds with their counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = index.value
        for batch in batches:
            ids = batch.column("doc_id")
            for at, raw, offsets in W.text_chunks(batch.column("_text")):
                low, starts, ends, first, hashes = _terms(raw, offsets)
                rows = len(offsets) - 1
                term = known.find(low, starts, ends, hashes)
                owner = np.repeat(np.arange(rows), np.diff(first))
                hit = term >= 0
                keys, times = np.unique(owner[hit] * len(known.hashes) + term[hit], return_counts=True)
                bounds = np.searchsorted(keys, np.arange(rows + 1) * len(known.hashes)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(x.astype(np.int64))) for x in (keys % len(known.hashes), times)]
                yield pa.RecordBatch.from_arrays([ids.slice(at, rows), pa.array(np.diff(first).astype(np.int64)), *lists], names=["doc_id", "n", "terms", "times"])

    return count


def _summed(keys: np.ndarray, values: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with the sum of their values, in 64-bit integers."""
    if cells <= 8 * len(keys):
        total = np.zeros(cells, np.int64)
        np.add.at(total, keys, values)
        found = np.flatnonzero(total)
        return found, total[found]
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[edge], np.add.reduceat(values[order], edge)


class Heaps:
    """The best documents of each item so far, ``top`` at most, in flat arrays."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.item, self.score, self.doc = (np.zeros(0, np.int64) for _ in range(3))
        self.least, self.worst = np.zeros(items, np.int64), np.full(items, LAST)

    def offer(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray) -> None:
        """Take in what beats the last of a full heap; ``least`` is 0 while a heap has room."""
        good = (score > self.least[item]) | ((score == self.least[item]) & (score > 0) & (doc < self.worst[item]))
        if not good.any():
            return
        item, score, doc = (np.concatenate(x) for x in ((self.item, item[good]), (self.score, score[good]), (self.doc, doc[good])))
        order = np.lexsort((doc, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        stays = place < self.top
        self.item, self.score, self.doc = item[stays], score[stays], doc[stays]
        full = place[stays] == self.top - 1
        self.least[self.item[full]], self.worst[self.item[full]] = self.score[full], self.doc[full]


def _search(index, weights, documents: int, all_terms: int, top: int):
    """Row function: stream term counts through the index; out come the heaps of the task."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, w = index.value, weights.value
        items = len(known.items)
        width = np.diff(known.first)
        heaps = Heaps(items, top)
        for batch in batches:
            docs = np.where(batch.column("doc_id").is_null().to_numpy(False), LAST, batch.column("doc_id").fill_null(0).to_numpy())
            lists, times = batch.column("terms"), batch.column("times").flatten().to_numpy()
            held = lists.flatten().to_numpy()
            sizes = lists.value_lengths().to_numpy()
            m = 100 - 90 + (90 * batch.column("n").to_numpy() * documents) // all_terms
            owner = np.repeat(np.arange(len(docs)), sizes)
            gain = w[held] * ((1_000_000_000 * times) // (1000 * times + 8 * m[owner]))
            work = np.concatenate([[0], np.cumsum(width[held])])[np.concatenate([[0], np.cumsum(sizes)])]
            hits = np.concatenate([[0], np.cumsum(sizes)])
            at = 0
            while at < len(docs):
                to = int(np.searchsorted(work, work[at] + CELLS, "right")) - 1
                to = max(at + 1, min(to, at + max(1, CELLS // items), len(docs)))
                part = slice(int(hits[at]), int(hits[to]))
                each = width[held[part]]
                if each.sum():
                    ends = np.cumsum(each)
                    place = np.repeat(known.first[held[part]] - (ends - each), each) + np.arange(int(ends[-1]))
                    keys = np.repeat(owner[part] - at, each) * items + known.owners[place]
                    keys, score = _summed(keys, np.repeat(gain[part], each), (to - at) * items)
                    heaps.offer(keys % items, score, docs[at + keys // items])
                at = to
        doc = pa.array(heaps.doc, mask=heaps.doc == LAST)
        yield pa.RecordBatch.from_arrays([pa.array(known.items[heaps.item]), doc, pa.array(heaps.score)], names=["_item", "doc_id", "score"])

    return search


def _blocks(postings: DataFrame, most: int) -> list[DataFrame]:
    """Postings in blocks of whole items, each of ``most`` pairs at most or of one item."""
    blocks = -(-postings.count() // most)
    if blocks < 2:
        return [postings] * blocks
    sizes = postings.groupBy("_item").count()
    while True:
        block = F.pmod(F.xxhash64("_item"), F.lit(blocks))
        held = sizes.groupBy(block.alias("block")).agg(F.sum("count").alias("n"), F.count("*").alias("items")).collect()  # a row for each pass to come
        if all(row["n"] <= most or row["items"] == 1 for row in held):
            return [postings.where(block == row["block"]) for row in held]
        blocks *= 2


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    top: int = TOP,
    index_postings: int = INDEX_POSTINGS,
) -> DataFrame:
    """``item_id``, ``rank`` from 1, ``doc_id``, ``score``: the ``top`` documents of each item.

    Terms are maximal runs of ASCII letters and digits and of all other characters beyond ASCII, A-Z
    lower-cased; scores are integers, as the README states.  The items' terms make an inverted index,
    which is broadcast.  Documents are read once: their counts of index terms are written and give the
    document frequencies, then stream through the index, where each task keeps a heap of ``top``
    documents for each item; heaps are merged by item.  Items of more than ``index_postings`` pairs of
    item and term in all are searched in blocks, one index and one pass for each.

    Null and empty texts have no terms and are never found; an item without terms finds nothing.  Equal
    scores go by ascending ``doc_id``, null last.  Rows are ranked by themselves: a document row that is
    repeated takes a rank each time, and a repeated item gets its ranks each time.  Ids are 64-bit
    integers.  Empty tables give an empty one.  Extra columns are not read.
    """
    spark: SparkSession = docs.sparkSession
    narrow = items.select(F.col(item_col).cast("bigint").alias("item_id"), F.coalesce(F.col(item_text_col), F.lit("")).alias("_text"))
    numbered = write_shared(narrow.withColumn("_item", F.monotonically_increasing_id()), "items")
    postings = write_shared(numbered.select("_item", "_text").mapInArrow(_item_terms, "_item bigint, term binary"), "postings")
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    found = []
    for block in _blocks(postings, index_postings):
        known = TermIndex(block.toArrow())
        index = spark.sparkContext.broadcast(known)
        schema = "doc_id bigint, n bigint, terms array<bigint>, times array<bigint>"
        counts = write_shared(texts.mapInArrow(_counts(index), schema), "term-counts")
        size = counts.agg(F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        frequency = np.zeros(len(known.hashes), np.int64)
        # a row for each index term at most
        held = counts.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
        frequency[held.column("term").to_numpy()] = held.column("count").to_numpy()
        n = size["documents"]
        w = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) for df in frequency.tolist()], np.int64)
        weights = spark.sparkContext.broadcast(w)
        best = counts.where(F.size("terms") > 0).mapInArrow(_search(index, weights, n, max(size["terms"], 1), top), "_item bigint, doc_id bigint, score bigint")
        found.append(write_shared(best, "heaps"))
    if not found:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    order = Window.partitionBy("_item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    merged = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return merged.join(numbered.select("_item", "item_id"), "_item").select("item_id", "rank", "doc_id", "score")
