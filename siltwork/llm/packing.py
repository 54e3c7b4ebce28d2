"""Best-fit packing of documents into bins, with conflicts between documents."""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwork.llm.exact import normalised
from siltwork.shared import write_shared

CAPACITY = 16_384  # UTF-8 bytes of text in a bin
BLOCK_ROWS = 4_096
LOCAL_BITS = 24
OUT = "doc_id bigint, piece int, bin_id bigint, bin_start bigint, size bigint, text_start bigint"


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int) -> list[int]:
    """Bin of each item, largest items first, ties in the order given.

    Bins stand in order of what is left in them.  An item goes to the first bin from
    its size upwards that has neither its source nor its cluster: the tightest one
    that may take it.  A bin keeps the sources and clusters in it as bits of one number; -1 conflicts with nothing.
    """
    bits: dict[tuple[int, int], int] = {}
    left: list[tuple[int, int]] = []  # (room, bin), in order
    held: list[int] = []
    out = [0] * len(sizes)
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size, mask = sizes[item], 0
        for kind, value in ((0, sources[item]), (1, clusters[item])):
            if value >= 0:
                mask |= 1 << bits.setdefault((kind, value), len(bits))
        at = bisect_left(left, (size, -1))
        while at < len(left) and held[left[at][1]] & mask:
            at += 1
        if at < len(left):
            room, bin_ = left.pop(at)
        else:
            room, bin_ = capacity, len(held)
            held.append(0)
        held[bin_] |= mask
        insort(left, (room - size, bin_))
        out[item] = bin_
    return out


def _codes(values: list) -> list[int]:
    """Small numbers for the values that occur twice or more, -1 for the others and nulls."""
    seen: dict = {}
    for v in values:
        seen[v] = seen.get(v, 0) + 1
    number = {v: k for k, v in enumerate(v for v, n in seen.items() if n > 1 and v is not None)}
    return [number.get(v, -1) for v in values]


def _pack(capacity: int):
    def pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("row", "ascending")])
        block = key[0].as_py()
        ids, total = table.column("doc_id").to_pylist(), table.column("size").to_pylist()
        sources, clusters = _codes(table.column("source").to_pylist()), _codes(table.column("cluster").to_pylist())
        # A long text is cut before the character that would not fit; what remains after the last cut is packed with others.
        cuts = [[0, *c] for c in table.column("cuts").to_pylist()]
        rest = [n - c[-1] for n, c in zip(total, cuts)]
        open_ = [i for i, n in enumerate(total) if rest[i] or not n]
        bins = best_fit([rest[i] for i in open_], [sources[i] for i in open_], [clusters[i] for i in open_], capacity)
        used = max(bins, default=-1) + 1
        rows, start = [], np.zeros(used + 1, np.int64)
        of = dict(zip(open_, bins))
        for i, n in enumerate(total):
            for piece, (since, until) in enumerate(zip(cuts[i], cuts[i][1:])):
                rows.append((ids[i], piece, used, 0, until - since, since))
                used += 1
            if i in of:
                rows.append((ids[i], len(cuts[i]) - 1, of[i], int(start[of[i]]), rest[i], cuts[i][-1]))
                start[of[i]] += rest[i]
        doc, piece, bin_, at, size, text_start = zip(*rows)
        high = block << LOCAL_BITS
        return pa.table(
            {
                "doc_id": pa.array(doc, pa.int64()),
                "piece": pa.array(piece, pa.int32()),
                "bin_id": pa.array([high + b for b in bin_], pa.int64()),
                "bin_start": pa.array(at, pa.int64()),
                "size": pa.array(size, pa.int64()),
                "text_start": pa.array(text_start, pa.int64()),
            }
        )

    return pack


def cuts_of(capacity: int):
    """Column function: text to the bytes at which pieces after the first begin; none for a text that fits.

    Each piece ends before the character that would not fit in ``capacity`` bytes, so that it can be read
    by itself; only where a single character does not fit is it cut inside.
    """

    @F.arrow_udf("array<bigint>")
    def cuts(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts:
            raw = b"" if not text.is_valid else text.as_buffer().to_pybytes()
            at, found = 0, []
            while len(raw) - at > capacity:
                end = at + capacity
                while end > at and raw[end] & 0xC0 == 0x80:
                    end -= 1
                at = end if end > at else at + capacity
                found.append(at)
            out.append(found)
        return pa.array(out, pa.list_(pa.int64()))

    return cuts


def pack_documents(
    docs: DataFrame,
    capacity: int = CAPACITY,
    block_rows: int = BLOCK_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str | None = "source",
    cluster_col: str | None = None,
) -> DataFrame:
    """Where each document's bytes go: ``doc_id``, ``piece``, ``bin_id``, ``bin_start``, ``size``, ``text_start``.

    Sizes are UTF-8 bytes.  No two documents of one source, and no two of one
    duplicate cluster, share a bin; the cluster is ``cluster_col``, or else the text
    without white space.  A text longer than a bin is cut between characters into bins of its own, and its
    rest is packed like a short text; so every byte has one place, and every piece is text.

    Rows are dealt evenly over blocks of about ``block_rows`` by their place in a
    written table, and each block is packed alone, largest first.  A hot source or
    cluster is spread over all blocks; the bins it needs are as many as its rows.

    Null and empty texts have size 0 and take part as such; a null source or cluster
    conflicts with nothing.  Repeated rows are one cluster and get bins of
    their own.  Extra columns are not read.
    """
    text = F.coalesce(text_col, F.lit(""))
    source = F.xxhash64(F.col(source_col)) if source_col else F.lit(None).cast("bigint")
    cluster = F.xxhash64(F.col(cluster_col)) if cluster_col else F.xxhash64(normalised(F.col(text_col)))
    known = lambda c, v: F.when(F.col(c).isNotNull(), v) if c else v
    narrow = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.octet_length(text).cast("bigint").alias("size"),
        F.coalesce(cuts_of(capacity)(F.when(F.octet_length(text) > capacity, text)), F.array().cast("array<bigint>")).alias("cuts"),
        known(source_col, source).alias("source"),
        known(cluster_col, F.when(F.octet_length(text) > 0, cluster)).alias("cluster"),
    )
    narrow = write_shared(narrow, "sizes")
    blocks = max(1, -(-narrow.count() // block_rows))
    row = F.monotonically_increasing_id()
    dealt = narrow.withColumn("row", row).withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    return dealt.groupBy("block").applyInArrow(_pack(capacity), OUT)
