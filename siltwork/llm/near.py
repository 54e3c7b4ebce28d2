"""Near-duplicate documents: MinHash signatures joined by a multi-index over Hamming distance.

Each distinct shingle set has a signature of ``HEAD`` symbols of 16 bits and
a sample of one hash in each of ``BINS`` ranges, cut to 8 bits.  The head is split into ``CHUNKS`` chunks.  Two heads that
differ in at most ``2 * CHUNKS - 1`` symbols have a chunk with at most one
differing symbol (pigeonhole), so each chunk gives one key for each symbol left
out, and every such pair meets under a key.  Sets with a Jaccard similarity of
0.8 differ in 9.6 of 48 symbols on average and in 24 or more once in 300,000 pairs.
The sample rules out pairs that are clearly less similar: its share of differing
ranges is taken without replacement, and a pair at the threshold exceeds
``DEVIATIONS`` standard deviations of it about once in 50 million pairs.

Links are confirmed on full sets.  Under a key, rows are first held against two
of them only, one of them the row that meets the most others over all its keys;
what that joins is one component.  Then pairs of different components that
share a key are compared by signature inside the join, and the near ones
confirmed one by one.  Under a key, the rows of its largest component are not
held against each other: a large group of copies costs its size times the rows
outside it.  Where many rows meet that are not near, as around a passage that
many documents share, keys are parted once more: heads in reach of each other have
``HEAD - DISTANCE`` symbols in common, so one of these is among the
``PREFIX`` rarest of both, and rows meet under a key and such a symbol.  No link
between components is left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltwork.llm import words as W
from siltwork.llm.components import components
from siltwork.shared import write_shared

HEAD, CHUNKS, BINS = 48, 12, 512
PER_CHUNK = HEAD // CHUNKS
DISTANCE, DEVIATIONS = 2 * CHUNKS - 1, 5.5
PREFIX = DISTANCE + 1
SYMBOLS = 1 << 16
CROWD = 100_000  # pairs under a key from which it may be parted by symbols
FACTORS = W.seeds(HEAD, 11)
SHIFTS = W.seeds(HEAD, 13)
BIN_SHIFT = np.uint64(64 - BINS.bit_length() + 1)
SIGNED = ("n", "head", "sample")
SKETCH = "struct<n:bigint,node:bigint,head:array<bigint>,sample:array<bigint>>"


def _row_fold(values: np.ndarray, bounds: np.ndarray, fold: np.ufunc) -> np.ndarray:
    """``fold`` over each non-empty row of ``values``."""
    return fold.reduceat(values, bounds[:-1]) if len(values) else values


def _longs(rows: list[np.ndarray], width: int) -> pa.Array:
    """Rows of small symbols as lists of 64-bit numbers."""
    packed = np.concatenate(rows).view(np.int64) if rows else np.zeros((0, width), np.int64)
    offsets = np.arange(len(packed) + 1, dtype=np.int32) * width
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(packed.ravel()))


def _nodes(found: np.ndarray, bounds: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprint of each row's set, the rows that have one, and where they stand."""
    full = np.flatnonzero(n > 0)
    edges = np.append(bounds[:-1][full], len(found))
    node = np.zeros(len(n), np.uint64)
    if len(full):
        node[full] = W.mix(_row_fold(W.mix(found + W.STEP), edges, np.add) + n[full].astype(np.uint64))
    return node.view(np.int64), full, edges


def sketch_of(width: int):
    """Column function: text to set size, 64-bit set fingerprint and signature."""

    @F.arrow_udf(SKETCH)
    def sketch(texts: pa.Array) -> pa.Array:
        sizes, nodes, heads, samples = [], [], [], []
        for _, raw, offsets in W.text_chunks(texts):
            found, bounds = W.shingle_sets(W.words(raw, offsets), width)
            n = np.diff(bounds)
            node, full, edges = _nodes(found, bounds, n)
            head = np.zeros((len(n), HEAD), np.uint16)
            sample = np.zeros((len(n), BINS), np.uint8)
            if len(full):
                for k in range(HEAD):
                    least = _row_fold(found * FACTORS[k] + SHIFTS[k], edges, np.minimum)
                    head[full, k] = W.mix(least).astype(np.uint16)
                # sets are sorted, so the first hash of a range is its smallest
                cell = np.repeat(np.arange(len(n)) * BINS, n) + (found >> BIN_SHIFT).astype(np.int64)
                lead = np.flatnonzero(np.diff(cell, prepend=-1))
                sample.reshape(-1)[cell[lead]] = found[lead] % np.uint64(255) + np.uint64(1)
            sizes.append(n)
            nodes.append(node)
            heads.append(head)
            samples.append(sample)
        n = pa.array(np.concatenate(sizes) if sizes else np.zeros(0, np.int64))
        node = pa.array(np.concatenate(nodes) if nodes else np.zeros(0, np.int64))
        lists = [_longs(heads, CHUNKS), _longs(samples, BINS // 8)]
        return pa.StructArray.from_arrays([n, node, *lists], ["n", "node", "head", "sample"])

    return sketch


@F.arrow_udf(T.ArrayType(T.LongType()))
def index_keys(heads: pa.Array) -> pa.Array:
    """A key for each symbol of a head: the other symbols of its chunk."""
    s = np.asarray(heads.flatten()).view(np.uint16).reshape(-1, HEAD).astype(np.uint64)
    out = np.empty(s.shape, np.uint64)
    for k in range(HEAD):
        chunk = k // PER_CHUNK * PER_CHUNK
        key = np.full(len(s), SHIFTS[k], np.uint64)
        for j in range(chunk, chunk + PER_CHUNK):
            if j != k:
                key = key * W.STEP + s[:, j]
        out[:, k] = W.mix(key)
    offsets = np.arange(len(s) + 1, dtype=np.int32) * HEAD
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.view(np.int64).ravel()))


def _tokens(heads: pa.Array) -> np.ndarray:
    """A number for each symbol at its place in the head."""
    s = np.asarray(heads.flatten()).view(np.uint16).reshape(-1, HEAD).astype(np.int64)
    return s + np.arange(HEAD) * SYMBOLS


def _count_symbols(batches):
    """Rows (token, n), summed over a task."""
    seen = np.zeros(HEAD * SYMBOLS, np.int64)
    for batch in batches:
        seen += np.bincount(_tokens(batch.column(0)).ravel(), minlength=len(seen))
    used = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(seen[used])], ["token", "n"])


def rarest_symbols(heads: DataFrame):
    """Column function: head to its ``PREFIX`` rarest symbols, by their counts over ``heads``.

    The counts that reach the driver and the tasks are ``HEAD * SYMBOLS`` at most, 25 MB, whatever the input.
    """
    counted = heads.mapInArrow(_count_symbols, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(HEAD * SYMBOLS, np.int64)
    counts[counted.column("token").to_numpy()] = counted.column("n").to_numpy()
    shared = heads.sparkSession.sparkContext.broadcast(counts)

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def rarest(heads: pa.Array) -> pa.Array:
        tokens = _tokens(heads)
        order = np.lexsort((tokens, shared.value[tokens]))[:, :PREFIX]
        offsets = np.arange(len(tokens) + 1, dtype=np.int32) * PREFIX
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.take_along_axis(tokens, order, 1).ravel()))

    return rarest


def _differing(x: Column, y: Column, bits: int) -> Column:
    """How many of the symbols of ``bits`` bits in two 64-bit numbers differ."""
    fold, step = x.bitwiseXOR(y), bits // 2
    while step:
        fold = fold.bitwiseOR(F.shiftrightunsigned(fold, step))
        step //= 2
    return F.bit_count(fold.bitwiseAND(F.lit(sum(1 << at for at in range(0, 64, bits)))))


def _distance(a: str, b: str, bits: int) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: _differing(x, y, bits)), F.lit(0), lambda s, x: s + x)


def _may_link(a: str, b: str, percent: int) -> Column:
    """False where heads are too far apart or the samples rule the similarity out.

    The limit is that of a pair just at the threshold: its union has ``union``
    hashes, which are expected to use ``used`` ranges.
    """
    share = 1 - percent / 100
    union = (F.col(f"{a}_n") + F.col(f"{b}_n")) / (2 - share)
    empty = F.exp(-union / BINS)
    used = BINS * (1 - empty)
    varies = BINS * empty * F.greatest(F.lit(0.0), 1 - (1 + union / BINS) * empty)
    spread = F.sqrt(share * (1 - share) * used * F.greatest(F.lit(0.0), 1 - used / union) + share * share * varies)
    limit = share * used + DEVIATIONS * spread + 2
    return (_distance(f"{a}_head", f"{b}_head", 16) <= DISTANCE) & (_distance(f"{a}_sample", f"{b}_sample", 8) <= limit)


def _first_meeting(place: str, a: str, b: str) -> Column:
    """True for one of the keys under which two heads meet: the first of the first chunk that has one."""
    chunk = F.floor(F.col(place) / PER_CHUNK)
    here = _differing(F.element_at(a, (chunk + 1).cast("int")), F.element_at(b, (chunk + 1).cast("int")), 16)
    earlier = F.lit(False)
    for c in range(CHUNKS - 1):
        earlier = earlier | ((F.lit(c) < chunk) & (_differing(F.col(a)[c], F.col(b)[c], 16) <= 1))
    return ((here == 1) | (F.col(place) % PER_CHUNK == 0)) & ~earlier


def sets_of(width: int):
    """Column function: text to fingerprint and sorted distinct shingle hashes."""

    @F.arrow_udf("struct<node:bigint,shingles:array<bigint>>")
    def sets(texts: pa.Array) -> pa.Array:
        nodes, offsets, values, last = [], [np.zeros(1, np.int64)], [], 0
        for _, raw, where in W.text_chunks(texts):
            found, bounds = W.shingle_sets(W.words(raw, where), width)
            nodes.append(_nodes(found, bounds, np.diff(bounds))[0])
            offsets.append(bounds[1:] + last)
            values.append(found.view(np.int64))
            last += len(found)
        node = pa.array(np.concatenate(nodes) if nodes else np.zeros(0, np.int64))
        flat = pa.array(np.concatenate(values) if values else np.zeros(0, np.int64))
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(offsets).astype(np.int32)), flat)
        return pa.StructArray.from_arrays([node, lists], ["node", "shingles"])

    return sets


def _ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough; ``pairs`` are distinct nodes ``a < b``.

    Sets are made again from the text of one document for each node, so they
    are kept only for nodes that have a candidate.
    """
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = classes.join(ends, "node").select("node", F.col("id").alias("_id"))
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text"))
    found = texts.join(wanted, F.col("_doc").eqNullSafe(F.col("_id"))).select("node", sets_of(width)("_text").alias("_set"))
    found = found.where(F.col("node") == F.col("_set.node")).select("node", F.col("_set.shingles").alias("set"))
    found = write_shared(found, "sets")
    both = (
        pairs.join(found.select(F.col("node").alias("a"), F.col("set").alias("_sa")), "a")
        .join(found.select(F.col("node").alias("b"), F.col("set").alias("_sb")), "b")
        .select("a", "b", F.size("_sa").alias("_na"), F.size("_sb").alias("_nb"), F.size(F.array_intersect("_sa", "_sb")).alias("_c"))
    )
    return both.where(100 * F.col("_c") >= percent * (F.col("_na") + F.col("_nb") - F.col("_c"))).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, percent: int = 80, crowd: int = CROWD) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` for each row of ``docs``.

    Two documents are linked when ``100 * common >= percent * union`` over their
    sets of ``width``-word shingles; a component is what links reach, and its
    id the smallest document id in it.

    Null, empty and blank texts have an empty set and are linked with nothing.
    A null id never names a component unless all its rows have none; such a
    component has a null id, and its rows are kept.  Equal sets are one class, so
    repeated rows and ties cost one row.  Repeated ids: rows of one id stay
    apart unless their texts are linked.  Extra columns are not read.
    """
    sketched = docs.select(F.col(id_col).alias("id"), sketch_of(width)(text_col).alias("s"))
    sketched = write_shared(sketched.select("id", "s.*"), "sketches")
    first = [F.first(c).alias(c) for c in SIGNED]
    classes = write_shared(sketched.where("n > 0").groupBy("node").agg(F.min("id").alias("id"), *first), "classes")

    rows = classes.select("node", F.posexplode(index_keys("head")).alias("place", "key"))
    shared = write_shared(rows.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1"), "keys")
    rows = write_shared(rows.join(shared, "key"), "buckets")
    met = write_shared(rows.groupBy("node").agg(F.sum("rows").alias("met")), "met")
    central = F.max(F.struct("met", "node"))["node"].alias("central")
    centers = rows.join(met, "node").groupBy("key").agg(central, F.min("node").alias("low"))
    stars = rows.join(write_shared(centers, "centers"), "key")
    stars = stars.select("node", F.explode(F.array("central", "low")).alias("center")).where("node != center")
    near = write_shared(_near_pairs(stars.select(*_ordered("node", "center")).distinct(), classes, percent), "pairs")
    links = write_shared(confirmed(near, classes, docs, id_col, text_col, width, percent), "links")
    labels = components(links)

    placed = write_shared(_relabel(rows.select("key", "place", "node"), labels), "buckets")
    left = _parted(placed, classes, crowd)
    left = write_shared(left.join(classes.select("node", *SIGNED), "node"), "split")
    sides = ("key", "part"), ("place", "node", "label", "minor", *SIGNED)
    x, y = (left.select(*sides[0], *[F.col(c).alias(f"{side}_{c}") for c in sides[1]]) for side in "xy")
    once = (F.col("x_label") < F.col("y_label")) | ~F.col("y_minor")
    close = (
        x.where("x_minor")
        .join(y, ["key", "part"])
        .where((F.col("x_label") != F.col("y_label")) & once & _sizes_fit("x_n", "y_n", percent))
        .where(_first_meeting("x_place", "x_head", "y_head"))
        .where(_may_link("x", "y", percent))
        .select(*_ordered("x_node", "y_node"))
        .distinct()
        .join(near, ["a", "b"], "left_anti")
    )
    more = confirmed(write_shared(close, "pairs"), classes, docs, id_col, text_col, width, percent)
    named = more.join(labels.select(F.col("node").alias("a"), F.col("label").alias("_la")), "a", "left")
    named = named.join(labels.select(F.col("node").alias("b"), F.col("label").alias("_lb")), "b", "left")
    over = components(named.select(F.coalesce("_la", "a").alias("a"), F.coalesce("_lb", "b").alias("b")))
    over = over.select(F.col("node").alias("label"), F.col("label").alias("_top"))

    label = _relabel(classes.select("node", "id"), labels).join(over, "label", "left")
    label = write_shared(label.select("node", "id", F.coalesce("_top", "label").alias("label")), "labels")
    names = label.groupBy("label").agg(F.min("id").alias("component_id"))
    named = write_shared(label.join(names, "label").select("node", "component_id"), "names")
    out = sketched.join(named, "node", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def _parted(placed: DataFrame, classes: DataFrame, crowd: int) -> DataFrame:
    """Rows of the buckets that hold several components: ``key``, ``part``, ``place``, ``node``, ``label``, ``minor``.

    ``minor`` rows are those outside the bucket's largest component; each pair of different
    components has one.  ``part`` is -1 where a bucket stays whole.  A bucket with
    ``crowd`` pairs or more comes once for each of the rarest symbols of a row
    that another row has too, if that leaves less than half the pairs.
    """
    sizes = placed.groupBy("key", "label").agg(F.count("*").alias("rows"))
    sizes = sizes.groupBy("key").agg(F.max(F.struct("rows", "label")).alias("top"), F.sum("rows").alias("rows"), F.count("*").alias("labels"))
    pairs = (F.col("rows") - F.col("top.rows")) * F.col("rows")
    split = sizes.where("labels > 1").select("key", F.col("top.label").alias("main"), pairs.alias("pairs"))
    columns = "key", "place", "node", "label", "minor"
    left = placed.join(write_shared(split, "keys"), "key").withColumn("minor", F.col("label") != F.col("main"))
    left = write_shared(left.select(*columns, "pairs"), "split")
    whole, crowded = left.where(F.col("pairs") < crowd), left.where(F.col("pairs") >= crowd)
    whole = whole.select(*columns, F.lit(-1).cast("bigint").alias("part"))
    if crowded.isEmpty():
        return whole
    heads = write_shared(classes.select("node", "head").join(crowded.select("node").distinct(), "node"), "heads")
    rare = write_shared(heads.select("node", rarest_symbols(heads.select("head"))("head").alias("rare")), "symbols")
    parts = write_shared(crowded.join(rare, "node").select(*columns, "pairs", F.explode("rare").alias("part")), "parts")
    shared = parts.groupBy("key", "part").agg(F.count("*").alias("rows"), F.sum(F.col("minor").cast("bigint")).alias("minors"), F.first("pairs").alias("pairs"))
    shared = write_shared(shared.where("rows > 1 AND minors > 0"), "parts")
    dense = shared.groupBy("key").agg(F.sum(F.col("rows") * F.col("minors")).alias("cost"), F.first("pairs").alias("pairs"))
    dense = write_shared(dense.where("2 * cost >= pairs").select("key"), "keys")
    stay = crowded.join(dense, "key", "left_semi").select(*columns, F.lit(-1).cast("bigint").alias("part"))
    met = shared.join(dense, "key", "left_anti").select("key", "part")
    return whole.unionByName(stay).unionByName(parts.join(met, ["key", "part"]).select(*columns, "part"))


def _relabel(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with the component label of ``node``, its own where it has no link."""
    found = rows.join(labels, "node", "left")
    return found.withColumn("label", F.coalesce("label", "node"))


def _sizes_fit(n: str, m: str, percent: int) -> Column:
    """False where set sizes alone rule the similarity out."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _near_pairs(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    one = classes.select(F.col("node").alias("a"), *[F.col(c).alias(f"a_{c}") for c in SIGNED])
    two = classes.select(F.col("node").alias("b"), *[F.col(c).alias(f"b_{c}") for c in SIGNED])
    found = pairs.join(one, "a").join(two, "b").where(_sizes_fit("a_n", "b_n", percent))
    return found.where(_may_link("a", "b", percent)).select("a", "b")
