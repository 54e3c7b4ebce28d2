"""Top-k, collocations and ranked search: SQL, brute force, several waves, shards and blocks, odd rows."""

from __future__ import annotations

import math
import os
import re
from collections import Counter
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltwork.llm import collocations as C
from siltwork.llm import tokens, topk
from siltwork.llm import words as W
from siltwork.llm.collocations import collocations
from siltwork.llm.lexical import Heaps, TermIndex, ranked_search
from siltwork.llm.queries import LLM_ORACLES, LLM_QUERIES
from siltwork.llm.topk import Shard, max_score, top_k
from siltwork.shared import shared_root
from tests.oracle import connect, difference

LEARNED = os.environ.get("TEST_LEARN_DIR", "/root/testdata/sf0.01")
tables = pytest.mark.skipif(not os.path.isdir(LEARNED), reason="no test tables")

CLASHES = ["row", "v", "cell", "asks", "shard", "block", "n", "h", "phrase", "floor", "a", "l", "r", "score", "term", "terms", "_item", "rank", "a.b"]


def clashing(df):
    return df.withColumns({c: F.lit(f"x{k}") for k, c in enumerate(CLASHES) if c not in df.columns}).withColumn("pairs", F.create_map(F.lit("k"), F.lit(1)))


@tables
@pytest.mark.parametrize("name", ["op11_max_score_top_k", "op12_phrase_collocations", "op13_ranked_search"])
def test_queries_against_sql(spark, name):
    assert difference(LLM_QUERIES[name](spark, LEARNED), connect(LEARNED), LLM_ORACLES[name]) is None


def best_of(vectors, ids, query, own, top):
    scores = [(-sum(a * b for a, b in zip(v, vectors[query])), math.inf if ids[k] is None else ids[k], k) for k, v in enumerate(vectors) if k != own]
    return [(-s, i) for s, i, _ in sorted(scores)[:top]]


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_max_score_against_brute_force(data):
    width, big = data.draw(st.integers(0, 6)), data.draw(st.sampled_from([1, 3, 300, 1 << 26]))
    vectors = data.draw(st.lists(st.lists(st.integers(-big, big), min_size=width, max_size=width), min_size=1, max_size=40))
    ids = [k // 2 for k in range(len(vectors))]
    shard = Shard(np.array(ids), np.arange(len(vectors)), np.array(vectors, np.int64).reshape(len(vectors), width).T)
    for query in range(0, len(vectors), 7):
        found = max_score(shard, np.array(vectors[query], np.int64), query, 3)
        assert list(zip(found.score.tolist(), found.id.tolist())) == best_of(vectors, ids, query, query, 3)


def test_max_score_over_stripes(monkeypatch):
    monkeypatch.setattr(topk, "STRIPE", 16)
    rng = np.random.default_rng(3)
    vectors = np.floor(256 * rng.normal(size=(500, 24)) * (rng.random((500, 24)) < 0.5)).astype(np.int64)
    vectors[400:430] = vectors[7]
    shard = Shard(np.arange(500), np.arange(500), vectors.T)
    for query in range(0, 500, 13):
        found = max_score(shard, vectors[query], query, 5)
        assert list(zip(found.score.tolist(), found.id.tolist())) == best_of(vectors.tolist(), list(range(500)), query, query, 5)


def test_top_k_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, -0.5]), (0, [1.0, -0.5]), (50, [0.25]), (None, [2.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, None), (6, [1.0, None]),
        (7, []), (8, [1e30, 0.0]), (100, [-1.0, 1.0, 1.0]), (101, [1.0, -0.5]),
    ]
    vectors = clashing(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"))
    found = top_k(vectors, shard_rows=2).collect()
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) and abs(x) < 1e9 for x in v)]
    expected = []
    for k, (query, v) in enumerate(usable):
        if query is None or query % 50:
            continue
        scores = sorted(((-sum(a * b for a, b in zip(v, w)), i is None, i or 0) for j, (i, w) in enumerate(usable) if j != k))[:5]
        expected += [(query, rank + 1, None if none else i, -s) for rank, (s, none, i) in enumerate(scores)]
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    assert top_k(vectors.where("false")).count() == 0
    assert top_k(vectors.where("vec_id = 101")).count() == 0
    assert top_k(vectors.where("vec_id = 50")).count() == 0


def words_of(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [re.findall(r"[^ \t]+", piece) for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", lower)]


def plain_collocations(rows, top, least):
    out = []
    for lang in {x or "und" for _, x in rows}:
        f = Counter()
        for text, own in rows:
            if (own or "und") == lang:
                f.update(tuple(w[i : i + k]) for w in words_of(text) for k in (1, 2, 3) for i in range(len(w) - k + 1))
        n = sum(c for g, c in f.items() if len(g) == 1)
        good = {}
        for g, a in f.items():
            if len(g) > 1 and a >= least:
                good[g] = (a, *min(((1_000_000 * a * a // (f[g[:k]] * f[g[k:]])), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g))))
        drop = {g[i : i + 2] for g in good if len(g) == 3 for i in (0, 1) if 100 * f[g] >= 50 * f[g[i : i + 2]]}
        rank = sorted((-s, -a, " ".join(g).encode(), l, r) for g, (a, s, _, l, r) in good.items() if g not in drop)
        out += [(lang, k + 1, g.decode(), -a, l, r, n, -s) for k, (s, a, g, l, r) in enumerate(rank[:top])]
    return sorted(out)


def test_collocations_take_several_waves(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(120):
        words = [f"W{int(x) % 40}é" for x in rng.zipf(1.3, 200)]
        words[:3] = ["new", "York", "city"] if k % 2 else ["new", "york", "x"]
        rows.append((" ".join(words[:90]) + ("; " if k % 3 else ",\t") + "\t ".join(words[90:]), [None, "en", "und", "fr"][k % 4]))
    # Pairs that are always together and yet go, for a common word follows every other time: the first wave settles none.
    rows += [(f"p{k} q{k} the. p{k} q{k}! the. " * 4, "en") for k in range(40)]
    docs = clashing(spark.createDataFrame(rows, "text string, lang string"))
    waves = []
    own = C._wave
    monkeypatch.setattr(C, "_wave", lambda *a: waves.append(1) or own(*a))
    for top, bits in ((7, 1 << 27), (60, 1 << 15), (5000, 1 << 27)):
        monkeypatch.setattr(C.Filter.__init__, "__defaults__", (bits,))
        found = collocations(docs, top=top, least=4).collect()
        assert sorted(map(tuple, found)) == plain_collocations(rows, top, 4)
    assert len(waves) >= 4


def test_collocations_odd_rows(spark):
    rows = [(None, "en"), ("", None), ("a b " * 30, None), ("a b " * 30, None), ("x\x00y z! " * 12, "en"), ("very " * 100_000, "fr"), (" .,;\n", "fr")]
    docs = clashing(spark.createDataFrame(rows, "text string, lang string"))
    assert sorted(map(tuple, collocations(docs).collect())) == plain_collocations(rows, 2000, 10)
    assert collocations(docs.where("false")).count() == 0
    assert collocations(docs.where("text IS NULL")).count() == 0


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_collocations_write_few_files(spark, adaptive):
    """A file for each task of a shuffle, each with a process for its mode, doubled what an executor seemed to hold."""
    rows = [(" ".join(f"w{j % 7} v{j * k % 50}" for j in range(60)), ["en", "fr"][k % 2]) for k in range(40)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    root = Path(shared_root(spark).removeprefix("file:"))
    before = set(root.glob("*")) if root.is_dir() else set()
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.enabled": adaptive}
    old = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        found = collocations(docs, top=50, least=4).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted(map(tuple, found)) == plain_collocations(rows, 50, 4)
    files = {p.name: len(list(p.glob("part-*"))) for p in set(root.glob("*")) - before}
    assert files and max(files.values()) <= spark.sparkContext.defaultParallelism


def test_collocations_keep_frequent_words_and_totals(spark):
    docs = spark.createDataFrame([("a a b a. c", "en"), ("c d a", "fr")], "_text string, lang string").select("lang", "_text")
    found = C._words(docs, 2).select("lang", "phrase", "n").collect()
    assert sorted(map(tuple, found), key=str) == [("en", "a", 3), ("en", None, 2), ("fr", None, 3)]


def test_hashes_are_counted_over_chunks(monkeypatch):
    monkeypatch.setattr(W, "CHUNK", 64)
    every = SimpleNamespace(value=SimpleNamespace(holds=lambda h: np.ones(len(h), bool)))
    batch = pa.RecordBatch.from_pydict({"lang": pa.array(["en", None] * 50), "_text": pa.array(["a b c. A B", "b c"] * 50)})
    for held, sent, rows in ((1 << 20, 1 << 16, 3), (1 << 20, 2, 3), (20, 1 << 16, None)):
        monkeypatch.setattr(C, "HELD", held)
        monkeypatch.setattr(C, "SENT", sent)
        batches = list(C._grams(2, every, every, None)(iter([batch, batch])))
        assert max(b.num_rows for b in batches) <= sent
        counts = Counter()
        for b in batches:
            counts.update(dict(zip(b["h"].to_pylist(), b["n"].to_pylist())))
        assert sorted(counts.values()) == [100, 100, 200]
        assert rows in (None, sum(b.num_rows for b in batches))


def test_words_of_one_hash_stay_apart():
    raw = np.frombuffer(b"abc abd ab abc", np.uint8)
    starts, ends = np.array([0, 4, 8, 11]), np.array([3, 7, 10, 14])
    codes, lead = tokens.codes_of(raw, starts, ends, np.zeros(4, np.uint64))
    assert codes.tolist() == [0, 1, 2, 0] and lead.tolist() == [0, 1, 2]
    assert tokens.joined(raw, starts, ends, [np.array([0, 2]), np.array([1, 3])]).to_pylist() == ["abc abd", "ab abc"]
    index = TermIndex(pa.table({"_item": [4, 4, 9], "term": pa.array([b"abd", b"zz", b"abc"], pa.binary())}))
    index.hashes = np.zeros(3, np.uint64)
    found = index.find(raw, starts, ends, np.zeros(4, np.uint64))
    names = [None if k < 0 else index.raw[index.starts[k] : index.ends[k]].tobytes() for k in found]
    assert names == [b"abc", b"abd", None, b"abc"]


def plain_search(docs, items, top):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    terms = lambda t: pattern.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
    counts = [(i, Counter(terms(t))) for i, t in docs]
    size, length = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c in counts:
            m = 10 + 90 * sum(c.values()) * size // max(length, 1)
            score = sum(math.floor(1000 * math.log((2 * size + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t])
            scores += [(-score, doc is None, doc or 0)] * (score > 0)
        out += [(item, k + 1, None if none else doc, -s) for k, (s, none, doc) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def test_ranked_search_in_blocks_and_odd_rows(spark):
    rng = np.random.default_rng(11)
    docs = [(k, " ".join(f"T{int(x) % 60}é-Z{int(x) % 7}" for x in rng.zipf(1.4, 5 + k))) for k in range(80)]
    docs += [(None, docs[20][1]), (20, docs[20][1]), (20, docs[20][1]), (90, None), (91, ""), (92, " -- \n"), (93, "word " * 200_000)]
    items = [(k, docs[7 * k][1]) for k in range(8)] + [(3, "t1é"), (None, "WORD"), (9, None), (10, "nowhere"), (11, ""), (3, "t1é")]
    docs_frame = clashing(spark.createDataFrame(docs, "doc_id bigint, text string"))
    items_frame = clashing(spark.createDataFrame(items, "item_id bigint, text string"))
    expected = plain_search(docs, items, 10)
    for postings in (1_000_000, 60):
        found = ranked_search(docs_frame, items_frame, index_postings=postings).collect()
        assert sorted(map(tuple, found), key=str) == expected
    assert ranked_search(docs_frame.where("false"), items_frame).count() == 0
    assert ranked_search(docs_frame, items_frame.where("false")).count() == 0
    assert ranked_search(docs_frame, items_frame.where("text IS NULL")).count() == 0


def test_heaps_keep_the_best_over_offers():
    rng = np.random.default_rng(2)
    item, score, doc = rng.integers(0, 5, 3000), rng.integers(0, 30, 3000), rng.permutation(3000)
    heaps = Heaps(5, 10)
    for part in np.array_split(np.arange(3000), 37):
        heaps.offer(item[part], score[part], doc[part])
    for k in range(5):
        expected = sorted(zip((-score[item == k]).tolist(), doc[item == k].tolist()))[:10]
        mine = heaps.item == k
        assert list(zip((-heaps.score[mine]).tolist(), heaps.doc[mine].tolist())) == expected
