"""Queries against SQL, or against brute force and held-out rows where SQL cannot say it."""

from __future__ import annotations

import os
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as driver
import corpus_pipeline
from siltwork.llm import near
from siltwork.llm import words as W
from siltwork.llm.decontamination import benchmark_matches, drop_contaminated
from siltwork.llm.language import codebook
from siltwork.llm.near import near_duplicates
from siltwork.llm.packing import CAPACITY, best_fit
from siltwork.llm.queries import LLM_ORACLES, LLM_QUERIES
from siltwork.llm.shards import jump
from siltwork.llm.toxicity import segments, toxicity
from siltwork.sinks.files import counted
from tests.oracle import connect, difference

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LEARNED = os.environ.get("TEST_LEARN_DIR", "/root/testdata/sf0.01")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
CAPITALS = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

tables = pytest.mark.skipif(not (os.path.isdir(FOLDER) and os.path.isdir(LEARNED)), reason="no test tables")


def texts_of(spark, folder):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}


def sets_of(texts, width):
    out = {}
    for key, text in texts.items():
        words = WORD.findall((text or "").translate(CAPITALS))
        runs = [tuple(words[k : k + width]) for k in range(len(words) - width + 1)]
        out[key] = set(runs or ([tuple(words)] if words else []))
    return out


def components_of(sets, percent=80):
    top = {k: k for k in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    where = defaultdict(list)
    for key in sorted(sets):
        shared = Counter(j for run in sets[key] for j in where[run])
        for j, n in shared.items():
            if 100 * n >= percent * (len(sets[key]) + len(sets[j]) - n):
                a, b = sorted((find(key), find(j)))
                top[b] = a
        for run in sets[key]:
            where[run].append(key)
    return {k: find(k) for k in sets}


@tables
def test_queries_are_registered():
    assert [q for q in driver.queries() if re.match(r"op\d+_", q)] and "pipeline" in driver.queries()
    assert {int(re.match(r"op(\d+)_", q)[1]) for q in LLM_QUERIES if q != "pipeline"} == set(range(1, 14))


@tables
@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_against_sql(spark, name):
    assert difference(LLM_QUERIES[name](spark, FOLDER), connect(FOLDER), LLM_ORACLES[name]) is None


@tables
def test_near_against_brute_force(spark):
    sets = sets_of(texts_of(spark, LEARNED), 4)
    want = components_of(sets)
    for r in LLM_QUERIES["op5_minhash_near_dedup"](spark, LEARNED).collect():
        assert (r["component_id"], r["n_shingles"], r["kept"]) == (want[r["doc_id"]], len(sets[r["doc_id"]]), r["doc_id"] == want[r["doc_id"]])


def test_near_in_one_large_group(spark):
    """Copies around a base, copies just beyond the threshold, and links between those only."""
    draw = np.random.default_rng(3)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for key in range(300):
        words = list(base)
        for at in draw.choice(120, size=int(draw.integers(1, 8)), replace=False):
            words[at] = f"x{draw.integers(0, 40)}"
        rows.append((1000 - key, " ".join(words)))
    want = components_of(sets_of(dict(rows), 4))
    assert 2 <= len(set(want.values())) < 300
    found = near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == want


@pytest.mark.parametrize("crowd", [1, 1_000_000])
def test_near_around_a_shared_passage(spark, crowd):
    """One passage in many texts, copies of one of them, and pairs of near copies among the rest; buckets parted or whole."""
    draw = np.random.default_rng(5)
    passage = [f"p{k}" for k in range(40)]
    rows = []
    for key in range(0, 240, 2):
        words = passage + [f"r{draw.integers(0, 5000)}" for _ in range(int(draw.integers(15, 60)))]
        again = list(words)
        for at in draw.choice(len(words), size=int(draw.integers(0, 6)), replace=False):
            again[at] = f"x{key}"
        rows += [(key, " ".join(words)), (key + 1, " ".join(again))]
    copies = rows[0][1].split()
    rows += [(1000 + k, " ".join([*copies[:-1], f"c{k}"])) for k in range(150)]
    want = components_of(sets_of(dict(rows), 4))
    assert 30 < len(set(want.values())) < 240
    found = near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), crowd=crowd)
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == want


def test_rarest_symbols_of_near_heads_meet(spark):
    """Heads within the distance share one of their rarest symbols, whatever the counts."""
    draw = np.random.default_rng(8)
    heads = draw.integers(0, 4, (60, near.HEAD)).astype(np.uint16)
    for k in range(30):  # half of them stand at the limit from another
        heads[30 + k] = heads[k]
        heads[30 + k, draw.choice(near.HEAD, near.DISTANCE, replace=False)] += 100
    rows = [(k, [int(x) for x in head.view(np.int64)]) for k, head in enumerate(heads)]
    table = spark.createDataFrame(rows, "id int, head array<bigint>")
    rare = {r["id"]: set(r["rare"]) for r in table.select("id", near.rarest_symbols(table.select("head"))("head").alias("rare")).collect()}
    assert all(len(x) == near.PREFIX for x in rare.values())
    close = [(i, j) for i in range(60) for j in range(i) if (heads[i] != heads[j]).sum() <= near.DISTANCE]
    assert len(close) >= 30 and all(rare[i] & rare[j] for i, j in close)


@tables
def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{LEARNED}/documents.parquet").select("doc_id", "lang")
    rows = LLM_QUERIES["op4_ecoc_language"](spark, LEARNED).where("held_out").join(docs, "doc_id").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows) > 0


@tables
def test_toxicity_on_held_out_rows(spark):
    labels = spark.read.parquet(f"{LEARNED}/labels.parquet").select("doc_id", "toxic")
    rows = LLM_QUERIES["op9_toxic_segments"](spark, LEARNED).where("held_out").join(labels, "doc_id").collect()
    bad, good = ([r["score"] for r in rows if r["toxic"] == k] for k in (1, 0))
    assert np.mean([(x > y) + 0.5 * (x == y) for x in bad for y in good]) >= 0.9
    assert sum(r["predicted"] for r in rows if r["toxic"] == 0) <= 0.03 * len(good)


@tables
def test_secrets_after_an_observed_count(spark):
    frame, seen = counted(spark.range(3))
    assert frame.count() == 3 and seen.get == {"amount": 3}
    scored = LLM_QUERIES["op10_secret_scan"](spark, LEARNED).select("score").collect()
    assert len({r["score"] for r in scored}) > 2  # a forest was fitted and sent to tasks


@tables
def test_secrets_on_held_out_rows(spark):
    texts = texts_of(spark, LEARNED)
    rows = LLM_QUERIES["op10_secret_scan"](spark, LEARNED).where("held_out").collect()
    value = lambda r: texts[r["doc_id"]].encode()[r["start"] : r["start"] + r["length"]].decode()
    true = [bool(re.fullmatch(r"AKIA[0-9A-Z]{16}|(?=.*[a-f])[0-9a-f]{12,}", value(r))) for r in rows]
    assert rows and np.mean([a == r["is_secret"] for a, r in zip(true, rows)]) >= 0.95


@tables
def test_benchmark_against_brute_force(spark):
    plain = re.compile(r"[^\W_]+")
    where = defaultdict(set)
    for r in spark.read.parquet(f"{LEARNED}/benchmark.parquet").collect():
        words = plain.findall(r["text"].lower())
        for k in range(len(words) - 12):
            where[tuple(words[k : k + 13])].add(r["item_id"])
    want = set()
    for key, text in texts_of(spark, LEARNED).items():
        words = plain.findall(text.lower())
        want |= {(key, i) for k in range(len(words) - 12) for i in where.get(tuple(words[k : k + 13]), ())}
    assert {(r["doc_id"], r["item_id"]) for r in LLM_QUERIES["op8_template_decontamination"](spark, LEARNED).collect()} == want


def test_benchmark_in_other_words(spark):
    item = "A train leaves with Anna and 30 boxes at 40 km per hour while Anna waits 30 minutes for the next one"
    texts = [
        (1, "Intro. " + item.replace("Anna", "Otto Maria").replace("30", "75").replace("40 km", "90 miles") + " Outro."),
        (2, item.replace("Anna", "Otto", 1).replace("Anna", "Rita").replace("30", "75", 1)),  # two values for one slot
        (3, "a train leaves the town and that is all there is to say of it"),
        (4, item.upper()),
    ]
    found = benchmark_matches(spark.createDataFrame(texts, "doc_id bigint, text string"), spark.createDataFrame([(7, item)], "item_id bigint, text string"))
    rows = {r["doc_id"]: r for r in found.collect()}
    assert not rows[1]["verbatim"] and rows[1]["consistency"] == 1.0 and 3 not in rows
    loose = benchmark_matches(spark.createDataFrame(texts, "doc_id bigint, text string"), spark.createDataFrame([(7, item)], "item_id bigint, text string"), consistent=0.0)
    assert {r["doc_id"]: r["consistency"] < 1 for r in loose.collect()}[2]
    joined = benchmark_matches(spark.createDataFrame(texts, "doc_id bigint, text string"), spark.createDataFrame([(7, item)], "item_id bigint, text string"), index_windows=0)
    assert sorted(joined.collect()) == sorted(found.collect())


def test_benchmark_beside_variants(spark):
    """Variants of an item in one text: each is consistent in itself, whatever the others say."""
    item = "A train leaves with Anna and 30 boxes at 40 km per hour while Anna waits 30 minutes for the next one"
    other = lambda name, a, b: item.replace("Anna", name).replace("30", a).replace("40", b)
    mixed = item.replace("Anna", "Otto", 1).replace("Anna", "Rita").replace("30", "75", 1)
    texts = [
        (1, "\n".join([item, other("Otto", "31", "41"), other("Rita", "32", "42")])),
        (2, "1. " + other("Otto", "31", "41") + ".\n2. " + other("Rita", "32", "42").replace("per hour", "in every single hour") + ".\n"),
        (3, "\n".join([mixed, mixed.replace("Otto", "Eva").replace("Rita", "Nils")])),  # two values for one slot in each
        (4, other("Otto", "31", "41")), (4, other("Rita", "32", "42")), (None, other("Eva", "31", "41")), (None, other("Otto", "32", "42")),
    ]
    docs, items = spark.createDataFrame(texts, "doc_id bigint, text string"), spark.createDataFrame([(7, item)], "item_id bigint, text string")
    found = {r["doc_id"]: r for r in benchmark_matches(docs, items).collect()}
    assert set(found) == {1, 2, 4, None} and found[1]["verbatim"] and not found[2]["verbatim"]
    assert all(r["consistency"] == 1.0 and r["coverage"] == 1.0 for k, r in found.items() if k != 2)
    joined = benchmark_matches(docs, items, index_windows=0)
    assert {r["doc_id"]: r for r in joined.collect()} == found
    assert drop_contaminated(docs, items).select("doc_id").collect() == [(3,)]


def test_short_benchmark_items(spark):
    """Items of fewer words than a window stand anywhere in a text; with few literal words their values count."""
    items = [(1, "Who wrote the old red book"), (2, "Add 17 and 25"), (3, "yes"), (4, None), (5, "one two three four five six seven eight nine ten")]
    texts = [
        (1, "Here is one more. Who wrote the old red book? Nobody knows that, they say."), (2, "who wrote the old red book"), (3, "Add 17 and 25, then go on"),
        (4, "then add 18 and 25, or so"), (5, "who wrote the new red book of all books"), (6, "No or yes"), (7, None), (8, ""),
        (9, "one two three four five six seven eight nine ten, yes"),
    ]
    docs, benchmark = spark.createDataFrame(texts, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    want = {(1, 1), (2, 1), (3, 2), (6, 3), (9, 3), (9, 5)}
    for windows in (1000, 0):
        found = benchmark_matches(docs, benchmark, index_windows=windows).collect()
        assert {(r["doc_id"], r["item_id"]) for r in found} == want and all(r["coverage"] == 1.0 for r in found)


@tables
def test_packing_keeps_its_rules(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{LEARNED}/documents.parquet").collect()}
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in LLM_QUERIES["op3_best_fit_packing"](spark, LEARNED).collect():
        pieces[r["doc_id"]].append(r)
        bins[r["bin_id"]].append(r)
    assert set(pieces) == set(docs)
    for key, found in pieces.items():  # a round trip
        raw = docs[key]["text"].encode()
        assert b"".join(raw[r["text_start"] : r["text_start"] + r["size"]] for r in sorted(found, key=lambda r: r["piece"])) == raw
    for found in bins.values():
        found.sort(key=lambda r: (r["bin_start"], r["size"]))
        assert [r["bin_start"] for r in found] == [0, *np.cumsum([r["size"] for r in found])[:-1]]
        assert sum(r["size"] for r in found) <= CAPACITY
        sources = [docs[r["doc_id"]]["source"] for r in found]
        plain = ["".join(docs[r["doc_id"]]["text"].split()) for r in found]
        assert len(set(sources)) == len(sources) and len(set(plain)) == len(plain)


@tables
def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{LEARNED}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    texts = texts_of(spark, LEARNED)
    longest: dict[str, int] = {}
    for key in sorted(texts):
        plain = re.sub(r"[\x20\x09-\x0D]", "", texts[key])
        if plain not in longest or len(texts[key]) > len(texts[longest[plain]]):
            longest[plain] = key
    once = stages["exact dedup"](spark, docs, LEARNED)
    assert {r["doc_id"] for r in once.select("doc_id").collect()} == set(longest.values())
    want = components_of(sets_of(texts, 5))
    assert {r["doc_id"] for r in stages["MinHash near-dedup"](spark, docs, LEARNED).select("doc_id").collect()} == set(want.values())
    said = {r["doc_id"] for r in LLM_QUERIES["op9_toxic_segments"](spark, LEARNED).where("predicted = 0").collect()}
    assert {r["doc_id"] for r in stages["toxicity"](spark, docs, LEARNED).select("doc_id").collect()} == said
    leaks = {r["doc_id"] for r in LLM_QUERIES["op8_template_decontamination"](spark, LEARNED).collect()}
    assert {r["doc_id"] for r in stages["benchmark decontamination"](spark, docs, LEARNED).select("doc_id").collect()} == set(texts) - leaks
    assert corpus_pipeline.run(spark, FOLDER).count() > 0


def test_jump_moves_rows_only_into_the_new_shard():
    keys = np.random.default_rng(1).integers(0, 1 << 63, 20_000).astype(np.uint64)
    before = jump(keys, 24)
    assert np.bincount(before).min() > 20_000 / 24 * 0.8
    for more in (25, 30):
        after = jump(keys, more)
        assert np.all((after == before) | (after >= 24))
        assert abs(np.mean(after != before) - (more - 24) / more) < 0.01
    assert jump(np.array([0, 5], np.uint64), 1).tolist() == [0, 0]


def maximal(scores):
    """By definition: the best run, the shortest of equal ones, then the same on either side."""
    best = max(((sum(scores[a:b]), a - b, -a) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=(0, 0, 0))
    if best[0] <= 1e-9:
        return []
    a = -best[2]
    b = a - best[1]
    return [*maximal(scores[:a]), (a, b, best[0]), *[(x + b, y + b, s) for x, y, s in maximal(scores[b:])]]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([-1, -1, -1, 3, 5, 2]), max_size=14))
def test_segments_by_definition(scores):
    places = np.array([k for k, s in enumerate(scores) if s > 0], dtype=np.int64)
    found = segments(np.array([scores[k] for k in places], float), places, 1.0)
    want = maximal(scores)
    assert sum(s for _, _, s in found) == pytest.approx(sum(s for _, _, s in want))
    assert [round(s) for _, _, s in found] == [round(s) for _, _, s in want]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([-4, -2, -1, 0, 1, 3, 5]), max_size=14))
def test_segments_among_words_of_both_signs(scores):
    sums = np.concatenate([[0], np.cumsum(scores)]).astype(float)
    places = np.array([k for k, s in enumerate(scores) if s > 0], dtype=np.int64)
    falls = sums[np.concatenate([[0], places[:-1] + 1]).astype(int)] - sums[places] if len(places) else np.zeros(0)
    found = segments(np.array([scores[k] for k in places], float), places, 0.0, falls)
    assert [round(s) for _, _, s in found] == [round(s) for _, _, s in maximal(scores)]


def test_toxicity_by_many_mild_words(spark):
    """No word is in more than half of the toxic or fewer than a sixth of the clean texts."""
    rng = np.random.default_rng(5)
    made = lambda k: ["".join(chr(97 + c) for c in rng.integers(0, 26, 7)) for _ in range(k)]
    mild, calm, common = made(60), made(60), made(300)
    texts, marks = [], []
    for doc in range(1500):
        bad = doc % 3 == 0
        words = [w for w in mild if rng.random() < (0.5 if bad else 0.18)] + [w for w in calm if rng.random() < (0.18 if bad else 0.5)]
        words += [common[k] for k in rng.integers(0, 300, 40)]
        texts.append((doc, " ".join(rng.permutation(words))))
        marks.append((doc, int(bad)))
    docs, labels = spark.createDataFrame(texts, "doc_id bigint, text string"), spark.createDataFrame(marks, "doc_id bigint, toxic int")
    rows = toxicity(docs, labels).where("held_out").collect()
    high = [[r["score"] for r in rows if (r["doc_id"] % 3 == 0) == bad] for bad in (True, False)]
    assert np.mean([(x > y) + 0.5 * (x == y) for x in high[0] for y in high[1]]) >= 0.9


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 20), st.integers(-1, 3), st.integers(-1, 5)), max_size=30))
def test_best_fit_is_tightest(items):
    sizes, sources, clusters = ([x[k] for x in items] for k in range(3))
    bins: list[list[int]] = []
    want = [0] * len(items)
    clash = lambda i, j: (sources[i] >= 0 and sources[i] == sources[j]) or (clusters[i] >= 0 and clusters[i] == clusters[j])
    for i in sorted(range(len(items)), key=lambda i: (-sizes[i], i)):
        room = [(20 - sum(sizes[j] for j in bin_), k) for k, bin_ in enumerate(bins)]
        fits = [r for r in room if r[0] >= sizes[i] and not any(clash(i, j) for j in bins[r[1]])]
        k = min(fits)[1] if fits else len(bins)
        if k == len(bins):
            bins.append([])
        bins[k].append(i)
        want[i] = k
    assert best_fit(sizes, sources, clusters, 20) == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB \t\né€\x1f\xa0", max_size=30)), max_size=8))
def test_words_and_shingles(texts):
    array = pa.array(["skip me", *texts], pa.string())[1:]
    sets = []
    for _, raw, offsets in W.text_chunks(array):
        found, bounds = W.shingle_sets(W.words(raw, offsets), 2)
        sets += [set(found[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:])]
    want = list(sets_of(dict(enumerate(texts)), 2).values())
    assert [len(s) for s in sets] == [len(s) for s in want]
    for i in range(len(texts)):
        for j in range(len(texts)):
            assert (sets[i] == sets[j]) == (want[i] == want[j])


def test_codewords_differ():
    for count in (2, 3, 4, 7, 12, 40):
        code = codebook(count)
        apart = (code[:, None, :] != code[None, :, :]).sum(2)
        assert apart[~np.eye(count, dtype=bool)].min() >= (1 if count == 2 else 2)
        assert np.all(np.abs(code.sum(0)) < count)
