"""Operators against plain Python on generated tables."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from siltwork.operators import geo, keys, merge

few = settings(
    max_examples=6, deadline=None, derandomize=True,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
small = st.one_of(st.none(), st.integers(-3, 3))


@few
@given(st.lists(st.tuples(small, small), max_size=40))
def test_number_all_rows_is_the_sorted_position(spark, data):
    df = spark.createDataFrame(data, "a int, b int")
    found = sorted((r.id, r.a, r.b) for r in keys.number_all_rows(df, ["a"]).collect())
    ordered = sorted(data, key=lambda r: tuple((v is not None, v or 0) for v in r))
    assert [(a, b) for _, a, b in found] == ordered
    assert [i for i, _, _ in found] == list(range(1, len(data) + 1))


@few
@given(st.dictionaries(st.text("abc", min_size=1, max_size=3), st.integers(0, 4), max_size=20), st.booleans())
def test_rank_counts_the_better_ones(spark, totals, ascending):
    df = spark.createDataFrame(list(totals.items()), "g string, amount int")
    for row in keys.rank_rows(df, "amount", ascending).collect():
        better = [v for v in totals.values() if (v < row.amount if ascending else v > row.amount)]
        assert row["rank"] == 1 + len(better)


@few
@given(st.dictionaries(st.integers(0, 9), st.text("xy", max_size=2)),
       st.lists(st.tuples(st.integers(0, 9), st.integers(0, 5), st.text("xy", max_size=2)), max_size=15))
def test_upsert_and_insert_ignore(spark, target, source):
    schema = "k int, n int, v string"
    old = spark.createDataFrame([(k, -1, v) for k, v in target.items()], schema)
    new = spark.createDataFrame(source, schema)
    last = {k: max((n, v) for kk, n, v in source if kk == k) for k, _, _ in source}
    first = {k: min((n, v) for kk, n, v in source if kk == k) for k, _, _ in source}
    stored = {k: (-1, v) for k, v in target.items()}
    found = {r.k: (r.n, r.v) for r in merge.upsert(old, new, ["k"], ["n"]).collect()}
    assert found == {**stored, **last}
    found = {r.k: (r.n, r.v) for r in merge.insert_ignore(old, new, ["k"], ["n"]).collect()}
    assert found == {**first, **stored}


@few
@given(st.lists(st.integers(0, 2**32 - 1), min_size=2, max_size=12, unique=True), st.lists(st.integers(0, 2**32 - 1), max_size=12))
def test_locate_finds_the_band_that_holds_the_address(spark, edges, numbers):
    edges = sorted(edges)
    bands = [(a, b - 1, f"{a}") for a, b in zip(edges[::2], edges[1::2])]
    probes = numbers + edges + [e - 1 for e in edges if e]
    texts = [(".".join(str(n >> s & 255) for s in (24, 16, 8, 0)), n) for n in probes]
    frame = spark.createDataFrame(bands, "ip_from bigint, ip_to bigint, country string")
    found = geo.locate(spark.createDataFrame(texts, "ip_address string, n bigint"), frame, fields=("country",)).collect()
    assert len(found) == len(probes)
    for row in found:
        inside = [name for low, high, name in bands if low <= row.n <= high]
        assert row.country == (inside[0] if inside else "Unknown")
