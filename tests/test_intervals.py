import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from dwellspan.operators import coverage, intervals

CASES = {
    "single": ([(0, 1000)], 1000), "abutting": ([(0, 1000), (1000, 2000)], 2000), "partial": ([(0, 1000), (500, 1500)], 1500), "triplicate": ([(0, 1000)] * 3, 1000), "gap": ([(0, 1000), (2000, 3000)], 2000),
    "contained": ([(0, 4000), (1000, 2000)], 4000), "chain": ([(2000, 3000), (0, 1000), (500, 2500)], 3000), "cadence": ([(10000, 11000)] + [(10000 + 250 * k, 10250 + 250 * k) for k in range(4)], 1000), "short": ([(0, 250), (500, 750)], 500), "empty": ([(5, 5)], None),
}
SLOW = settings(deadline=None, max_examples=12, suppress_health_check=[HealthCheck.function_scoped_fixture])
SPANS = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 90), st.integers(0, 25)), min_size=1, max_size=25)


def _frame(spark, spans):
    return spark.createDataFrame([(k, s, s + n) for k, s, n in spans], "k int, start_us long, end_us long")


def test_union_of_known_cases(spark):
    rows = [(name, s, e) for name, (spans, _) in CASES.items() for s, e in spans]
    df = spark.createDataFrame(rows, "case string, start_us long, end_us long")
    for bucket in (300, 10**9):
        got = {r.case: r.union_us for r in intervals.union_measure(df, ["case"], bucket).collect()}
        assert got == {n: want for n, (_, want) in CASES.items() if want}


@SLOW
@given(SPANS)
def test_union_complement_and_ledger_agree(spark, spans):
    df = _frame(spark, spans)
    moments = {k: {t for kk, s, n in spans if kk == k for t in range(s, s + n)} for k, _, _ in spans}
    union = {r.k: r.union_us for r in intervals.union_measure(df, ["k"], 7).collect()}
    assert union == {k: len(m) for k, m in moments.items() if m}
    merged = intervals.merged(df, ["k"], 7).collect()
    assert sum(r.end_us - r.start_us for r in merged) == sum(map(len, moments.values()))
    for r in merged:
        assert r.start_us - 1 not in moments[r.k] and r.end_us not in moments[r.k]
    gaps = intervals.complement(df, ["k"], 0, 200).collect()
    for k, m in moments.items():
        if m:
            assert sum(r.end_us - r.start_us for r in gaps if r.k == k) == 200 - len(m)


@SLOW
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 90), st.integers(0, 25), st.sampled_from("abc")), min_size=1, max_size=20), st.sampled_from([7, 50, 1000]))
def test_ledger_is_a_partition_by_priority(spark, spans, bucket):
    df = spark.createDataFrame([(k, s, s + n, c) for k, s, n, c in spans], "k int, start_us long, end_us long, status string")
    cells = intervals.ledger(df, ["k"], "abc", 5, 100, bucket)
    rows = cells.collect()
    for k in {s[0] for s in spans}:
        at = {t: r.status for r in rows if r.k == k for t in range(r.start_us, r.end_us)}
        assert sorted(at) == list(range(5, 100))
        for t, status in at.items():
            here = sorted(c for kk, s, n, c in spans if kk == k and s <= t < s + n)
            assert status == (here[0] if here else "uncovered")
        own = sorted((r.start_us, r.status) for r in rows if r.k == k)
        assert all(a[1] != b[1] for a, b in zip(own, own[1:], strict=False))
    assert all((r.overlaps, r.gaps, r.bad_ends) == (0, 0, 0) for r in intervals.partition_violations(cells, ["k"], 5, 100).collect())


def test_violations_are_seen(spark):
    df = spark.createDataFrame([(1, 0, 5), (1, 4, 8), (1, 10, 20), (2, 0, 20)], "k int, start_us long, end_us long")
    got = {r.k: (r.overlaps, r.gaps, r.bad_ends) for r in intervals.partition_violations(df, ["k"], 0, 21).collect()}
    assert got == {1: (1, 1, 1), 2: (0, 0, 1)}


def test_payload_is_that_of_the_best_observation(spark):
    rnd = random.Random(2)
    obs = [(1, s := rnd.randint(0, 80), s + rnd.randint(1, 20), rnd.choice(["human", "scan"]), rnd.random(), i) for i in range(25)]
    df = spark.createDataFrame(obs, "k int, start_us long, end_us long, status string, conf double, id int")
    cells = coverage.ledger(df, ["k"], 0, 100)
    got = coverage.with_payload(cells, intervals.clamp(df, 0, 100), ["k"], ["id"], "conf", 10).collect()
    at = {t: r for r in got for t in range(r.start_us, r.end_us)}
    for t in range(100):
        here = [o for o in obs if o[1] <= t < o[2]]
        best = max(here, key=lambda o: (o[3] == "human", o[4]), default=None)
        assert (at[t].id, at[t].status) == ((best[5], best[3]) if best else (None, "uncovered"))
    assert coverage.covered(cells).first().total_us == 100


def test_null_attributes_agree_when_spans_join(spark):
    df = spark.createDataFrame([(1, 0, 5, None), (1, 5, 8, None), (1, 8, 9, "a"), (1, 12, 13, "a")], "k int, start_us long, end_us long, shot string")
    got = sorted((r.start_us, r.end_us, r.shot) for r in intervals.join_adjacent(df, ["k"], ["shot"]).collect())
    assert got == [(0, 8, None), (8, 9, "a"), (12, 13, "a")]


@pytest.mark.parametrize("op", [lambda d: intervals.union_measure(d, ["k"]), lambda d: intervals.merged(d, ["k"]), lambda d: intervals.complement(d, ["k"], 0, 9), lambda d: intervals.stitch(d.withColumnRenamed("start_us", "at_us"), ["k"], 3)])
def test_empty(spark, op):
    assert op(spark.createDataFrame([], "k int, start_us long, end_us long")).count() == 0
