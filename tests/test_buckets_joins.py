import random
import re

import pytest
from pyspark.sql import functions as F

from dwellspan.operators import buckets, joins, sequences
from dwellspan.plans.queries import QUERIES

SPANS = "k int, id int, start_us long, end_us long"


def _spans(seed, n, base):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        start = base + rnd.randrange(-50_000, 50_000)
        rows.append((rnd.choice([1, 1, 2, None]), i, start, start + rnd.choice([0, 1, 7, 40, 999, 20_000, 10**6, -5])))
    return rows


@pytest.mark.parametrize("grain", [1, 10, 1000])
@pytest.mark.parametrize("base", [0, 10**15])
def test_intervals_of_any_lengths_meet_once(spark, grain, base):
    left, right = _spans(1, 150, base), _spans(2, 150, base)
    expected = sorted((k, i, j) for k, i, s, e in left for q, j, t, u in right if k == q and k is not None and s < e and t < u and s < u and t < e)
    frames = spark.createDataFrame(left, SPANS), spark.createDataFrame(right, SPANS).withColumnRenamed("id", "other")
    got = joins.overlaps_any_length(*frames, ["k"], grain, ["other"])
    assert sorted((r.k, r.id, r.other) for r in got.collect()) == expected
    plain = joins.overlaps(*frames, ["k"], 10_000, ["other"])
    assert sorted((r.k, r.id, r.other) for r in plain.collect()) == expected
    assert joins.overlaps_any_length(frames[0].limit(0), frames[1].limit(0), ["k"], grain, ["other"]).count() == 0


def test_a_long_interval_is_dealt_to_few_rows(spark):
    df = spark.range(1).select(F.lit(3).cast("long").alias("start_us"), F.lit(3 + 365 * 24 * 60).cast("long").alias("end_us"))
    cover = joins._dyadic(df, 1, "start_us", "end_us", True, 30)
    above = joins._dyadic(df, 1, "start_us", "end_us", False, 30)
    assert cover.count() <= 2 * 20 and above.count() <= 2 * 31
    assert cover.agg(F.sum(F.expr("shiftleft(1L, level_)"))).first()[0] == 365 * 24 * 60  # they make up the interval


@pytest.mark.parametrize("bucket", [1, 7, 100, 10**6])
def test_windows_dealt_by_time_equal_plain_ones(spark, bucket):
    rnd = random.Random(bucket)
    rows = {k: [(k, 3 * i + 1, rnd.choice([None, True, True, False]), rnd.choice([0.0, 0.5, 2.0, None]), rnd.random()) for i in range(n)] for k, n in ((1, 90), (2, 1), (None, 17))}
    df = spark.createDataFrame([r for part in rows.values() for r in part], "k int, at long, flag boolean, d double, v double")
    rank = {(r.k, r["at"]): r.rn_ for r in buckets.numbered(df, ["k"], "at", bucket).collect()}
    back = {(r.k, r["at"]): r.b for r in buckets.last_seen(buckets.dealt(df, "at", bucket), ["k"], "at", "d", "b").collect()}
    runs = {r.k: (r["first"], r["last"], r.n) for r in sequences.longest_run(df, ["k"], "at", "flag", bucket).collect()}
    groups = {(r.k, r["at"]): r.group_no for r in sequences.capped_groups(df, ["k"], "at", "d", 1.0, 4, bucket=bucket).collect()}
    closed = {(r.k, r["at"]): r.closed for r in sequences.close_gaps(df, ["k"], "at", "flag", 1, bucket=bucket).collect()}
    smooth = {(r.k, r["at"]): r.smooth for r in sequences.rolling_median(df, ["k"], "at", "v", 9, bucket=bucket, block=5).collect()}
    for k, part in rows.items():
        values, flags = [r[4] for r in part], [bool(r[2]) for r in part]
        last, group, size, best, run = None, -1, 0, None, 0
        for i, (_, at, flag, d, _) in enumerate(part):
            last = d if d is not None else last
            if i == 0 or (d or 0) > 1.0 or size == 4:
                group, size = group + 1, 0
            size += 1
            assert rank[k, at] == i + 1 and back[k, at] == last and groups[k, at] == group
            near = sorted(values[min(max(j, 0), len(values) - 1)] for j in range(i - 4, i + 5))
            assert smooth[k, at] == near[4]
            before = next((j for j in range(i, -1, -1) if flags[j]), None)
            after = next((j for j in range(i, len(flags)) if flags[j]), None)
            assert closed[k, at] == (flags[i] or (before is not None and after is not None and after - before - 1 <= 1))
            run = run + 1 if flag else 0
            if run and (best is None or run > best[2]):
                best = (part[i - run + 1][1], at, run)
        assert runs.get(k) == best


@pytest.mark.parametrize("name", ["consecutive_distance", "grouping_capped", "shots_from_cuts", "rolling_median", "longest_run", "close_gaps", "fast_clusters"])
def test_no_window_sorts_all_rows_of_a_key(name, spark, sf_dir):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    by_key = re.findall(r"\[user_id#\d+L?\], \[(\w+)#", plan)
    assert by_key and set(by_key) <= {"bucket_"}
