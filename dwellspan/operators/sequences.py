"""Operators on ordered rows: states, groups, cuts, fills, thresholds, last-wins logs.

Where the next row depends on a decision about the last accepted one, rows of a key go through one
sorted pass in Arrow batches; all else is window functions.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import buckets
from .intervals import DAY


def consecutive(df: DataFrame, keys: Sequence[str], at: str, distance: Callable[[Column, Column], Column], of: str, max_gap: int | float, name: str = "distance", bucket: int = DAY) -> DataFrame:
    """df with the distance of each row's value to the one before; null for the first and behind longer gaps than max_gap. A key's rows are dealt by time."""
    own = buckets.previous(buckets.dealt(df, at, bucket), keys, at, [of])
    before = F.col("previous_")
    return own.withColumn(name, F.when(F.col(at) - before[at] <= max_gap, distance(before[of], F.col(of)))).drop("previous_", "bucket_")


def states(df: DataFrame, keys: Sequence[str], at: str, max_gap: int | float, threshold: float, distance: str = "distance", shot: str | None = None, name: str = "state", bucket: int | None = None) -> DataFrame:
    """df with state numbers from 1 in each key: a new state at a longer gap, another known shot, a larger distance or one that is not known.

    With bucket, a key's rows are dealt by time.
    """
    take = [shot] if shot else []
    if bucket is None:
        own = df.withColumn("previous_", F.lag(F.struct(at, *take)).over(Window.partitionBy(*keys).orderBy(at)))
    else:
        own = buckets.previous(buckets.dealt(df, at, bucket), keys, at, take)
    before = F.col("previous_")
    opens = before.isNull() | (F.col(at) - before[at] > max_gap) | F.coalesce(F.col(distance) > threshold, F.lit(True))
    if shot:
        opens = opens | F.coalesce(before[shot] != F.col(shot), F.lit(False))
    own = own.withColumn("opens_", opens.cast("int"))
    if bucket is None:
        upto = Window.partitionBy(*keys).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
        return own.withColumn(name, F.sum("opens_").over(upto)).drop("opens_", "previous_")
    return buckets.running(own, keys, at, "opens_", name).drop("opens_", "previous_", "bucket_")


def carry(df: DataFrame, state_keys: Sequence[str], flag: str, name: str = "carried") -> DataFrame:
    """df with whether any row of its state has the flag."""
    held = df.groupBy(*state_keys).agg(F.max(F.col(flag).cast("int")).alias("any_"))
    return df.join(held, list(state_keys)).withColumn(name, F.col("any_") == 1).drop("any_")


def carry_brands(seen: DataFrame, frame_states: DataFrame) -> DataFrame:
    """brand, frame: brands seen in (brand, frame), carried to all frames of the states (frame, state) that they were seen in."""
    marked = seen.join(frame_states, "frame").select("brand", "state").distinct()
    return marked.join(frame_states, "state").select("brand", "frame").union(seen.select("brand", "frame")).distinct()


def valley(df: DataFrame, value: str, low: float = 0.1, high: float = 0.9) -> DataFrame:
    """threshold, separation, rank, n: the middle of the widest step between neighbours in sorted order, between two rank shares.

    Ranks come from counts of bins that hold about equally many rows, whatever the values' distribution, so no task sorts all rows.
    """
    from pyspark.ml.feature import Bucketizer

    distinct = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n"))
    bins = 1024
    cuts = sorted({float(x) for x in df.select(F.col(value).cast("double").alias("v")).approxQuantile("v", [k / bins for k in range(1, bins)], 1 / (4 * bins))})
    binned = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="at_", outputCol="bin").transform(distinct.withColumn("at_", F.col(value).cast("double"))) if cuts else distinct.withColumn("bin", F.lit(0.0))
    dealt = binned.drop("at_")
    upto = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy("bin")
    sums = dealt.groupBy("bin").agg(F.sum("n").alias("in_bin"), F.min(value).alias("least"))
    sums = sums.select("bin", F.coalesce(F.sum("in_bin").over(upto), F.lit(0)).alias("before"), F.lead("least").over(after).alias("beyond"), F.sum("in_bin").over(Window.partitionBy(F.lit(1))).alias("total"))
    inside = Window.partitionBy("bin").orderBy(value)
    steps = dealt.join(F.broadcast(sums), "bin").select(
        F.col(value).alias("v"), F.coalesce(F.lead(value).over(inside), "beyond").alias("next"),
        (F.col("before") + F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, 0))).alias("rank"), "total",
    )
    # rank counts rows up to v, so the step is between the rows of index rank - 1 and rank
    held = steps.filter((F.col("next").isNotNull()) & (F.col("rank") - 1 >= F.floor(F.col("total") * low)) & (F.col("rank") - 1 < F.floor(F.col("total") * high)))
    best = held.agg(F.max_by(F.struct("v", "next", "rank"), F.struct(F.col("next") - F.col("v"), -F.col("rank"))).alias("b"), F.max("total").alias("n"))
    return best.select(((F.col("b.v") + F.col("b.next")) / 2).alias("threshold"), (F.col("b.next") - F.col("b.v")).alias("separation"), (F.col("b.rank") - 1).alias("rank"), "n")


def calibrated(df: DataFrame, value: str, override: float | None = None, min_rows: int = 20, min_separation: float = 0.30, fallback: float = 0.30) -> DataFrame:
    """threshold, source: the override, else a clear valley, else the fallback."""
    if override is not None:
        return df.sparkSession.createDataFrame([(float(override), "override")], "threshold double, source string")
    clear = (F.col("n") >= min_rows) & (F.col("separation") >= min_separation)
    return valley(df, value).select(F.when(clear, F.col("threshold")).otherwise(fallback).alias("threshold"), F.when(clear, "valley").otherwise("fallback").alias("source"))


def capped_groups(df: DataFrame, keys: Sequence[str], at: str, distance: str, threshold: float, cap: int, name: str = "group_no", bucket: int = DAY) -> DataFrame:
    """df with group numbers from 0 in each key: a group ends where the distance to the row before exceeds threshold, or at cap rows. A key's rows are dealt by time."""
    own = buckets.numbered(df, keys, at, bucket)
    opens = (F.col("rn_") == 1) | (F.coalesce(F.col(distance), F.lit(0.0)) > threshold)
    own = buckets.last_seen(own.withColumn("opened_", F.when(opens, F.col("rn_"))), keys, at, "opened_", "since_")
    own = own.withColumn("opens_", ((F.col("rn_") - F.col("since_")) % cap == 0).cast("int"))
    return buckets.running(own, keys, at, "opens_", name).withColumn(name, F.col(name) - 1).drop("rn_", "opened_", "since_", "opens_", "bucket_")


def _stateful(df: DataFrame, keys: Sequence[str], order: Sequence[str], take: Sequence[str], begin: Callable, out: str) -> DataFrame:
    """df with a boolean column from one pass over the sorted rows of each key; null keys are one key.

    begin() gives a function for one key: it is called with the columns take, as Arrow arrays, of one stretch of rows after
    the other and answers with a mark for each row. Without keys all rows are one sequence, and go through one task.
    """
    key_at, take_at = [df.columns.index(k) for k in keys], [df.columns.index(c) for c in take]
    schema = df.select("*", F.lit(True).alias(out)).schema

    def run(batches):
        import numpy as np
        import pyarrow as pa

        state, key = None, None
        for batch in batches:
            names = list(zip(*(["nan" if x != x else x for x in batch.column(k).to_pylist()] for k in key_at), strict=True)) if key_at else [()] * batch.num_rows
            edges = [0, *(i for i in range(1, batch.num_rows) if names[i] != names[i - 1]), batch.num_rows]
            marks = []
            for lo, hi in zip(edges, edges[1:], strict=False):
                if lo == hi:
                    continue
                if state is None or names[lo] != key:
                    state, key = begin(), names[lo]
                marks.append(state(*(batch.column(k).slice(lo, hi - lo) for k in take_at)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(marks) if marks else np.empty(0, bool))], names=[*batch.schema.names, out])

    dealt = df.repartition(*keys) if keys else df.repartition(1)
    return dealt.sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def spaced_cuts(df: DataFrame, keys: Sequence[str], at: str, severity: str, min_gap: int | float, name: str = "cut") -> DataFrame:
    """df with whether a row is a cut: severity over 1 and at least min_gap since the last accepted cut."""

    def begin():
        import numpy as np

        last = None

        def step(ats, severities):
            nonlocal last
            marks, t = np.zeros(len(ats), bool), ats.to_numpy(zero_copy_only=False)
            hard = np.flatnonzero(np.nan_to_num(severities.to_numpy(zero_copy_only=False).astype(float)) > 1)
            times, k = t[hard], 0
            if last is not None:
                k = int(np.searchsorted(times, last + min_gap))
            while k < len(hard):  # from one cut to the next that is far enough
                last = times[k]
                marks[hard[k]] = True
                k = max(k + 1, int(np.searchsorted(times, last + min_gap)))
            return marks

        return step

    return _stateful(df, keys, [at], [at, severity], begin, name)


def skip_similar(df: DataFrame, keys: Sequence[str], at: str, value: str, min_distance: float, name: str = "keep") -> DataFrame:
    """df with whether a row differs by at least min_distance (mean absolute difference) from the last one kept.

    A vector that is null, holds a null or NaN or has another length than the last one kept is not kept, and the last one kept stays.
    """

    def begin():
        import numpy as np

        from .clusters import whole_vectors

        last = None

        def step(values):
            nonlocal last
            every, held = whole_vectors(values)
            if last is not None and every.shape[1] != len(last):
                held[:] = False
            places = np.flatnonzero(held)
            rows = every[places]
            marks, k = np.zeros(len(every), bool), 0
            while k < len(rows):
                if last is not None:
                    ahead = 8  # how far to look at once
                    while k < len(rows):
                        far = np.flatnonzero(~(np.abs(rows[k : k + ahead] - last).mean(axis=1) < min_distance))
                        if len(far):
                            k += int(far[0])
                            break
                        k, ahead = k + ahead, 2 * ahead
                    if k >= len(rows):
                        break
                last, marks[places[k]] = rows[k], True
                k += 1
            return marks

        return step

    return _stateful(df, keys, [at], [value], begin, name)


def shots_from_cuts(df: DataFrame, keys: Sequence[str], at: str, cut: str = "cut", severity: str | None = None, bucket: int = DAY) -> DataFrame:
    """keys, shot (from 0), first, last, n_rows and the severity of the opening cut, 0 for the first shot. A key's rows are dealt by time."""
    counted = buckets.running(buckets.dealt(df.withColumn("cut_", F.coalesce(F.col(cut).cast("int"), F.lit(0))), at, bucket), keys, at, "cut_", "shot")
    aggs = [F.min(at).alias("first"), F.max(at).alias("last"), F.count("*").alias("n_rows")]
    if severity:
        aggs.append(F.min_by(severity, at).alias("cut_severity"))
    shots = counted.groupBy(*keys, "shot").agg(*aggs)
    # numbers count from the first shot, be it opened by a cut or not; of shots there are few
    shots = shots.withColumn("shot", F.col("shot") - F.min("shot").over(Window.partitionBy(*keys)))
    return shots.withColumn("cut_severity", F.when(F.col("shot") == 0, 0.0).otherwise(F.col("cut_severity"))) if severity else shots


def rolling_median(df: DataFrame, keys: Sequence[str], at: str, value: str, width: int = 61, name: str = "smooth", bucket: int = DAY, block: int = 4096) -> DataFrame:
    """df with the median over width rows around each; the first and last values stand in beyond the ends.

    Rows are numbered, dealt in blocks of about so many rows with a halo of half the width, and padded at the ends of their key.
    """
    half = width // 2
    own = buckets.numbered(df, keys, at, bucket).drop("bucket_")
    ends, test = buckets.beside(own, own.groupBy(*keys).agg(F.max("rn_").alias("n_"), F.min_by(value, "rn_").alias("first_"), F.max_by(value, "rn_").alias("last_")), keys)
    own = own.join(ends, test).drop(*(f"{k}_of_bucket" for k in keys))
    first, last = F.floor((F.col("rn_") - 1 - half) / block), F.floor((F.col("rn_") - 1 + half) / block)
    dealt = own.withColumn("block_", F.explode(F.sequence(first, last)))
    near = F.collect_list(value).over(Window.partitionBy(*keys, "block_").orderBy("rn_").rowsBetween(-half, half))
    inner = dealt.withColumn("near_", near).filter(F.floor((F.col("rn_") - 1) / block) == F.col("block_"))
    left = F.array_repeat("first_", F.greatest(F.lit(0), half - (F.col("rn_") - 1)).cast("int"))
    right = F.array_repeat("last_", F.greatest(F.lit(0), half - (F.col("n_") - F.col("rn_"))).cast("int"))
    out = inner.withColumn(name, F.element_at(F.array_sort(F.concat(left, "near_", right)), half + 1))
    return out.drop("near_", "block_", "rn_", "n_", "first_", "last_")


def _runs(df: DataFrame, keys: Sequence[str], at: str, flag: Column, bucket: int) -> DataFrame:
    """keys, first, last, n of runs of consecutive rows with the flag."""
    own = buckets.numbered(df.withColumn("set_", F.coalesce(flag, F.lit(False)).cast("int")), keys, at, bucket)
    own = buckets.running(own, keys, at, "set_", "sets_").filter("set_ = 1").withColumn("island_", F.col("rn_") - F.col("sets_"))
    return own.groupBy(*keys, "island_").agg(F.min(at).alias("first"), F.max(at).alias("last"), F.count("*").alias("n")).drop("island_")


def longest_run(df: DataFrame, keys: Sequence[str], at: str, flag: str, bucket: int = DAY) -> DataFrame:
    """keys, first, last, n: the longest run of rows with the flag; of equal ones the first. A key's rows are dealt by time."""
    runs = _runs(df, keys, at, F.col(flag), bucket)
    return runs.groupBy(*keys).agg(F.max_by(F.struct("first", "last", "n"), F.struct("n", -F.col("first"))).alias("r")).select(*keys, "r.*")


def close_gaps(df: DataFrame, keys: Sequence[str], at: str, flag: str, k: int, name: str = "closed", bucket: int = DAY) -> DataFrame:
    """df with the flag's morphological closing: runs of at most k unset rows between set ones are filled. A key's rows are dealt by time."""
    own = buckets.numbered(df, keys, at, bucket)
    own = own.withColumn("at_", F.when(F.col(flag), F.col("rn_")))
    own = buckets.last_seen(buckets.last_seen(own, keys, at, "at_", "back_"), keys, at, "at_", "ahead_", forward=True)
    filled = F.coalesce(F.col(flag) | (F.col("ahead_") - F.col("back_") - 1 <= k), F.lit(False))
    return own.withColumn(name, filled).drop("at_", "rn_", "back_", "ahead_", "bucket_")


def fast_clusters(df: DataFrame, keys: Sequence[str], at: str, length: str, below: float, at_least: int = 3, bucket: int = DAY) -> DataFrame:
    """keys, first, last, n: runs of at_least or more consecutive rows shorter than below. A key's rows are dealt by time."""
    return _runs(df, keys, at, F.col(length) < below, bucket).filter(F.col("n") >= at_least)


def last_wins(log: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """The last row of each key by seq, with first_seq, where the key was first seen."""
    rest = [c for c in log.columns if c not in keys]
    held = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), seq).alias("r_"), F.min(seq).alias("first_seq"))
    return held.select(*keys, "r_.*", "first_seq")


def pending(index: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows of the index that no row of done has the key of."""
    return index.join(done.select(key), key, "left_anti")


def unknown(index: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows of done that no row of the index has the key of."""
    return done.join(index.select(key), key, "left_anti")


def progress(index: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """n_total, n_done, n_unknown: work done, and done keys that the index has not."""
    both = index.select(key).distinct().withColumn("i_", F.lit(1)).join(done.select(key).distinct().withColumn("d_", F.lit(1)), key, "full")
    return both.agg(F.count("i_").alias("n_total"), F.count_if(F.expr("i_ = 1 and d_ = 1")).alias("n_done"), F.count_if(F.col("i_").isNull()).alias("n_unknown"))


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "rank") -> DataFrame:
    """df with ranks from 0 in each key."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)


def _places(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: int | None) -> DataFrame:
    """df with rank_ from 0. With bucket the first order column is a number, and a key's rows are dealt by it."""
    if bucket is None:
        return ranked(df, keys, order, "rank_")
    return buckets.numbered(df, keys, order[0], bucket, "rank_", order[1:]).withColumn("rank_", F.col("rank_") - 1).drop("bucket_")


def every_nth(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, bucket: int | None = None) -> DataFrame:
    return _places(df, keys, order, bucket).filter(F.col("rank_") % n == 0).drop("rank_")


def worker_slice(df: DataFrame, keys: Sequence[str], order: Sequence[str], worker: int, workers: int, bucket: int | None = None) -> DataFrame:
    """The rows that fall to a worker when they are dealt in turn."""
    return _places(df, keys, order, bucket).filter(F.col("rank_") % workers == worker).drop("rank_")


def evenly_spread(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, nearest: bool = False) -> DataFrame:
    """n rows of each key from the first to the last at even steps, or all if there are fewer.

    Positions between rows go down, or with nearest to the nearest row; of one row the first, or with
    nearest the middle one.
    """
    total = F.count("*").over(Window.partitionBy(*keys))
    rows = ranked(df, keys, order, "rank_").withColumn("total_", total)
    if n <= 1:
        return rows.filter(F.col("rank_") == (F.floor(F.col("total_") / 2) if nearest else 0)).drop("rank_", "total_")
    at = lambda i: i * (F.col("total_") - 1) / (n - 1)
    places = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: (F.bround(at(i)) if nearest else F.floor(at(i))).cast("long"))
    return rows.filter((F.col("total_") <= n) | F.array_contains(places, F.col("rank_").cast("long"))).drop("rank_", "total_")


def batches(df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int, name: str = "batch") -> DataFrame:
    return ranked(df, keys, order, "rank_").withColumn(name, F.floor(F.col("rank_") / size)).drop("rank_")


def hash_split(df: DataFrame, key: str, shares: dict[str, float], name: str = "split") -> DataFrame:
    """df with a part drawn by a digest of the key, so that reruns and other rows do not move it."""
    u = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("double") / float(2**32)
    out, upto = F.lit(None).cast("string"), 0.0
    bounds = []
    for part, share in shares.items():
        upto += share / sum(shares.values())
        bounds.append((part, upto))
    for part, bound in reversed(bounds):
        out = F.lit(part) if part == bounds[-1][0] else F.when(u < bound, part).otherwise(out)
    return df.withColumn(name, out)
