"""Algebra of half-open intervals [start, end) in BIGINT microseconds.

Time is exact in integers, and operators deal their rows by key and time bucket, so that one long
run or one frequent key is spread over many tasks. Cutting intervals at bucket edges changes
neither their union nor the class that wins at any moment; pieces that touch at an edge are joined again.
Only complement and partition_violations sort the spans of a key in one task, as what they take is a result of the others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import buckets

SECOND = 1_000_000
HOUR = 3600 * SECOND
DAY = 24 * HOUR


def micros(ts: Column) -> Column:
    """Microseconds of a timestamp with a zone."""
    return F.unix_micros(ts)


def wall_micros(ts: Column) -> Column:
    """Microseconds of a timestamp without a zone, as if it were UTC, whatever the session's zone is."""
    return F.unix_micros(F.from_utc_timestamp(ts.cast("timestamp"), F.current_timezone()))


def clamp(df: DataFrame, lo: Column | int, hi: Column | int, start: str = "start_us", end: str = "end_us") -> DataFrame:
    """Intervals cut to [lo, hi); what is empty goes."""
    as_col = lambda x: x if isinstance(x, Column) else F.lit(x)
    return df.withColumns({start: F.greatest(F.col(start), as_col(lo)), end: F.least(F.col(end), as_col(hi))}).filter(F.col(end) > F.col(start))


def spread(df: DataFrame, bucket: int = DAY, start: str = "start_us", end: str = "end_us") -> DataFrame:
    """Intervals cut at bucket edges, with the column bucket; empty ones go."""
    first, last = F.floor(F.col(start) / bucket), F.floor((F.col(end) - 1) / bucket)
    cut = df.filter(F.col(end) > F.col(start)).withColumn("bucket", F.explode(F.sequence(first, last)))
    return clamp(cut, F.col("bucket") * bucket, (F.col("bucket") + 1) * bucket, start, end)


def union_measure(df: DataFrame, keys: Sequence[str], bucket: int = DAY, start: str = "start_us", end: str = "end_us") -> DataFrame:
    """keys, union_us, n_intervals: how long at least one interval of each key holds."""
    before = Window.partitionBy(*keys, "bucket").orderBy(start, end).rowsBetween(Window.unboundedPreceding, -1)
    pieces = spread(df, bucket, start, end).withColumn("reached", F.max(end).over(before))
    adds = F.greatest(F.lit(0), F.col(end) - F.greatest(F.col(start), F.coalesce("reached", start)))
    return pieces.groupBy(*keys).agg(F.sum(adds).alias("union_us"))


def _islands(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(start, end)
    reached = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = df.withColumn("opens", F.when(reached.isNull() | (F.col(start) > reached), 1).otherwise(0))
    numbered = marked.withColumn("island", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("island")


def _at_edges(start: str, end: str, bucket: int) -> Column:
    """Whether a piece reaches an edge of its bucket, where a neighbour may go on with it."""
    return (F.col(start) == F.col("bucket") * bucket) | (F.col(end) == (F.col("bucket") + 1) * bucket)


def merged(df: DataFrame, keys: Sequence[str], bucket: int = DAY, start: str = "start_us", end: str = "end_us") -> DataFrame:
    """keys, start, end of the union's intervals; those that touch are one.

    Pieces within a bucket are done there; only those at its edges, two a bucket at most, are sorted by key.
    """
    local = _islands(spread(df.select(*keys, start, end), bucket, start, end), [*keys, "bucket"], start, end)
    inner, outer = local.filter(~_at_edges(start, end, bucket)), local.filter(_at_edges(start, end, bucket))
    return inner.select(*keys, start, end).unionByName(_islands(outer.drop("bucket"), keys, start, end))


def complement(df: DataFrame, keys: Sequence[str], lo: int | Column, hi: int | Column, start: str = "start_us", end: str = "end_us") -> DataFrame:
    """keys, start, end of the gaps in [lo, hi) for each key that has an interval there."""
    lo, hi = (x if isinstance(x, Column) else F.lit(x) for x in (lo, hi))
    inside = clamp(merged(df, keys, start=start, end=end), lo, hi, start, end)
    order = Window.partitionBy(*keys).orderBy(start)
    after = inside.select(*keys, F.col(end).alias(start), F.coalesce(F.lead(start).over(order), hi).alias(end))
    first = inside.groupBy(*keys).agg(F.min(start).alias(end)).select(*keys, lo.alias(start), end)
    return after.unionByName(first).filter(F.col(end) > F.col(start))


def join_adjacent(df: DataFrame, keys: Sequence[str], same: Sequence[str], eps: int = 0, start: str = "start_us", end: str = "end_us", bucket: int | None = None) -> DataFrame:
    """Neighbours that meet within eps and agree in same (nulls agree) become one span.

    With bucket, spans are dealt by key and the time bucket of their start.
    """
    if bucket is None:
        order = Window.partitionBy(*keys).orderBy(start)
        marked = df.withColumn("previous_", F.lag(F.struct(start, *same, end)).over(order))
    else:
        marked = buckets.previous(buckets.dealt(df, start, bucket), keys, start, [*same, end])
    before, agrees = F.col("previous_"), F.lit(True)
    for c in same:
        agrees = agrees & before[c].eqNullSafe(F.col(c))
    marked = marked.withColumn("opens", F.when(before.isNull() | ~agrees | (F.col(start) - before[end] > eps), 1).otherwise(0))
    if bucket is None:
        marked = marked.withColumn("span", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    else:
        marked = buckets.running(marked, keys, start, "opens", "span")
    return marked.groupBy(*keys, "span", *same).agg(F.min(start).alias(start), F.max(end).alias(end)).drop("span")


def join_across(local: DataFrame, keys: Sequence[str], same: Sequence[str], bucket: int = DAY, start: str = "start_us", end: str = "end_us") -> DataFrame:
    """Spans that were joined within their bucket: only those at bucket edges, two a bucket, are joined by key."""
    at_edges = _at_edges(start, end, bucket)
    inner, outer = local.filter(~at_edges).drop("bucket"), local.filter(at_edges).drop("bucket")
    return inner.unionByName(join_adjacent(outer, keys, same, 0, start, end))


def partition_violations(df: DataFrame, keys: Sequence[str], lo: Column | int, hi: Column | int, eps: int = 0, start: str = "start_us", end: str = "end_us") -> DataFrame:
    """keys, overlaps, gaps, bad_ends: all 0 where the spans partition [lo, hi)."""
    lo, hi = (x if isinstance(x, Column) else F.lit(x) for x in (lo, hi))
    step = F.col(start) - F.lag(end).over(Window.partitionBy(*keys).orderBy(start, end))
    out = df.withColumn("step", step).withColumns({"lo_": lo, "hi_": hi})
    return out.groupBy(*keys).agg(
        F.count_if(F.col("step") < -eps).alias("overlaps"),
        F.count_if(F.col("step") > eps).alias("gaps"),
        ((F.abs(F.min(start) - F.min("lo_")) > eps).cast("long") + (F.abs(F.max(end) - F.max("hi_")) > eps).cast("long")).alias("bad_ends"),
    )


def snap(x: Column, grid: int) -> Column:
    """The nearest multiple of grid, halves to the even one."""
    return (F.bround(x / grid) * grid).cast("long")


def ledger(observations: DataFrame, keys: Sequence[str], priority: Sequence[str], lo: int, hi: int, bucket: int = DAY, uncovered: str = "uncovered", start: str = "start_us", end: str = "end_us", status: str = "status") -> DataFrame:
    """keys, start, end, status: a partition of [lo, hi) by the first class of priority that holds there.

    A sweep over edges: each class counts its open intervals, so no interval meets another in a join.
    Every key gets the time without observations as uncovered, whole buckets included.
    """
    obs = clamp(observations.select(*keys, start, end, status), lo, hi, start, end)
    cut = spread(obs, bucket, start, end)
    opened = [F.when(F.col(status) == c, 1).otherwise(0).alias(f"d{i}") for i, c in enumerate(priority)]
    closed = [F.when(F.col(status) == c, -1).otherwise(0).alias(f"d{i}") for i, c in enumerate(priority)]
    buckets = F.explode(F.sequence(F.lit(lo // bucket), F.lit((hi - 1) // bucket)))
    frame = observations.select(*keys).distinct().withColumn("bucket", buckets)
    zeros = [F.lit(0).alias(f"d{i}") for i in range(len(priority))]
    edges = (
        cut.select(*keys, "bucket", F.col(start).alias("edge"), *opened)
        .unionByName(cut.select(*keys, "bucket", F.col(end).alias("edge"), *closed))
        .unionByName(frame.select(*keys, "bucket", F.greatest(F.col("bucket") * bucket, F.lit(lo)).alias("edge"), *zeros))
        .groupBy(*keys, "bucket", "edge").agg(*(F.sum(f"d{i}").alias(f"d{i}") for i in range(len(priority))))
    )
    order = Window.partitionBy(*keys, "bucket").orderBy("edge")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    winner = F.coalesce(*(F.when(F.sum(f"d{i}").over(upto) > 0, F.lit(c)) for i, c in enumerate(priority)), F.lit(uncovered))
    stop = F.least((F.col("bucket") + 1) * bucket, F.lit(hi))
    cells = edges.select(*keys, "bucket", F.col("edge").alias(start), F.coalesce(F.lead("edge").over(order), stop).alias(end), winner.alias(status))
    local = join_adjacent(cells.filter(F.col(end) > F.col(start)), [*keys, "bucket"], [status], 0, start, end)
    at_edges = _at_edges(start, end, bucket) | (F.col(start) == lo) | (F.col(end) == hi)
    inner, outer = local.filter(~at_edges).drop("bucket"), local.filter(at_edges).drop("bucket")
    return inner.unionByName(join_adjacent(outer, keys, [status], 0, start, end))


def stitch(points: DataFrame, keys: Sequence[str], max_gap: int, at: str = "at_us", bucket: int = DAY) -> DataFrame:
    """keys, first_us, last_us, n_points: runs of points at most max_gap apart.

    Runs are made within buckets; only the first and the last one of a bucket may go on in another, and those are joined by key.
    """
    own = [*keys, "bucket_"]
    order = Window.partitionBy(*own).orderBy(at)
    opens = F.when(F.col(at) - F.lag(at).over(order) <= max_gap, 0).otherwise(1)
    numbered = buckets.dealt(points, at, bucket).withColumn("opens", opens).withColumn("run_", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = numbered.groupBy(*own, "run_").agg(F.min(at).alias("first_us"), F.max(at).alias("last_us"), F.count("*").alias("n_points"))
    runs = runs.withColumn("outer_", (F.col("run_") == 1) | (F.col("run_") == F.max("run_").over(Window.partitionBy(*own))))
    inner, outer = runs.filter("not outer_").select(*keys, "first_us", "last_us", "n_points"), runs.filter("outer_")
    order = Window.partitionBy(*keys).orderBy("first_us")
    opens = F.when(F.col("first_us") - F.lag("last_us").over(order) <= max_gap, 0).otherwise(1)
    joined = outer.withColumn("opens", opens).withColumn("run_", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    joined = joined.groupBy(*keys, "run_").agg(F.min("first_us").alias("first_us"), F.max("last_us").alias("last_us"), F.sum("n_points").alias("n_points"))
    return inner.unionByName(joined.drop("run_"))


def spells(points: DataFrame, keys: Sequence[str], max_gap: int, at: str = "at_us", bucket: int = DAY) -> DataFrame:
    """keys, n_spells: runs of points; a gap longer than max_gap starts a new one."""
    return stitch(points.select(*keys, at), keys, max_gap, at, bucket).groupBy(*keys).agg(F.count("*").alias("n_spells"))


def largest(spans: DataFrame, n: int, start: str = "start_us", end: str = "end_us", *tie: str) -> DataFrame:
    """The n longest spans."""
    return spans.withColumn("dur_us", F.col(end) - F.col(start)).orderBy(F.desc("dur_us"), start, *tie).limit(n)
