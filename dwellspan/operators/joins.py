"""Joins on time and ranges, written as sorted passes or bucketed equi-joins, never as nested loops."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _asof_local(left: DataFrame, right: DataFrame, keys: Sequence[str], left_at: str, right_at: str, take: Sequence[str], forward: bool, strict: bool = False) -> DataFrame:
    """keys, at_, l_ (the left row) and found_ (the right row)."""
    last = forward == strict  # whether left rows come behind right ones of the same time
    row = F.struct(F.col(right_at).alias("at_"), *(F.col(c).alias(f"r_{c}") for c in take))
    whole = F.struct(*(F.col(c) for c in left.columns))
    null = lambda df, c: F.lit(None).cast(df.select(c.alias("x")).schema["x"].dataType)
    both = left.select(*keys, F.col(left_at).alias("at_"), F.lit(1 if last else 0).alias("side_"), whole.alias("l_"), null(right, row).alias("r_"))
    both = both.unionByName(right.select(*keys, F.col(right_at).alias("at_"), F.lit(0 if last else 1).alias("side_"), null(left, whole).alias("l_"), row.alias("r_")))
    order = Window.partitionBy(*keys).orderBy("at_", "side_", "r_")
    if forward:
        found = F.first("r_", ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing))
    else:
        found = F.last("r_", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return both.withColumn("found_", found).filter("l_ is not null").select(*keys, "at_", "l_", "found_")


def asof(left: DataFrame, right: DataFrame, keys: Sequence[str], left_at: str, right_at: str, take: Sequence[str], tolerance: int | None = None, forward: bool = False, bucket: int | None = None, strict: bool = False) -> DataFrame:
    """left with the columns take, and right_at, of the last right row at or before left_at (or the first at or after it).

    With strict, rows of the same time don't count. Both sides are sorted together once by key and time. Where right rows tie, that of the largest
    (smallest, when forward) take values counts. With bucket, a key's time is cut into buckets that are
    sorted apart, and a bucket in which a left row finds nothing takes the nearest bucket's right row:
    so a key that holds most rows is spread over many tasks.
    """
    if bucket is None:
        out = _asof_local(left, right, keys, left_at, right_at, take, forward, strict)
    else:
        part = lambda df, at: df.withColumn("bucket_", F.floor(F.col(at) / bucket))
        l_, r = part(left, left_at), part(right, right_at)
        dealt = [*keys, "bucket_"]
        local = _asof_local(l_, r, dealt, left_at, right_at, take, forward, strict)
        row = F.struct(F.col(right_at).alias("at_"), *(F.col(c).alias(f"r_{c}") for c in take))
        edge = r.groupBy(*dealt).agg((F.min(row) if forward else F.max(row)).alias("edge_"))
        marks = edge.unionByName(l_.select(*dealt).distinct().withColumn("edge_", F.lit(None).cast(edge.schema["edge_"].dataType))).groupBy(*dealt).agg(F.max("edge_").alias("edge_"))
        order = Window.partitionBy(*keys).orderBy("bucket_")
        if forward:
            far = F.first("edge_", ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing))
        else:
            far = F.last("edge_", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
        out = local.join(marks.withColumn("far_", far).drop("edge_"), dealt, "left").withColumn("found_", F.coalesce("found_", "far_"))
    if tolerance is not None:
        out = out.withColumn("found_", F.when(F.abs(F.col("found_.at_") - F.col("at_")) <= tolerance, F.col("found_")))
    return out.select(*(F.col(f"l_.`{c}`").alias(c) for c in left.columns), F.col("found_.at_").alias(right_at), *(F.col(f"found_.r_{c}").alias(c) for c in take))


def point_in_range(points: DataFrame, ranges: DataFrame, keys: Sequence[str], at: str, lo: str, hi: str, take: Sequence[str], bucket: int | None = None, closed: bool = False) -> DataFrame:
    """points with take of the range lo <= at < hi; ranges of a key do not overlap. Points in none keep nulls.

    With closed, hi belongs to the range too, and a point where two ranges meet to the earlier one.
    """
    found = asof(points, ranges, keys, at, lo, [hi, *take], bucket=bucket)
    if not closed:
        inside = F.col(at) < F.col(hi)
        return found.select(*points.columns, *(F.when(inside, F.col(c)).alias(c) for c in take))
    found = found.select(*points.columns, F.struct(lo, hi, *take).alias("at_or_before_"))
    found = asof(found, ranges, keys, at, lo, [hi, *take], bucket=bucket, strict=True)
    one, two = F.col(at) <= F.col(hi), F.col(at) <= F.col(f"at_or_before_.{hi}")
    return found.select(*points.columns, *(F.when(one, F.col(c)).when(two, F.col(f"at_or_before_.{c}")).alias(c) for c in take))


def overlaps(left: DataFrame, right: DataFrame, keys: Sequence[str], bucket: int, take: Sequence[str], start: str = "start_us", end: str = "end_us") -> DataFrame:
    """Pairs of intervals that share time: an equi-join on key and time bucket; each pair comes once, in the bucket of its first shared moment."""
    deal = lambda df, lo, hi: df.filter(F.col(hi) > F.col(lo)).withColumn("bucket_", F.explode(F.sequence(F.floor(F.col(lo) / bucket), F.floor((F.col(hi) - 1) / bucket))))
    l_ = deal(left, start, end)
    r = deal(right.select(*keys, F.col(start).alias("r_start"), F.col(end).alias("r_end"), *take), "r_start", "r_end")
    both = l_.join(r, [*keys, "bucket_"]).filter((F.col(start) < F.col("r_end")) & (F.col("r_start") < F.col(end)))
    return both.filter(F.floor(F.greatest(F.col(start), F.col("r_start")) / bucket) == F.col("bucket_")).drop("bucket_")


def _bits(column: Column, level: Column) -> Column:
    return F.call_function("shiftright", column, level)


def _dyadic(df: DataFrame, grain: int, start: str, end: str, cover: bool, upto: int) -> DataFrame:
    """df with level and node of dyadic intervals of grain times 2^level: those that make up the interval, or with cover false those that hold one of these and more.

    Two of a level at most, so an interval is dealt to about twice as many as its length has digits in base two, or its nodes' depth.
    """
    lo, hi = F.floor(F.col(start) / grain), -F.floor(-F.col(end) / grain)
    rows = df.filter(F.col(end) > F.col(start)).withColumns({"lo_": lo, "hi_": hi}).withColumn("level_", F.explode(F.sequence(F.lit(0), F.lit(upto))))
    level, lo, hi = F.col("level_"), F.col("lo_"), F.col("hi_")
    first, last = _bits(lo, level), _bits(hi - 1, level)
    if cover:
        # what is left of the interval at this level begins and ends here; an odd begin, and an odd end, are nodes of their own
        begin, stop = -_bits(-lo, level), _bits(hi, level)
        found = F.array_distinct(F.array_compact(F.array(F.when((begin < stop) & (begin % 2 != 0), begin), F.when((begin < stop) & (stop % 2 != 0), stop - 1))))
    else:
        width = F.call_function("shiftleft", F.lit(1).cast("long"), level)
        beyond = lambda n: (n * width < lo) | ((n + 1) * width > hi)
        found = F.array_distinct(F.array_compact(F.array(F.when(beyond(first), first), F.when(beyond(last), last))))
    return rows.withColumn("node_", F.explode(found)).drop("lo_", "hi_")


def overlaps_any_length(left: DataFrame, right: DataFrame, keys: Sequence[str], grain: int, take: Sequence[str], start: str = "start_us", end: str = "end_us") -> DataFrame:
    """As ``overlaps``, for intervals of any lengths: an hour meets a year without a row for each hour of it.

    Two intervals share time if a dyadic node of one is, or lies in, a node of the other; so each side's nodes meet the other's nodes and
    those above them, in two equi-joins. A pair comes once, by the node that holds its first shared moment.
    Nodes above the largest one that a side is made of are not dealt, as nothing meets there.
    """
    r = right.select(*keys, F.col(start).alias("r_start"), F.col(end).alias("r_end"), *take)
    longest = left.agg(F.max(F.col(end) - F.col(start)).alias("n")).union(r.agg(F.max(F.col("r_end") - F.col("r_start")))).agg(F.max("n")).first()[0] or 0
    upto = max(int(longest) // grain, 1).bit_length()
    shares = (F.col(start) < F.col("r_end")) & (F.col("r_start") < F.col(end))
    moment = _bits(F.floor(F.greatest(F.col(start), F.col("r_start")) / grain), F.col("level_")) == F.col("node_")
    on, both = [*keys, "level_", "node_"], []
    for l_cover, r_covers in ((True, (True, False)), (False, (True,))):
        nodes = _dyadic(left, grain, start, end, l_cover, upto)
        for r_cover in r_covers:
            both.append(nodes.join(_dyadic(r, grain, "r_start", "r_end", r_cover, upto), on).filter(shares & moment).drop("level_", "node_"))
    return both[0].unionByName(both[1]).unionByName(both[2])


def anti_band(left: DataFrame, right: DataFrame, keys: Sequence[str], left_at: str, right_at: str, tolerance: int, bucket: int | None = None) -> DataFrame:
    """left rows without a right row within tolerance of them."""
    seen = right.select(*keys, F.col(right_at).alias("near_at"))
    back = asof(left, seen, keys, left_at, "near_at", [], bucket=bucket).withColumnRenamed("near_at", "back_at")
    both = asof(back, seen, keys, left_at, "near_at", [], forward=True, bucket=bucket)
    far = lambda c: F.col(c).isNull() | (F.abs(F.col(c) - F.col(left_at)) > tolerance)
    return both.filter(far("back_at") & far("near_at")).select(*left.columns)


def with_fallback(left: DataFrame, right: DataFrame, on: Sequence[str], take: Sequence[str], fallback) -> DataFrame:
    """Rows that match on a key, and what fallback (a function of the rest) makes of the others."""
    hit = left.join(right.select(*on, *take), list(on), "inner")
    rest = left.join(right.select(*on), list(on), "left_anti")
    return hit.unionByName(fallback(rest), allowMissingColumns=True)
