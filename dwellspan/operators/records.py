"""Records of single moments and what follows from them: exposure rows, evidence of five kinds, back-joins, orders, rollups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry

# Shares of distances that a run reports.
QUANTILES = (0.1, 0.5, 0.9)


def exposure_rows(rows: DataFrame, width: Column, height: Column) -> DataFrame:
    """One row for a sighting (t, frame, shot, brand, surface, poly, source, conf, ...) with its derived measures, rounded.

    occluded_frac, clarity, n_brands_in_frame, anchor_frame, anchor_age_s and fb_error_px may be missing or null;
    what is hidden is held within 0 and 1.
    """
    given = lambda c, default=None: (F.coalesce(F.col(c), F.lit(default)) if default is not None else F.col(c)) if c in rows.columns else F.lit(default)
    area = geometry.area(F.col("poly"))
    share = area / F.greatest(width * height, F.lit(1))
    hidden = F.greatest(F.lit(0.0), F.least(F.lit(1.0), given("occluded_frac", 0.0).cast("double")))
    whole = F.transform("poly", lambda p: F.struct(p["x"].cast("long").alias("x"), p["y"].cast("long").alias("y")))
    return rows.select(
        F.round("t", 3).alias("t"), F.col("frame").cast("long").alias("frame"), F.col("shot").cast("long").alias("shot"), "brand", "surface", whole.alias("poly"),
        F.round(area, 1).alias("area_px"), F.round(share, 6).alias("area_frac"), F.round(hidden, 3).alias("occluded_frac"), F.round(share * (1 - hidden), 6).alias("visible_area_frac"),
        F.round(geometry.centrality(F.col("poly"), width, height), 3).alias("centrality"), F.round(given("clarity", 1.0).cast("double"), 3).alias("clarity"),
        given("n_brands_in_frame", 1).cast("long").alias("n_brands_in_frame"), "source", given("anchor_frame").cast("long").alias("anchor_frame"),
        F.round(given("anchor_age_s").cast("double"), 3).alias("anchor_age_s"), F.round(F.col("conf").cast("double"), 3).alias("conf"), F.round(given("fb_error_px").cast("double"), 2).alias("fb_error_px"),
    )


def coverage_spans(cells: DataFrame, keys: Sequence[str] = (), start: str = "start_us", end: str = "end_us") -> DataFrame:
    """Ledger cells as spans in seconds: t_start, t_end, dur_s, status and what else of shot, source, conf, reason there is."""
    more = [F.round(F.col(c).cast("double"), 3).alias(c) if c == "conf" else F.col(c) for c in ("shot", "source", "conf", "reason") if c in cells.columns]
    seconds = lambda us: us / 1_000_000
    return cells.select(*keys, F.round(seconds(F.col(start)), 3).alias("t_start"), F.round(seconds(F.col(end)), 3).alias("t_end"), F.round(seconds(F.col(end) - F.col(start)), 3).alias("dur_s"), "status", *more)


def _evidence(rows: DataFrame, keys: Sequence[str], start: Column, end: Column, status, source, conf, shot=None) -> DataFrame:
    column = lambda x: x if isinstance(x, Column) else F.lit(x)
    return rows.select(*keys, start.alias("start_us"), end.alias("end_us"), column(status).alias("status"), column(source).alias("source"), column(conf).cast("double").alias("conf"), column(shot).cast("long").alias("shot"))


def human_evidence(annotations: DataFrame, keys: Sequence[str], half: int, at: str = "at_us") -> DataFrame:
    return _evidence(annotations, keys, F.col(at) - half, F.col(at) + half, "human", "human", 1.0, F.col("shot"))


def readable(detections: DataFrame, min_conf: float = 0.55) -> DataFrame:
    """Detections with a band that is sure enough."""
    return detections.filter(F.col("band").isNotNull() & (F.coalesce("conf", F.lit(0.0)) >= min_conf))


def auto_evidence(detections: DataFrame, keys: Sequence[str], half: int, min_conf: float = 0.55, at: str = "at_us") -> DataFrame:
    return _evidence(readable(detections, min_conf), keys, F.col(at) - half, F.col(at) + half, "auto", "auto", F.col("conf"))


def scan_evidence(scans: DataFrame, keys: Sequence[str], half: int, at: str = "at_us", hits: str = "hits") -> DataFrame:
    """Scanned frames; hits holds the confidences of what they named. One that names nothing was still looked at."""
    named = F.coalesce(F.size(hits) > 0, F.lit(False))
    return _evidence(scans, keys, F.col(at) - half, F.col(at) + half, F.when(named, "scan").otherwise("scan_blank"), "scan", F.when(named, F.array_max(hits)).otherwise(0.0))


def group_evidence(groups: DataFrame, keys: Sequence[str], half: int, at: str = "at_us", members: str = "members", brands: str = "brands") -> DataFrame:
    """Groups of frames read as one, from the first frame on for as long as all of them stand for."""
    named = F.coalesce(F.size(brands) > 0, F.lit(False))
    end = F.col(at) + F.coalesce(F.col(members), F.lit(1)) * 2 * half
    return _evidence(groups, keys, F.col(at), end, F.when(named, "scan").otherwise("scan_blank"), "vision", F.when(named, 1.0).otherwise(0.0))


def is_tracked(source: Column) -> Column:
    return source.startswith("tracked")


def half_step(frames: DataFrame, keys: Sequence[str], default: int, at: str = "at_us", name: str = "half_us") -> DataFrame:
    """keys and half the time between their first two distinct moments, the default where there is one only."""
    first = frames.groupBy(*keys).agg(F.min(at).alias("first_"))
    second = frames.join(first, list(keys)).filter(F.col(at) > F.col("first_")).groupBy(*keys).agg(F.min(at).alias("second_"))
    return first.join(second, list(keys), "left").select(*keys, F.coalesce(F.floor((F.col("second_") - F.col("first_")) / 2), F.lit(default)).cast("long").alias(name))


def tracked_evidence(exposures: DataFrame, keys: Sequence[str], default_half: int, at: str = "at_us", order: str = "brand") -> DataFrame:
    """Tracked rows, each frame once at its best confidence, half a step either side."""
    tracked = exposures.filter(is_tracked(F.col("source")))
    best = tracked.groupBy(*keys, at).agg(F.max_by(F.struct("source", "conf", "shot"), F.struct(F.col("conf"), F.col(order))).alias("b_"))
    spans = best.join(half_step(best, keys, default_half, at), list(keys))
    return _evidence(spans, keys, F.col(at) - F.col("half_us"), F.col(at) + F.col("half_us"), "tracked", F.col("b_.source"), F.col("b_.conf"), F.col("b_.shot"))


def of_shot_types(frames: DataFrame, types: Sequence[str], kind: str = "type") -> DataFrame:
    """Frames of shots of these types; without types all, and frames of no shot always."""
    return frames.filter(F.col(kind).isNull() | F.col(kind).isin(*types)) if types else frames


def review_queue(shots: DataFrame, min_dur: float = 0.0) -> DataFrame:
    """Shots that a person should see: sent to review, drawn for a check, or partial; long enough to matter."""
    wanted = (F.col("route") == "review") | F.coalesce("qa", F.lit(False)) | F.coalesce("partial", F.lit(False))
    return shots.filter(wanted & (F.col("dur_s") >= min_dur))


def anchors(annotations: DataFrame, shots: DataFrame, boxes: str = "boxes", shot: str = "shot") -> DataFrame:
    """One row for each box of an annotation whose shot is known, with the shot's columns."""
    one = annotations.withColumn("box", F.explode(boxes)).drop(boxes)
    return one.join(shots, shot)


def with_brightness(rows: DataFrame, regions: DataFrame, frames: DataFrame, brand: str = "brand", frame: str = "frame") -> DataFrame:
    """rows with brightness and brightness_rel; regions has (brand, frame, region_mean), frames has (frame, frame_mean). Null where not measured."""
    measured = regions.join(frames, frame).select(brand, frame, F.round("region_mean", 1).alias("brightness"), F.round(geometry.relative_brightness(F.col("region_mean"), F.col("frame_mean")), 3).alias("brightness_rel"))
    return rows.join(measured, [brand, frame], "left")


def needed_frames(frames: DataFrame, rows: DataFrame, frame: str = "frame") -> DataFrame:
    """The frames that some row is about; a semi-join, so that others are not decoded."""
    return frames.join(rows.select(frame).distinct(), frame, "left_semi")


def unmatched_tally(texts: DataFrame, text: str = "text", min_chars: int = 4, top: int = 25) -> DataFrame:
    """text, n: the strings that most often fit no name; equal counts by text."""
    t = F.trim(F.col(text))
    return texts.filter(F.length(t) >= min_chars).groupBy(t.alias("text")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "text").limit(top)


def sponsor_seconds(found: DataFrame, groups: DataFrame, group: str = "creative", brand: str = "brand") -> DataFrame:
    """brand, seconds: frames of a brand in each group times what a read frame of the group stands for.

    found has (group, brand, n_frames), groups has (group, seconds, n_read).
    """
    each = groups.select(group, (F.col("seconds") / F.greatest("n_read", F.lit(1))).alias("each_"))
    return found.join(each, group).groupBy(brand).agg(F.sum(F.col("n_frames") * F.col("each_")).alias("seconds"))


def state_status(states: DataFrame, reads: DataFrame, named: DataFrame, group: str = "creative", frame: str = "frame", state: str = "state") -> DataFrame:
    """group, state, n_frames, status: read where a brand was read on a frame of the state or its group is named otherwise, else unread.

    states has (group, state, frame), reads (group, frame), named (group).
    """
    seen = reads.select(group, frame).distinct().withColumn("seen_", F.lit(1))
    own = states.join(seen, [group, frame], "left").groupBy(group, state).agg(F.count("*").alias("n_frames"), F.max("seen_").alias("seen_"))
    known = named.select(group).distinct().withColumn("named_", F.lit(1))
    both = own.join(known, group, "left")
    return both.select(group, state, "n_frames", F.when(F.col("seen_").isNotNull() | F.col("named_").isNotNull(), "read").otherwise("unread").alias("status"))


def state_rollup(status: DataFrame, seconds: str | None = None) -> DataFrame:
    """n_read, n_unread and, with a column of seconds, unread_s."""
    unread = F.col("status") == "unread"
    more = [F.coalesce(F.sum(F.when(unread, F.col(seconds))), F.lit(0)).alias("unread_s")] if seconds else []
    return status.agg(F.count_if(F.col("status") == "read").alias("n_read"), F.count_if(unread).alias("n_unread"), *more)


def _joined(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """left with the columns of right, which has a row for each key; null keys are one."""
    if not keys:
        return left.crossJoin(F.broadcast(right))  # one row
    renamed = right.withColumnsRenamed({k: f"k_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & left[k].eqNullSafe(renamed[f"k_{k}"])
    return left.join(renamed, on).drop(*(f"k_{k}" for k in keys))


def _bracketed(own: DataFrame, keys: Sequence[str], shares: Sequence[float], accuracy: int) -> tuple[DataFrame, DataFrame]:
    """Of values v_: for each key how many lie below each share's bracket (below_, n_), and the distinct values inside with their counts (share_, v_, c_)."""
    lows, highs = ([min(max(s + side * 3 / accuracy, 0.0), 1.0) for s in shares] for side in (-1, 1))
    ends = own.groupBy(*keys).agg(F.percentile_approx("v_", lows, accuracy).alias("lo_"), F.percentile_approx("v_", highs, accuracy).alias("hi_"), F.count("*").alias("n_"))
    # few values are all ranked, as one rank may be more than the brackets allow for
    ends = ends.withColumns({c: F.when(F.col("n_") > accuracy, F.col(c)) for c in ("lo_", "hi_")})
    both = _joined(own, ends, keys)
    below = F.array(*(F.count_if(F.coalesce(F.col("v_") < F.col("lo_")[k], F.lit(False))) for k in range(len(shares))))
    inside = F.array(*(F.coalesce((F.col("v_") >= F.col("lo_")[k]) & (F.col("v_") <= F.col("hi_")[k]), F.lit(True)) for k in range(len(shares))))
    held = both.select(*keys, "v_", F.posexplode(inside).alias("share_", "in_")).filter("in_").groupBy(*keys, "share_", "v_").agg(F.count("*").alias("c_"))
    return both.groupBy(*keys).agg(below.alias("below_"), F.max("n_").alias("n_")), held


def percentiles(df: DataFrame, keys: Sequence[str], value: str, shares: Sequence[float] = QUANTILES, accuracy: int = 2000) -> DataFrame:
    """keys and p10, p50, ... by linear interpolation between ranks; exact, without all values of a key in one task.

    A first pass brackets each wanted rank between two approximate quantiles, whose ranks err by a share of 1 / accuracy at most; a second
    one counts what lies below each bracket and ranks only the values inside, about 6 / accuracy of all whatever
    their distribution, where equal values are one row. Null values don't count; NaN is above all numbers.
    """
    names = [f"p{round(100 * s)}" for s in shares]
    own = df.select(*keys, F.col(value).cast("double").alias("v_")).filter("v_ is not null")
    counts, held = _bracketed(own, keys, shares, accuracy)
    place = _joined(held, counts, keys).withColumn("upto_", F.col("below_")[F.col("share_")] + F.sum("c_").over(Window.partitionBy(*keys, "share_").orderBy("v_")))
    position = F.element_at(F.array(*map(F.lit, shares)), F.col("share_") + 1) * (F.col("n_") - 1)
    rank = F.explode(F.array_distinct(F.array(F.floor(position), F.ceil(position)))).alias("rank_")
    found = place.select(*keys, "share_", "v_", "c_", "upto_", position.alias("pos_"), rank).filter("rank_ < upto_ and rank_ >= upto_ - c_")
    weight = F.lit(1.0) - F.abs(F.col("pos_") - F.col("rank_"))

    def value_of(k: int) -> Column:
        low = F.min(F.when(F.col("share_") == k, F.struct("rank_", "v_")))["v_"]
        high = F.max(F.when(F.col("share_") == k, F.struct("rank_", "v_")))["v_"]
        return low + F.when(high == low, 0.0).otherwise((high - low) * F.max(F.when((F.col("share_") == k) & (F.col("rank_") >= F.col("pos_")), weight).otherwise(0.0)))

    return found.groupBy(*keys).agg(*(value_of(k).alias(n) for k, n in enumerate(names)))


def running_totals(runs: DataFrame, keys: Sequence[str], order: str, counters: Sequence[str]) -> DataFrame:
    """runs with <counter>_total: what all runs of a key up to this one add up to; null counts nothing."""
    upto = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return runs.select("*", *(F.coalesce(F.sum(c).over(upto), F.lit(0)).alias(f"{c}_total") for c in counters))


def positions(df: DataFrame, order: Sequence[Column], name: str = "pos") -> DataFrame:
    """A small table, such as one row a brand, with positions from 1 in an order; the order should leave no ties."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)))


def paying_first(summary: DataFrame) -> DataFrame:
    """Paying brands before others, then by falling seconds, then by name."""
    return positions(summary, [F.desc("paying"), F.desc("exposure_s"), F.asc("brand")])


def truth_order(score: DataFrame) -> DataFrame:
    """Brands by falling seconds of the truth; those that it does not know last; then by name."""
    return positions(score, [F.desc_nulls_last("want"), F.asc("brand")])


def numbered(df: DataFrame, bucket: Column, order: Sequence[Column], name: str = "pos") -> DataFrame:
    """df with positions from 1 in an order that begins with bucket: counts of buckets are added up, rows are sorted within theirs only."""
    own = df.withColumn("bucket_", bucket)
    counts = own.groupBy("bucket_").agg(F.count("*").alias("n_"))
    starts = counts.select(F.col("bucket_").alias("b_"), (F.sum("n_").over(Window.orderBy("bucket_")) - F.col("n_")).alias("before_"))
    placed = own.join(starts, own["bucket_"].eqNullSafe(starts["b_"]))
    return placed.withColumn(name, F.col("before_") + F.row_number().over(Window.partitionBy("bucket_").orderBy(*order))).drop("bucket_", "b_", "before_")


def budgeted(groups: DataFrame, need: Column, min_seconds: float, most: int, seconds: str = "seconds", tie: str = "creative") -> DataFrame:
    """The longest groups that need a call, of at least min_seconds, within a budget of calls."""
    return groups.filter(need & (F.col(seconds) >= min_seconds)).orderBy(F.desc(seconds), tie).limit(most)


def merged_summary(detail: DataFrame, keys: Sequence[str], measures: Sequence[str], duration_us: int, surface: str = "surface", frame: str = "frame") -> DataFrame:
    """One row a brand over surfaces (detail: surface, frame, start_us, end_us): union of time, samples, surfaces, means of the measures."""
    from .exposure import merge_surfaces

    time = merge_surfaces(detail, keys, surface).select(*keys, (F.col("union_us") / 1_000_000).alias("exposure_s"), (100 * F.col("union_us") / duration_us).alias("pct_of_video"), "n_surfaces", "surfaces")
    rest = detail.groupBy(*keys).agg(F.count_distinct(surface, frame).alias("n_frames"), (F.min("start_us") / 1_000_000).alias("first_seen_s"), (F.max("start_us") / 1_000_000).alias("last_seen_s"), *(F.avg(m).alias(f"mean_{m}") for m in measures))
    return time.join(rest, list(keys))


def labelled_union(surfaces: dict[str, DataFrame], name: str = "surface") -> DataFrame:
    """Rows of all surfaces with the label of their own; rows without a brand go."""
    out = None
    for label, rows in surfaces.items():
        own = rows.filter(F.coalesce(F.col("brand"), F.lit("")) != "").withColumn(name, F.lit(label))
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    return out


def seen_time(spans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, union_us, n_spans: the measure of a union of intervals and how many intervals it has."""
    from . import intervals

    return intervals.merged(spans, keys).groupBy(*keys).agg(F.sum(F.col("end_us") - F.col("start_us")).alias("union_us"), F.count("*").alias("n_spans"))


def common(df: DataFrame, by: Sequence[str], top: int | None = None) -> DataFrame:
    """by, n: counts of what occurs, the commonest first; equal counts by value."""
    counts = df.groupBy(*by).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), *by).limit(top) if top else counts


def flagged(rows: DataFrame, listed: DataFrame, key: str, name: str = "is_partner") -> DataFrame:
    """rows with whether their key is listed."""
    known = listed.select(F.col(key).alias("key_")).distinct()
    return rows.join(known, rows[key] == F.col("key_"), "left").withColumn(name, F.col("key_").isNotNull()).drop("key_")


def measured_confidence(rows: DataFrame, keys: Sequence[str], at: str, quality: str, steps: str, drift: float, name: str = "confidence") -> DataFrame:
    """rows with the running product of drift^steps * quality along the rows of a key; 0 from the first quality of 0 on."""
    upto = Window.partitionBy(*keys).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    logs = F.sum(F.col(steps) * F.log(F.lit(drift)) + F.when(F.col(quality) > 0, F.log(F.col(quality))).otherwise(0.0)).over(upto)
    dead = F.max(F.when(F.coalesce(F.col(quality), F.lit(0.0)) <= 0, 1).otherwise(0)).over(upto)
    return rows.withColumn(name, F.when(dead == 1, F.lit(0.0)).otherwise(F.exp(logs)))
