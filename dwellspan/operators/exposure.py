"""From observations to seconds, sizes and positions of each brand."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import intervals
from .records import percentiles


def by_brand(detail: DataFrame, keys: Sequence[str], period: Column, duration_s: Column, order: str, min_seconds: float = 0.0) -> DataFrame:
    """One row for each key from detail rows (frame, n_panels, area_px, area_pct, dist_center, area_source, time_basis, identified_by, paying, t).

    Time counts distinct frames, so panels of one picture add size but no time. Measures ignore nulls.
    """
    bases = F.collect_set("time_basis")
    out = detail.groupBy(*keys).agg(
        (F.count_distinct("frame") * F.max(period)).alias("exposure_s"),
        F.count_distinct("frame").alias("n_frames"),
        F.min_by("paying", order).alias("paying"),
        F.when(F.size(bases) == 1, bases[0]).otherwise("mixed").alias("time_basis"),
        F.avg("n_panels").alias("mean_panels"),
        F.avg("area_px").alias("mean_area_px"),
        F.avg("area_pct").alias("mean_area_pct"),
        F.avg("dist_center").alias("mean_dist_center"),
        F.min("t").alias("first_seen_s"),
        F.max("t").alias("last_seen_s"),
        (100 * F.count_if(F.col("area_source") == "whole_band") / F.count("*")).alias("area_from_whole_band_pct"),
        F.concat_ws(",", F.array_sort(F.collect_set("identified_by"))).alias("identified_by"),
    )
    out = out.withColumn("time_is_upper_bound", F.col("time_basis") != "per_frame").withColumn("pct_of_video", 100 * F.col("exposure_s") / duration_s)
    return out.filter(F.col("exposure_s") >= min_seconds)


def merge_surfaces(detail: DataFrame, keys: Sequence[str], surface: str = "surface", start: str = "start_us", end: str = "end_us") -> DataFrame:
    """keys, union_us, n_surfaces, surfaces, n_samples: time on any surface counts once. records.merged_summary adds means."""
    time = intervals.union_measure(detail, keys, start=start, end=end)
    rest = detail.groupBy(*keys).agg(F.count_distinct(surface).alias("n_surfaces"), F.concat_ws(",", F.array_sort(F.collect_set(surface))).alias("surfaces"), F.count_distinct(surface, start).alias("n_samples"))
    return rest.join(time, list(keys))


def read_summary(hits: DataFrame, keys: Sequence[str], frame: str, confidence: str, match: str, period: Column, min_frames: int = 2) -> DataFrame:
    """keys, n_frames, reads_per_frame, mean_conf, mean_match, exposure_s, dropped: fewer than min_frames frames are reported as dropped."""
    out = hits.groupBy(*keys).agg(
        F.count_distinct(frame).alias("n_frames"), (F.count("*") / F.count_distinct(frame)).alias("reads_per_frame"),
        F.avg(confidence).alias("mean_conf"), F.avg(match).alias("mean_match"), (F.count_distinct(frame) * F.max(period)).alias("exposure_s"),
    )
    return out.withColumn("dropped", F.col("n_frames") < min_frames)


def running_stats(detections: DataFrame, brand: str, frame: str, step_s: float, measures: Sequence[str]) -> DataFrame:
    """brand, exposure_s, n_detections and means: time once for a frame and brand, measures for each detection."""
    return detections.groupBy(brand).agg((F.count_distinct(frame) * step_s).alias("exposure_s"), F.count("*").alias("n_detections"), *(F.avg(m).alias(f"mean_{m}") for m in measures))


def clutter(rows: DataFrame, frame: Sequence[str], brand: str, name: str = "n_brands_in_frame") -> DataFrame:
    """rows with the number of distinct brands in their frame."""
    n = rows.groupBy(*frame).agg(F.count_distinct(brand).alias(name))
    return rows.join(n, list(frame))


def mode_purity(rows: DataFrame, keys: Sequence[str], label: str, order: str) -> DataFrame:
    """keys, label, purity, n: the commonest label of each key, the one seen first of equal ones, and its share."""
    counts = rows.groupBy(*keys, label).agg(F.count("*").alias("n_label"), F.min(order).alias("seen"))
    return counts.groupBy(*keys).agg(F.max_by(label, F.struct("n_label", -F.col("seen"))).alias(label), F.max("n_label").alias("n_mode"), F.sum("n_label").alias("n")).withColumn("purity", F.col("n_mode") / F.col("n")).drop("n_mode")


def best_per_frame(rows: DataFrame, frame: Sequence[str], confidence: str, order: str, take: Sequence[str]) -> DataFrame:
    """The row of the highest confidence of each frame, the first of equal ones."""
    best = F.max_by(F.struct(confidence, *take), F.struct(F.col(confidence), -F.col(order)))
    return rows.groupBy(*frame).agg(best.alias("b_")).select(*frame, "b_.*")


def totals(by_brand_: DataFrame) -> DataFrame:
    return by_brand_.agg(F.count("*").alias("n_brands"), F.count_if("paying").alias("n_paying"), F.sum("exposure_s").alias("total_s"), F.sum(F.when(F.col("paying"), F.col("exposure_s")).otherwise(0.0)).alias("paying_s"))


def temporal_mad(frames: DataFrame, values: str) -> DataFrame:
    """pos, median, mad of each position of an array over all rows."""
    flat = frames.select(F.posexplode(values).alias("pos", "v")).withColumn("v", F.col("v").cast("double"))
    medians = percentiles(flat, ["pos"], "v", [0.5]).withColumnRenamed("p50", "median")
    off = flat.join(medians, "pos").select("pos", F.abs(F.col("v") - F.col("median")).alias("off"))
    return medians.join(percentiles(off, ["pos"], "off", [0.5]).withColumnRenamed("p50", "mad"), "pos")


def overlay_verdict(mad: DataFrame, n_frames: Column, static_below: float, min_frames: int = 8, min_scene: float = 12.0, max_share: float = 0.25) -> DataFrame:
    """ok, reason, n_static: whether positions that never change may be masked, and if not why."""
    share = F.count_if(F.col("mad") <= static_below) / F.count("*")
    reason = F.when(n_frames < min_frames, "too few frames").when(F.percentile("mad", F.lit(0.9)) < min_scene, "the scene does not change").when(share > max_share, "too much would be masked")
    out = mad.agg(reason.alias("reason"), F.count_if(F.col("mad") <= static_below).alias("n_static"))
    return out.select(F.col("reason").isNull().alias("ok"), "reason", F.when(F.col("reason").isNull(), F.col("n_static")).otherwise(0).alias("n_static"))


def drift_bands(rows: DataFrame, drift: str, confidence: str, bounds: Sequence[float] = (0.35, 0.6, 0.8)) -> DataFrame:
    """band, n, median, p90, worst drift by band of confidence."""
    band = F.lit(len(bounds))
    for k, b in reversed(list(enumerate(bounds))):
        band = F.when(F.col(confidence) < b, k).otherwise(band)
    own = rows.select(band.alias("band"), F.col(drift).alias("drift_"))
    ranks = percentiles(own, ["band"], "drift_", [0.5, 0.9]).withColumnsRenamed({"p50": "median_drift", "p90": "p90_drift"})
    return own.groupBy("band").agg(F.count("*").alias("n"), F.max("drift_").alias("max_drift")).join(ranks, "band", "left")


def probe_summary(probes: DataFrame, keys: Sequence[str], confidence: str, frame: str, threshold: float) -> DataFrame:
    """keys, median_conf, bad_share, bad_frames, n_probed: how well a few probed frames of each key read; no reading counts as 0."""
    conf = F.coalesce(F.col(confidence), F.lit(0.0))
    bad = conf < threshold
    return probes.groupBy(*keys).agg(F.median(conf).alias("median_conf"), (F.count_if(bad) / F.count("*")).alias("bad_share"), F.array_sort(F.collect_list(F.when(bad, F.col(frame)))).alias("bad_frames"), F.count("*").alias("n_probed"))


def medoids(vectors: DataFrame, cluster: str, item: str, vector: str) -> DataFrame:
    """cluster, item, distance: the item nearest to its cluster's mean, the smaller of equal ones."""
    flat = vectors.select(cluster, F.posexplode(vector).alias("pos", "v"))
    mean = flat.groupBy(cluster, "pos").agg(F.avg(F.col("v").cast("double")).alias("m"))
    mean = mean.groupBy(cluster).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"]).alias("mean"))
    away = F.sqrt(F.aggregate(F.zip_with(F.col(vector), F.col("mean"), lambda x, y: (x.cast("double") - y) * (x.cast("double") - y)), F.lit(0.0), lambda a, x: a + x))
    near = vectors.join(mean, cluster).withColumn("distance", F.round(away, 9))
    return near.groupBy(cluster).agg(F.min(F.struct("distance", item)).alias("b_")).select(cluster, f"b_.{item}", "b_.distance")


def upper_median(sizes: DataFrame, size: str) -> DataFrame:
    """n, largest, median (the upper of two middle ones), singletons."""
    counts = sizes.groupBy(size).agg(F.count("*").alias("n"))
    upto = counts.withColumn("upto", F.sum("n").over(Window.orderBy(size))).withColumn("total", F.sum("n").over(Window.partitionBy(F.lit(1))))
    return upto.agg(F.max("total").alias("n"), F.max(size).alias("largest"), F.min(F.when(F.col("upto") > F.floor(F.col("total") / 2), F.col(size))).alias("median"), F.max(F.when(F.col(size) == 1, F.col("n")).otherwise(0)).alias("singletons"))
