"""From strings that a reader saw to brands of groups of frames: the reader pass, readings from elsewhere, discovered names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import norm_name
from .resolve import resolve

# The least confidence of a reading, and the least length of a string that may be a new name.
MIN_READ_CONF, MIN_UNKNOWN_CHARS = 0.30, 4


def read_texts(reads: DataFrame, index: DataFrame, min_conf: float = MIN_READ_CONF) -> DataFrame:
    """reads (creative, frame, pos, text, conf, poly) that are sure enough, with name and match; each distinct string is compared once."""
    return resolve(reads.filter(F.col("conf") >= min_conf), index, "text")


def brand_records(read: DataFrame) -> DataFrame:
    """creative, name, score, ocr_text, ocr_conf, instances, n_frames, frames, boxes_by_frame, time_basis, source of the strings that fit a name.

    The label is the string of the best score, the first of equal ones; boxes are kept by frame.
    """
    hits = read.filter(F.col("name").isNotNull())
    best = F.max_by(F.struct("text", "conf"), F.struct(F.col("match"), -F.col("frame"), -F.col("pos")))
    records = hits.groupBy("creative", "name").agg(
        F.round(F.max("match"), 3).alias("score"), best.alias("b_"), F.count("*").alias("instances"), F.count_distinct("frame").alias("n_frames"), F.array_sort(F.collect_set("frame")).alias("frames"),
    )
    boxes = hits.filter(F.col("poly").isNotNull()).groupBy("creative", "name", "frame").agg(F.collect_list("poly").alias("polys"))
    boxes = boxes.groupBy("creative", "name").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("frame").cast("string"), "polys")))).alias("boxes_by_frame"))
    out = records.join(boxes, ["creative", "name"], "left")
    return out.select("creative", "name", "score", F.col("b_.text").alias("ocr_text"), F.round("b_.conf", 3).alias("ocr_conf"), "instances", "n_frames", "frames", "boxes_by_frame", F.lit("per_frame").alias("time_basis"), F.lit("ocr").alias("source"))


def unknown_texts(read: DataFrame, min_chars: int = MIN_UNKNOWN_CHARS) -> DataFrame:
    """creative, frame, norm, text, conf, poly of the strings that fit no name and are long enough to be one."""
    norm = norm_name(F.col("text"))
    return read.filter(F.col("name").isNull() & (F.length(norm) >= min_chars)).select("creative", "frame", norm.alias("norm"), F.trim("text").alias("text"), "conf", "poly")


def attach_unknown(promoted: DataFrame, hits: DataFrame, groups: DataFrame) -> DataFrame:
    """Records of discovered names for the groups that showed them: promoted has (norm, name), hits as unknown_texts, groups (creative)."""
    found = hits.join(promoted.select("norm", "name"), "norm").join(groups.select("creative").distinct(), "creative")
    return found.groupBy("creative", "name").agg(
        F.round(F.max("conf"), 3).alias("score"), F.first("name").alias("ocr_text"), F.count("*").alias("instances"), F.count_distinct("frame").alias("n_frames"), F.array_sort(F.collect_set("frame")).alias("frames"),
    ).withColumns({"paying": F.lit(True), "in_list": F.lit(False), "time_basis": F.lit("per_frame"), "source": F.lit("ocr_unlisted")})


def fold_readings(readings: DataFrame, groups: DataFrame, index: DataFrame, listed: DataFrame) -> DataFrame:
    """Records from readings (creative, text, paying) of groups (creative, frames, seconds); they stand for all frames of the group, an upper bound.

    A reading that fits a listed name takes its spelling and whether it pays; others keep theirs and score 1.
    Blank readings and those of unknown groups go. listed has (name, paying).
    """
    own = readings.withColumn("text", F.trim("text")).filter("text != ''").join(groups.select("creative", "frames", "seconds"), "creative")
    known = listed.select(F.col("name").alias("l_name"), F.col("paying").alias("l_paying"))
    found = resolve(own, index, "text").join(known, F.col("name") == F.col("l_name"), "left")
    fits = F.col("name").isNotNull()
    return found.select(
        "creative", F.coalesce("name", "text").alias("name"), F.when(fits, F.col("l_paying")).otherwise(F.coalesce("paying", F.lit(True))).alias("paying"), fits.alias("in_list"),
        F.round(F.when(fits, F.col("match")).otherwise(1.0), 3).alias("score"), F.col("text").alias("ocr_text"), F.coalesce(F.size("frames"), F.lit(0)).alias("n_frames"), "frames",
        F.lit(1).alias("instances"), F.lit("group").alias("time_basis"), F.lit("reading").alias("source"), "seconds",
    )


def with_readings(records: DataFrame, readings: DataFrame) -> DataFrame:
    """Records of groups; what readings say of a group stands in place of its other records."""
    return records.join(readings.select("creative").distinct(), "creative", "left_anti").unionByName(readings, allowMissingColumns=True)
