"""Decision rules over scalar measures, as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Distances at which a cut counts as one, by signal.
CUT_THRESHOLDS = {"hist": 0.25, "mad": 0.12, "layout": 0.042}
DRASTIC = 2.0


def _unit(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def seconds_of(frame: Column, fps: Column) -> Column:
    return F.round(frame / F.coalesce(F.nullif(fps, F.lit(0.0)), F.lit(25.0)), 3)


def sample_period(step: Column, fps: Column, default: float = 0.25) -> Column:
    return F.coalesce(F.nullif(step.cast("double"), F.lit(0.0)) / fps, F.lit(default))


def frame_type(green: Column, green_lower: Column, span: Column, centre: Column, skin: Column, dark: Column) -> Column:
    """STRUCT<label, confidence>."""
    answer = lambda label, conf: F.struct(F.lit(label).alias("label"), _unit(conf).alias("confidence"))
    wide = (span >= 0.45) & (green_lower >= 0.30) & (centre < 0.55)
    close = ((centre >= 0.70) | (skin >= 0.12)) & (green < 0.30)
    other = (green < 0.12) & (span < 0.20)
    return (
        F.when(wide, answer("wide_play", F.least((span - 0.45) / 0.35, (green_lower - 0.30) / 0.40, (0.55 - centre) / 0.35)))
        .when(close, answer("close", F.greatest((centre - 0.70) / 0.30, (skin - 0.12) / 0.20)))
        .when(other, answer("other", (0.12 - green) / 0.12 + dark))
        .otherwise(answer("medium", F.lit(0.3)))
    )


def route(label: Column, purity: Column, band_conf: Column, bad_frac: Column, min_purity: float = 0.60, max_bad: float = 0.25, min_conf: float = 0.55) -> Column:
    """STRUCT<route, reason>: auto only if type, stability and readings all agree."""
    review = lambda reason: F.struct(F.lit("review").alias("route"), F.lit(reason).alias("reason"))
    return (
        F.when(~label.eqNullSafe(F.lit("wide_play")), review("other type of shot"))
        .when(purity < min_purity, review("unstable label"))
        .when(band_conf.isNull(), review("not probed"))
        .when(bad_frac > max_bad, review("reads badly in parts"))
        .when(band_conf < min_conf, review("low confidence"))
        .otherwise(F.struct(F.lit("auto").alias("route"), F.lit("main camera").alias("reason")))
    )


# Measure, weight, bound, and whether it costs to be above (1) or below (-1) the bound.
BAND_PENALTIES = (
    ("span_ratio", 2.0, 0.72, -1),
    ("fit_resid", 2.0, 0.25, 1),
    ("slope_deg", 0.05, 8.0, 1),
    ("bridged_frac", 2.0, 0.15, 1),
    ("boundary_y", 3.0, 0.24, 1),
    ("grass_below", 1.5, 0.50, -1),
    ("band_grass", 2.5, 0.35, 1),
)


def band_confidence(measures: Mapping[str, Column]) -> Column:
    score = F.lit(1.0)
    for name, weight, bound, side in BAND_PENALTIES:
        score = score - weight * F.greatest(F.lit(0.0), side * (measures[name] - bound))
    return _unit(score)


def change_severity(hist: Column, mad: Column, layout: Column, thresholds: Mapping[str, float] = CUT_THRESHOLDS) -> Column:
    return F.greatest(hist / thresholds["hist"], mad / thresholds["mad"], layout / thresholds["layout"])


def may_carry(severity: Column) -> Column:
    return severity < DRASTIC


def gap_owner(shot_type: Column, detected: Column, scanned: Column) -> Column:
    """Which step owes a span its measurement."""
    main = shot_type.isin("wide_play", "medium")
    return (
        F.when(shot_type.isNull() & scanned, "not sampled")
        .when(shot_type.isNull(), "outside every shot")
        .when(main & ~detected, "detection has not run")
        .when(main, "read too poorly")
        .otherwise("no human reading")
    )


def doubts(dur_s: Column, purity: Column, partial: Column, band_conf: Column, severity: Column, shot: Column) -> Column:
    """ARRAY of what makes a shot uncertain."""
    flags = {
        "short": dur_s < 1.0,
        "unstable": purity < 0.70,
        "partial": partial,
        "borderline": (band_conf >= 0.35) & (band_conf < 0.60),
        "faint cut": (severity > 0) & (severity < 1.15) & (shot > 0),
    }
    return F.filter(F.array(*(F.when(test, name) for name, test in flags.items())), lambda x: x.isNotNull())


def call_tokens(width: Column, height: Column, prompt_chars: Column) -> Column:
    return F.floor(F.coalesce(width * height / 750, F.lit(800))) + F.floor(prompt_chars / 4)


def price(model: Column, prices: Mapping[str, tuple[float, float]]) -> Column:
    """STRUCT<input, output> a million tokens; unknown models cost as the dearest."""
    pair = lambda p: F.struct(F.lit(float(p[0])).alias("input"), F.lit(float(p[1])).alias("output"))
    known = F.lit(None).cast("struct<input:double,output:double>")
    for name, p in prices.items():
        known = F.when(model == name, pair(p)).otherwise(known)
    return F.coalesce(known, pair(max(prices.values())))


def running_confidence(drift: float, steps: Column, quality: Column) -> Column:
    """What one step of drift leaves of a quality; operators.records.measured_confidence multiplies steps up."""
    return F.pow(F.lit(drift), steps) * quality
