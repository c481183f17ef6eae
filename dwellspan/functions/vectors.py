"""Distances between vectors (ARRAY of numbers) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y))


def l2_normalised(a: Column) -> Column:
    norm = F.sqrt(dot(a, a))
    return F.transform(a, lambda x: F.try_divide(x.cast("double"), norm))


def bhattacharyya(a: Column, b: Column) -> Column:
    """1 minus the coefficient of two histograms."""
    return 1 - _sum(F.zip_with(a, b, lambda x, y: F.sqrt(x.cast("double") * y)))


def mean_abs_diff(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y))) / F.size(a)


def half_l1(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y))) / 2


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(_sum(F.zip_with(a, b, lambda x, y: (x.cast("double") - y) * (x.cast("double") - y))))


def strip_distance(hist_a: Column, hist_b: Column, profile_a: Column, profile_b: Column) -> Column:
    return 0.75 * bhattacharyya(hist_a, hist_b) + 0.25 * F.least(4 * mean_abs_diff(profile_a, profile_b), F.lit(1.0))


def frame_distance(hist_a: Column, hist_b: Column, profile_a: Column, profile_b: Column) -> Column:
    return 0.6 * half_l1(hist_a, hist_b) + 0.4 * F.least(F.lit(1.0), mean_abs_diff(profile_a, profile_b) / 4)


def mean_drift(p: Column, q: Column) -> Column:
    """Mean distance of points (ARRAY<STRUCT<x, y>>) that belong together."""
    return _sum(F.zip_with(p, q, lambda a, b: F.hypot(a["x"] - b["x"], a["y"] - b["y"]))) / F.size(p)
