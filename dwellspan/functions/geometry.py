"""Polygons as ARRAY<STRUCT<x DOUBLE, y DOUBLE>> and what follows from them; all are column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bands that band_area looks at together, and corners of each that are in memory at a time.
BANDS, CORNERS = 512, 64


def held(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once however often use has it: Spark computes what lambdas share anew at each place."""
    return F.transform(F.array(value), use)[0]


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def rectangle(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.array(point(x1, y1), point(x2, y1), point(x2, y2), point(x1, y2))


def bbox(poly: Column) -> Column:
    """STRUCT<x1, y1, x2, y2>."""
    xs, ys = F.transform(poly, lambda p: p["x"]), F.transform(poly, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("x1"), F.array_min(ys).alias("y1"), F.array_max(xs).alias("x2"), F.array_max(ys).alias("y2"))


def area(poly: Column) -> Column:
    """Shoelace area; 0 below three corners."""
    n = F.size(poly)
    turn = F.zip_with(poly, F.concat(F.slice(poly, 2, F.greatest(n - 1, F.lit(1))), F.slice(poly, 1, 1)), lambda p, q: p["x"] * q["y"] - q["x"] * p["y"])
    return F.when(n >= 3, F.abs(F.aggregate(turn, F.lit(0.0), lambda a, x: a + x)) / 2).otherwise(0.0)


def centroid(poly: Column) -> Column:
    """The mean of the corners."""
    mean = lambda c: F.aggregate(poly, F.lit(0.0), lambda a, p: a + p[c]) / F.size(poly)
    return point(mean("x"), mean("y"))


def center_distance(x: Column, y: Column, width: Column, height: Column) -> Column:
    """Distance from the picture's centre over half its diagonal."""
    return F.hypot(x - width / 2, y - height / 2) / (F.hypot(width, height) / 2)


def centrality(poly: Column, width: Column, height: Column) -> Column:
    c = centroid(poly)
    return F.greatest(F.lit(0.0), 1 - center_distance(c["x"], c["y"], width, height))


def surface(polys: Column, width: Column, height: Column) -> Column:
    """STRUCT<n_panels, area_px, area_pct, x, y, dist_center> of the panels of one brand in one picture; the centre is weighted by area."""
    weighted = lambda c: F.aggregate(polys, F.lit(0.0), lambda a, p: a + area(p) * centroid(p)[c])
    total = F.aggregate(polys, F.lit(0.0), lambda a, p: a + area(p))
    safe = F.greatest(total, F.lit(1e-9))
    x, y = weighted("x") / safe, weighted("y") / safe
    return F.struct(F.size(polys).alias("n_panels"), total.alias("area_px"), (100 * total / (width * height)).alias("area_pct"), x.alias("x"), y.alias("y"), center_distance(x, y, width, height).alias("dist_center"))


def brand_polygons(boxes_by_frame: Column, own: Column, whole_band: Column, frame: Column) -> Column:
    """STRUCT<polys, area_source>: the frame's own boxes, else the record's polygon, else the whole band, else none."""
    exact = F.filter(F.try_element_at(boxes_by_frame, frame.cast("string")), lambda p: p.isNotNull())
    pick = lambda polys, source: F.struct(polys.alias("polys"), F.lit(source).alias("area_source"))
    empty = F.array().cast("array<array<struct<x:double,y:double>>>")
    return F.when(F.size(exact) > 0, pick(exact, "box")).when(own.isNotNull(), pick(F.array(own), "box")).when(whole_band.isNotNull(), pick(F.array(whole_band), "whole_band")).otherwise(pick(empty, "none"))


def visibility(size: Column, luma_ratio: Column, distance: Column, falloff: float = 2.0) -> Column:
    return size * luma_ratio * F.exp(-falloff * distance * distance)


def luma(r: Column, g: Column, b: Column) -> Column:
    return 0.299 * r + 0.587 * g + 0.114 * b


def relative_brightness(region: Column, frame: Column) -> Column:
    return region / F.greatest(frame, F.lit(1e-6))


def is_sane(poly: Column, width: Column, height: Column, reference_area: Column, max_ratio: float = 4.0) -> Column:
    """Some of it is in the picture, and its area is within max_ratio of the reference either way."""
    b, a = bbox(poly), area(poly)
    inside = (b["x2"] > 0) & (b["y2"] > 0) & (b["x1"] < width) & (b["y1"] < height)
    return inside & (a <= reference_area * max_ratio) & (a >= reference_area / max_ratio)


def boundary_y(x: Column, coef: Column, segments: Column | None = None) -> Column:
    """Where a boundary is at x: on the line of the last of its segments ARRAY<STRUCT<slope, intercept, x_lo, x_hi>> that holds x, else of the last one at all; without segments on the line coef[0] * x + coef[1]."""
    straight = coef[0] * x + coef[1]
    if segments is None:
        return straight
    own = F.filter(segments, lambda s: (x >= s["x_lo"]) & (x < s["x_hi"]))
    piece = F.coalesce(F.try_element_at(own, F.lit(-1)), F.try_element_at(segments, F.lit(-1)))
    return F.when(F.coalesce(F.size(segments), F.lit(0)) > 0, held(piece, lambda p: p["slope"] * x + p["intercept"])).otherwise(straight)


def perspective(y: Column, median_y: Column, clamp: Column) -> Column:
    """Scale of a band's height where its boundary is at y, held within clamp = [low, high]; 1 where the median is no measure."""
    return F.when(median_y > 1, F.greatest(clamp[0], F.least(clamp[1], F.try_divide(y, median_y)))).otherwise(1.0)


def band_outline(coef: Column, span: Column, median_y: Column, clamp: Column, height: Column, step: int = 16, segments: Column | None = None) -> Column:
    """The polygon between a fitted boundary and the band's upper edge, a corner every step columns; with segments the boundary may be bent. Null where a part of it is, or the span is empty."""
    xs = F.concat(F.sequence(span[0], F.greatest(span[0], span[1]), F.lit(step)), F.when((span[1] - span[0]) % step > 0, F.array(span[1])).otherwise(F.array().cast("array<int>")))
    corner = lambda x, y: F.struct(x.cast("double").alias("x"), y.alias("lower"), (y - height * perspective(y, median_y, clamp)).alias("upper"))
    corners = F.transform(xs, lambda x: held(boundary_y(x, coef, segments), lambda y: corner(x, y)))
    outline = lambda cs: F.concat(F.transform(cs, lambda c: point(c["x"], c["upper"])), F.reverse(F.transform(cs, lambda c: point(c["x"], c["lower"]))))
    return held(corners, lambda cs: F.when((span[1] >= span[0]) & ~F.exists(cs, lambda c: c["x"].isNull() | c["lower"].isNull() | c["upper"].isNull()), outline(cs)))


def _band_areas(step: int, lo, hi, slope, intercept, median, low, high, height, segments=None):
    """Areas of bands in Arrow columns: all corners of a batch are on their boundaries at once."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    numbers = lambda c: c.to_numpy(zero_copy_only=False).astype(float)
    nulls = lambda *cs: np.any([c.is_null().to_numpy(zero_copy_only=False) for c in cs], axis=0)
    column = lambda c: numbers(c)[:, None]
    start, end, slopes, offsets, medians, lows, highs, heights = (column(c) for c in (lo, hi, slope, intercept, median, low, high, height))
    if segments is None:
        segments = pa.array([[]] * len(lo), pa.list_(pa.struct([(name, pa.float64()) for name in ("slope", "intercept", "x_lo", "x_hi")])))
    n_own = pc.fill_null(pc.list_value_length(segments), 0).to_numpy(zero_copy_only=False).astype(int)
    first, flat = np.cumsum(n_own) - n_own, segments.flatten()
    parts = [pc.struct_field(flat, [name]) for name in ("slope", "intercept", "x_lo", "x_hi")]
    piece, lost_piece, lost_line = [column(c) for c in parts], nulls(*parts[:2])[:, None], nulls(slope, intercept)[:, None]

    def boundary(x, rows):
        """y at x, and whether it is null."""
        y, lost = slopes[rows] * x + offsets[rows], np.broadcast_to(lost_line[rows], x.shape).copy()
        for turn in range(-1, int(n_own[rows].max(initial=0))):  # the last piece where none holds x, then those that do in order
            own = np.flatnonzero(n_own[rows] > max(turn, 0))
            at = first[rows[own]] + (turn if turn >= 0 else n_own[rows[own]] - 1)
            here = (x[own] >= piece[2][at]) & (x[own] < piece[3][at]) if turn >= 0 else np.ones(x[own].shape, bool)
            y[own] = np.where(here, piece[0][at] * x[own] + piece[1][at], y[own])
            lost[own] = np.where(here, lost_piece[at], lost[own])
        return y, lost

    area, none = np.zeros(len(lo)), nulls(lo, hi, height) | ~(end >= start)[:, 0]
    steps = np.ceil((end - start) / step)[:, 0]
    own = np.flatnonzero(~none)
    with np.errstate(all="ignore"):
        for part in range(0, len(own), BANDS):
            rows, done = own[part : part + BANDS], 0
            while len(rows):
                wide = int(min(CORNERS, max(steps[rows].max() - done, 1)))
                x = np.minimum(start[rows] + step * (done + np.arange(wide + 1)), end[rows])  # beyond the end there is nothing to add
                y, lost = boundary(x, rows)
                none[rows] |= lost.any(axis=1)
                tall = heights[rows] * np.where(medians[rows] > 1, np.fmax(lows[rows], np.fmin(highs[rows], y / medians[rows])), 1.0)
                tall[~np.isfinite(y)] = np.nan
                area[rows] += (np.diff(x) * (tall[:, 1:] + tall[:, :-1])).sum(axis=1) / 2
                done += wide
                rows = rows[steps[rows] > done]
    return pa.array(np.abs(area), pa.float64(), mask=none)


def band_area(coef: Column, span: Column, median_y: Column, clamp: Column, height: Column, step: int = 16, segments: Column | None = None) -> Column:
    """The area of band_outline, without a row's corners as structs; null where there is no outline."""
    from pyspark.sql.types import DoubleType

    areas = F.arrow_udf(lambda *columns: _band_areas(step, *columns), DoubleType(), F.ArrowUDFType.SCALAR)
    numbers = (span[0], span[1], coef[0], coef[1], median_y, clamp[0], clamp[1], height)
    # empty lists in place of nulls: Spark goes through a batch's rows so far for each null list that it writes
    pieces = [] if segments is None else [F.coalesce(segments.cast("array<struct<slope:double,intercept:double,x_lo:double,x_hi:double>>"), F.array())]
    return areas(*(c.cast("double") for c in numbers), *pieces)


def reflow_row(rows: Column, y: Column) -> Column:
    """Of reflowed rows STRUCT<y0, h, w, x_off>, the one whose middle is nearest to y."""
    return F.array_min(F.transform(rows, lambda r: F.struct(F.abs(r["y0"] + r["h"] / 2 - y).alias("d"), r["y0"].alias("y0"), r["h"].alias("h"), r["w"].alias("w"), r["x_off"].alias("x_off"))))


def unfold_box(rows: Column, x1: Column, y1: Column, x2: Column, y2: Column, scale: Column, span0: Column) -> Column:
    """A box on a reflowed strip back on the unfolded band: STRUCT<x1, x2, v1, v2>, v being the share of the band's height.

    A box that fits nothing gives null, not an error: no rows, a row of no height, no scale, or a part that is null or NaN.
    """

    def unfolded(row: Column) -> Column:
        back = lambda x: F.try_divide(F.greatest(F.lit(0.0), F.least(row["w"].cast("double"), x)) + row["x_off"], scale) + span0
        share = lambda y: F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide(y - row["y0"], row["h"])))
        parts = {"x1": back(x1), "x2": back(x2), "v1": share(y1), "v2": share(y2)}
        whole = F.lit(True)
        for part in (*parts.values(), x1, y1, x2, y2, F.try_divide(F.lit(1.0), row["h"])):
            whole = whole & part.isNotNull() & ~F.isnan(part.cast("double"))
        return F.when(whole, F.struct(*(v.alias(k) for k, v in parts.items())))

    return held(reflow_row(rows, (y1 + y2) / 2), unfolded)


def tiles(span0: Column, span1: Column, height: Column, aspect: float = 6.0, overlap: float = 0.30) -> Column:
    """Starts and ends of overlapping tiles along a band: ARRAY<STRUCT<x0, x1>>."""
    width = F.greatest(F.lit(1), F.round(height * aspect).cast("int"))
    step = lambda wide: F.greatest(F.lit(1), F.round(wide * (1 - overlap)).cast("int"))
    return held(width, lambda wide: F.transform(F.sequence(span0, F.greatest(span0, span1 - 1), step(wide)), lambda x: F.struct(x.alias("x0"), F.least(x + wide, span1).alias("x1"))))


def in_polygon(poly: Column, x: Column, y: Column) -> Column:
    """Whether a point lies in a polygon: it has an odd number of edges to its right."""
    n = F.size(poly)
    crossed = F.zip_with(poly, F.concat(F.slice(poly, 2, F.greatest(n - 1, F.lit(1))), F.slice(poly, 1, 1)), lambda p, q: F.when(((p["y"] > y) != (q["y"] > y)) & (x < (q["x"] - p["x"]) * F.try_divide(y - p["y"], q["y"] - p["y"]) + p["x"]), 1).otherwise(0))
    return F.aggregate(crossed, F.lit(0), lambda a, c: a + c) % 2 == 1
