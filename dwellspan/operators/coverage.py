"""The coverage ledger: every moment has a status, and the observation that gives it."""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import intervals

#: Evidence from the strongest to the weakest.
PRIORITY = ("human", "auto", "scan", "tracked", "scan_blank")


def around(at: Column, half: Column | int) -> tuple[Column, Column]:
    """The interval that an observation in the middle of a window stands for."""
    return at - half, at + half


def observations(*sources: DataFrame) -> DataFrame:
    """Sources of (keys, start_us, end_us, status, source, conf, shot) as one relation."""
    out = sources[0]
    for s in sources[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out


def ledger(obs: DataFrame, keys: Sequence[str], lo: int, hi: int, priority: Sequence[str] = PRIORITY, grid: int | None = None, bucket: int = intervals.DAY) -> DataFrame:
    """keys, start_us, end_us, status."""
    if grid:
        obs = obs.withColumns({c: intervals.snap(F.col(c), grid) for c in ("start_us", "end_us")})
    return intervals.ledger(obs, keys, priority, lo, hi, bucket)


def _swept(rows: Iterator[tuple[int, int, int | None, dict | None]]) -> Iterator[tuple[int, int, dict | None]]:
    """Pieces (start, end, payload) of cells from rows (start, end, place, payload) of one class by start: n log n for n rows. The open observation of the least place is the best one; cells have no place.

    Cells don't overlap. Time moves to each row's start; between two starts the best open observation holds.
    """
    heap: list[tuple[int, int, dict]] = []
    cell: list[int] | None = None  # what is left of the cell
    now = None

    def until(stop: float) -> Iterator[tuple[int, int, dict | None]]:
        nonlocal now, cell
        while now is not None and now < stop:
            while heap and heap[0][1] <= now:
                heapq.heappop(heap)
            if cell is not None and cell[1] <= now:
                cell = None
            if cell is None and not heap:
                now = None if stop == math.inf else stop
                return
            ends = [stop] + ([heap[0][1]] if heap else []) + ([cell[1]] if cell else [])
            upto = min(ends)
            if upto == math.inf:
                return
            if cell is not None:
                yield max(now, cell[0]), int(upto), heap[0][2] if heap else None
            now = upto

    for start, end, place, value in rows:
        if now is None or now < start:
            yield from until(start)
        now = start
        if place is None:
            cell = [start, end]
        else:
            heapq.heappush(heap, (place, end, value))
    yield from until(math.inf)


def with_payload(cells: DataFrame, obs: DataFrame, keys: Sequence[str], payload: Sequence[str], order: str, bucket: int = intervals.DAY) -> DataFrame:
    """Ledger cells cut where the winning observation changes, with its payload: of the cell's class, the one of the highest order.

    Cells and observations of one class and bucket go through one sorted pass with a heap of open observations, so
    none meets all others. Where no observation of the class is open the payload is null.
    """
    span = F.struct(order, *payload)
    own = intervals.spread(obs.select(*keys, "status", "start_us", "end_us", span.alias("p")), bucket)
    cut = intervals.spread(cells.select(*keys, "status", "start_us", "end_us"), bucket)
    group = [*keys, "status", "bucket"]
    # observations are ranked by Spark, larger first and nulls last, so that the sweep compares numbers only
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*(F.desc_nulls_last(f"p.{c}") for c in (order, *payload))))
    rows = own.select(*group, "start_us", "end_us", place.alias("place"), "p").union(cut.select(*group, "start_us", "end_us", F.lit(None).cast("int").alias("place"), F.lit(None).cast(own.schema["p"].dataType).alias("p")))
    schema = rows.select(*group, "start_us", "end_us", "p").schema
    n = len(group)

    def sweep(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)

        def stream() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        out: list[list] = [[] for _ in schema]
        for key, run in itertools.groupby(stream(), key=lambda r: r[:n]):
            last = None
            for start, end, value in _swept(r[n:] for r in run):
                if last is not None and last[1] == start and last[2] == value:
                    last[1] = end
                    out[n + 1][-1] = end
                    continue
                last = [start, end, value]
                for column, x in zip(out, (*key, start, end, value), strict=True):
                    column.append(x)
            if len(out[0]) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, arrow, strict=True)], schema=arrow)
                out = [[] for _ in schema]
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, arrow, strict=True)], schema=arrow)

    pieces = rows.repartition(*group).sortWithinPartitions(*group, "start_us", F.asc_nulls_last("place")).mapInArrow(sweep, schema)
    whole = intervals.join_across(pieces, keys, ["status", "p"], bucket)
    return whole.select(*keys, "start_us", "end_us", "status", F.col(f"p.{order}").alias(order), *(F.col(f"p.{c}").alias(c) for c in payload))


def by_status(cells: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """keys, status, total_us, n_spans."""
    return cells.groupBy(*keys, "status").agg(F.sum(F.col("end_us") - F.col("start_us")).alias("total_us"), F.count("*").alias("n_spans"))


def covered(cells: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """keys, covered_us, looked_us, total_us: seen evidence, time looked at (blank included), all time."""
    dur = F.col("end_us") - F.col("start_us")
    seen = ~F.col("status").isin("uncovered", "scan_blank")
    return cells.groupBy(*keys).agg(F.sum(F.when(seen, dur).otherwise(0)).alias("covered_us"), F.sum(F.when(F.col("status") != "uncovered", dur).otherwise(0)).alias("looked_us"), F.sum(dur).alias("total_us"))


def named_or_unread(cells: DataFrame, unread: DataFrame, keys: Sequence[str]) -> DataFrame:
    """cells with advertiser: unread where an unread state holds the middle of an auto cell, else named; null for other cells."""
    merged = intervals.merged(unread, keys)
    from .joins import asof

    mid = cells.withColumn("mid_us", F.floor((F.col("start_us") + F.col("end_us")) / 2))
    found = asof(mid, merged.withColumnRenamed("start_us", "u_start").withColumnRenamed("end_us", "u_end"), keys, "mid_us", "u_start", ["u_end"], bucket=intervals.DAY)
    inside = F.coalesce(F.col("mid_us") <= F.col("u_end"), F.lit(False))
    return found.withColumn("advertiser", F.when(F.col("status") == "auto", F.when(inside, "unread").otherwise("named"))).select(*cells.columns, "advertiser")
