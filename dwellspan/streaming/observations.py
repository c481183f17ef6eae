"""Structured Streaming forms of exposure counts, spells, interval unions, logs and late rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def timed(stream: DataFrame, at: str, delay: str) -> DataFrame:
    """The stream with a watermark; times without a zone become UTC timestamps."""
    return stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay)


def window_counts(stream: DataFrame, keys: Sequence[str], at: str, length: str, slide: str | None = None) -> DataFrame:
    """keys, start, end, n: rows in tumbling or sliding windows."""
    w = F.window(at, length, slide) if slide else F.window(at, length)
    return stream.groupBy(*keys, w).agg(F.count("*").alias("n")).select(*keys, "window.start", "window.end", "n")


def session_spells(stream: DataFrame, keys: Sequence[str], at: str, gap: str) -> DataFrame:
    """keys, start, end, n: spells that a gap closes."""
    out = stream.groupBy(*keys, F.session_window(at, gap)).agg(F.count("*").alias("n"))
    return out.select(*keys, "session_window.start", "session_window.end", "n")


def running_union(stream: DataFrame, key: str, start: str = "start_us", end: str = "end_us", at: str = "ts") -> DataFrame:
    """key, union_us, open_start_us, open_end_us after each batch: the measure of closed islands and the islands still open.

    Rows may come out of order within the watermark: islands stay open until the watermark has passed
    their end, so what a late row joins is still there. A key whose islands are all closed gives its list of islands
    up when the watermark passes the last end; its sum of closed ones, two numbers, stays, as later rows add to it.
    """

    def update(k: tuple, batches: Iterator, state: GroupState) -> Iterator:
        import pandas as pd

        closed, islands = state.get if state.exists else (0, [])
        spans = [tuple(x) for x in islands]
        for pdf in batches:
            spans += list(zip(pdf[start].tolist(), pdf[end].tolist(), strict=True))
        merged: list[list[int]] = []
        if state.hasTimedOut and not spans:
            return
        for lo, hi in sorted(x for x in spans if x[1] > x[0]):
            if merged and lo <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], hi)
            else:
                merged.append([lo, hi])
        mark = state.getCurrentWatermarkMs() * 1000
        done = [m for m in merged if m[1] < mark]
        merged = [m for m in merged if m[1] >= mark]
        closed += sum(hi - lo for lo, hi in done)
        state.update((closed, merged))
        if merged:  # come back when the watermark closes them, with or without new rows
            state.setTimeoutTimestamp(max(m[1] for m in merged) // 1000 + 1 if max(m[1] for m in merged) // 1000 + 1 > state.getCurrentWatermarkMs() else state.getCurrentWatermarkMs() + 1)
        total = closed + sum(hi - lo for lo, hi in merged)
        yield pd.DataFrame({key: [k[0]], "union_us": [total], "open_islands": [len(merged)]})

    kind = stream.schema[key].dataType.simpleString()
    return stream.groupBy(key).applyInPandasWithState(update, f"{key} {kind}, union_us long, open_islands long", "closed long, islands array<array<long>>", "update", GroupStateTimeout.EventTimeTimeout)


def keep_last(path: str, keys: Sequence[str], seq: str):
    """A foreachBatch function that appends batches to a log; read it with sequences.last_wins. Batches that are replayed after a failure are written once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{path}/b{batch_id:09d}")

    return write


def read_log(spark, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/b*")


def _earlier(spark, path: str, batch_id: int) -> list:
    """Folders of batches before this one, the last one first."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(folder):
        return []
    found = [f.getPath() for f in store.listStatus(folder) if f.getPath().getName()[1:].isdigit() and int(f.getPath().getName()[1:]) < batch_id]
    return sorted(found, key=lambda p: p.getName(), reverse=True)


def split_late(path: str, late_path: str, at: str, delay_s: int):
    """A foreachBatch function that puts rows behind the largest time so far minus delay_s into a table of their own, so that none is lost silently.

    Each batch leaves the largest time up to its end beside its rows, so a restarted query, or a batch that is replayed, is split as it was at first; it
    reads the mark of the batch before only, and older ones go.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, marks = batch.sparkSession, f"{late_path}_marks"
        batch = batch.persist()
        try:
            before = _earlier(spark, marks, batch_id)
            seen = spark.read.schema("mark long").parquet(before[0].toString()).first() if before else None
            seen = seen and seen.mark
            times = F.unix_seconds(F.col(at).cast("timestamp"))
            late = F.lit(False) if seen is None else F.coalesce(times < seen - delay_s, F.lit(False))
            batch.filter(~late).write.mode("overwrite").parquet(f"{path}/b{batch_id:09d}")
            batch.filter(late).write.mode("overwrite").parquet(f"{late_path}/b{batch_id:09d}")
            batch.agg(F.greatest(F.max(times), F.lit(seen).cast("long")).alias("mark")).write.mode("overwrite").parquet(f"{marks}/b{batch_id:09d}")
            for old in before[1:]:
                old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)
        finally:
            batch.unpersist()

    return write
