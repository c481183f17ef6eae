"""Order-dependent operators on streams: cuts, skipped near-duplicates, leader clusters and spells.

Rows may come in any order within the watermark. Each key keeps its rows in a list until the watermark has passed them, then they are taken in order of
time, so the results are those of the batch operators (``sequences.spaced_cuts``, ``sequences.skip_similar``, ``clusters.leader_clusters``,
``intervals.stitch``) however rows were shuffled; rows behind the watermark are dropped by Spark. What a key must remember
beyond that is one value (a cut, a kept vector, an open spell) or a map (representatives by cluster). A timer at the
first waiting row brings a key back when the watermark has passed it, and one at the end of a memory's use lets it go.

The state store must be RocksDB: set ``spark.sql.streaming.stateStore.providerClass`` as ``use_rocksdb`` does.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


class _Machine:
    """What a key remembers, and what a row makes of it. A row is (time in microseconds, tie, value)."""

    result = "boolean"

    def open(self, handle: StatefulProcessorHandle) -> None: ...

    def take(self, rows: list[tuple]) -> Iterator[tuple[tuple, Any]]:
        """(row, result) of rows in order."""
        raise NotImplementedError

    def until(self) -> int | None:
        """When the memory ends if no row comes, in microseconds."""
        return None

    def end(self, mark: int) -> Iterator[tuple[tuple, Any]]:
        """The memory ends, as the watermark has passed ``until``."""
        return iter(())


class _Cuts(_Machine):
    def __init__(self, min_gap: int) -> None:
        self.min_gap = min_gap

    def open(self, handle):
        self.last = handle.getValueState("last_cut", "at bigint")

    def take(self, rows):
        last = self.last.get()[0] if self.last.exists() else None
        for row in rows:
            cut = row[2] is not None and row[2] > 1 and (last is None or row[0] >= last + self.min_gap)
            if cut:
                last = row[0]
                self.last.update((last,))
            yield row, cut

    def until(self):
        return self.last.get()[0] + self.min_gap if self.last.exists() else None

    def end(self, mark):
        self.last.clear()  # whatever comes is far enough
        return iter(())


class _Kept(_Machine):
    def __init__(self, min_distance: float, forget_after: int | None) -> None:
        self.min_distance, self.forget_after = min_distance, forget_after

    def open(self, handle):
        self.last = handle.getValueState("last_kept", "at bigint, vector array<double>")

    def take(self, rows):
        last = self.last.get() if self.last.exists() else None
        for row in rows:
            v = row[2]
            whole = v is not None and len(v) > 0 and all(x is not None and x == x for x in v) and (last is None or len(last[1]) == len(v))
            late = last is not None and self.forget_after is not None and row[0] > last[0] + self.forget_after
            keep = whole and (last is None or late or not sum(abs(a - b) for a, b in zip(v, last[1], strict=True)) / len(v) < self.min_distance)
            if keep:
                last = (row[0], [float(x) for x in v])
                self.last.update(last)
            yield row, keep

    def until(self):
        return self.last.get()[0] + self.forget_after if self.forget_after is not None and self.last.exists() else None

    def end(self, mark):
        self.last.clear()
        return iter(())


class _Leaders(_Machine):
    result = "int"

    def __init__(self, threshold: float) -> None:
        self.threshold = threshold

    def open(self, handle):
        self.reps = handle.getMapState("representatives", "cluster int", "vector array<double>, conf double")

    def take(self, rows):
        import numpy as np

        held = {k[0]: v for k, v in self.reps.iterator()}
        vectors = np.array([held[k][0] for k in range(len(held))])
        confs = [held[k][1] for k in range(len(held))]
        changed = set()
        for row in rows:
            v, conf = row[2]
            if v is None or not len(v) or any(x is None or x != x for x in v) or (len(confs) and len(v) != vectors.shape[1]):
                yield row, None
                continue
            own, conf = np.array(v, float), float("-inf") if conf is None or conf != conf else float(conf)
            off = np.abs(vectors - own).sum(axis=1) / 2 if confs else np.zeros(0)
            k = int(off.argmin()) if confs else 0
            if confs and off[k] < self.threshold:
                if conf > confs[k]:
                    vectors[k], confs[k] = own, conf
                    changed.add(k)
            else:
                k = len(confs)
                vectors = np.vstack([vectors, own]) if confs else own[None, :]
                confs.append(conf)
                changed.add(k)
            yield row, k
        for k in changed:
            self.reps.updateValue((k,), (vectors[k].tolist(), confs[k]))


class _Spells(_Machine):
    result = "struct<first_us: bigint, last_us: bigint, n_points: bigint>"

    def __init__(self, max_gap: int) -> None:
        self.max_gap = max_gap

    def open(self, handle):
        self.spell = handle.getValueState("spell", "first_us bigint, last_us bigint, n_points bigint")

    def take(self, rows):
        held = tuple(self.spell.get()) if self.spell.exists() else None
        for row in rows:
            if held is not None and row[0] - held[1] > self.max_gap:
                yield row, held
                held = None
            held = (held[0], row[0], held[2] + 1) if held else (row[0], row[0], 1)
        if held is not None:
            self.spell.update(held)

    def until(self):
        return self.spell.get()[1] + self.max_gap if self.spell.exists() else None

    def end(self, mark):
        held = tuple(self.spell.get())
        self.spell.clear()
        yield (held[1], None, None), held


class _InOrder(StatefulProcessor):
    """Hands a key's rows to its machine in order, once the watermark has passed them. Rows are (key columns, at_us, tie, value)."""

    def __init__(self, machine: _Machine, value: str, tie: str, names: list[str]) -> None:
        self.machine, self.names = machine, names
        self.waits = f"at_us bigint, tie {tie}, value {value}"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.waits)
        self.machine.open(handle)

    def _come_back(self, at_us: int | None, mark_ms: int) -> None:
        """A timer fires when the watermark is at or beyond it."""
        if at_us is not None:
            self.handle.registerTimer(max(at_us // 1000 + 1, mark_ms + 1))

    def _shown(self, key: tuple, found: Iterator[tuple[tuple, Any]]) -> Iterator:
        import pandas as pd

        rows = [(*key, at, tie, result) for (at, tie, _), result in found]
        if rows:
            out = pd.DataFrame(rows, columns=self.names)
            yield out.astype({self.names[-1]: object}) if out[self.names[-1]].isna().any() else out

    def handleInputRows(self, key: tuple, rows: Iterator, timerValues) -> Iterator:  # noqa: N802, N803
        new = []
        for pdf in rows:
            new += [(int(at), tie, self._plain(v)) for at, tie, v in zip(pdf["at_us"].tolist(), pdf["tie"].tolist(), pdf["value"].tolist(), strict=True)]
        if new:
            self.waiting.appendList(new)
            self._come_back(min(r[0] for r in new), timerValues.getCurrentWatermarkInMs())
        return iter(())

    @staticmethod
    def _plain(v):
        """Structs as plain tuples and arrays as lists, which the state store takes."""
        if isinstance(v, (dict, tuple)):
            return tuple(_InOrder._plain(x) for x in (v.values() if isinstance(v, dict) else v))
        return v.tolist() if hasattr(v, "tolist") else v

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator:  # noqa: N802, N803
        mark = timerValues.getCurrentWatermarkInMs()
        rows = [self._plain(r) for r in self.waiting.get()] if self.waiting.exists() else []
        ready = sorted((r for r in rows if r[0] < mark * 1000), key=lambda r: (r[0], r[1]))
        left = [r for r in rows if r[0] >= mark * 1000]
        if ready:
            yield from self._shown(key, self.machine.take(ready))
            if left:
                self.waiting.put(left)
            else:
                self.waiting.clear()
        until = self.machine.until()
        if until is not None and until < mark * 1000:
            yield from self._shown(key, self.machine.end(mark * 1000))
            until = None
        if ready or until is None:
            self._come_back(min((r[0] for r in left), default=None), mark)
            self._come_back(until, mark)

    def close(self) -> None: ...


def _run(stream: DataFrame, keys: Sequence[str], at: str, tie: str, value, machine: _Machine, name: str) -> DataFrame:
    """keys, at_us, tie and the machine's result for rows of a stream that has a watermark on ``at``."""
    at_us = F.unix_micros(at)
    own = stream.select(*keys, at, at_us.alias("at_us"), (at_us if tie == "at_us" else F.col(tie)).alias("tie"), value.alias("value"))
    fields = {f.name: f.dataType.simpleString() for f in own.schema}
    tie = "tie" if tie == "at_us" else tie
    names = [*keys, "at_us", tie, name]
    schema = ", ".join([*(f"`{k}` {fields[k]}" for k in keys), "at_us bigint", f"`{tie}` {fields['tie']}", f"`{name}` {machine.result}"])
    return own.groupBy(*keys).transformWithStateInPandas(_InOrder(machine, fields["value"], fields["tie"], names), schema, "append", "eventTime")


def spaced_cuts(stream: DataFrame, keys: Sequence[str], at: str, tie: str, severity: str, min_gap_us: int, name: str = "cut") -> DataFrame:
    """keys, at_us, tie, cut: severity over 1 and at least min_gap_us since the last accepted cut. The memory of a cut ends after that gap."""
    return _run(stream, keys, at, tie, F.col(severity).cast("double"), _Cuts(min_gap_us), name)


def skip_similar(stream: DataFrame, keys: Sequence[str], at: str, tie: str, vector: str, min_distance: float, forget_after_us: int | None = None, name: str = "keep") -> DataFrame:
    """keys, at_us, tie, keep: whether a row differs by at least min_distance (mean absolute difference) from the last one kept.

    With forget_after_us that one is forgotten so long after its own time, and the next row is kept. Broken vectors are not kept.
    """
    return _run(stream, keys, at, tie, F.col(vector).cast("array<double>"), _Kept(min_distance, forget_after_us), name)


def leader_clusters(stream: DataFrame, keys: Sequence[str], at: str, tie: str, vector: str, conf: str, threshold: float = 0.30, name: str = "cluster") -> DataFrame:
    """keys, at_us, tie, cluster, as ``clusters.leader_clusters`` numbers them; representatives stay as long as the query."""
    return _run(stream, keys, at, tie, F.struct(F.col(vector).cast("array<double>").alias("vector"), F.col(conf).cast("double").alias("conf")), _Leaders(threshold), name)


def spells(stream: DataFrame, keys: Sequence[str], at: str, max_gap_us: int) -> DataFrame:
    """keys, first_us, last_us, n_points of runs of points at most max_gap_us apart, each when the watermark has passed its last point by that gap."""
    out = _run(stream, keys, at, "at_us", F.lit(None).cast("int"), _Spells(max_gap_us), "spell")
    return out.select(*keys, "spell.first_us", "spell.last_us", "spell.n_points")
