"""A log of JSON lines that many writers append to, and a reader that follows growing files.

Appending: each task writes a file of its own into ``data``; the driver makes a write's files visible by one new manifest in
``commits``, which appears whole or not at all. What a failed write, a failed attempt or a speculative copy of a task leaves stands in no manifest, so readers never
see it; ``vacuum`` deletes it. Batches of a stream carry the query's name and their number, and a batch that is
replayed after a failure finds its manifest there and adds nothing.

Following: offsets are bytes of each file up to its last line end, so a line that is half written is left for the next batch and each line is read once.

Both need a folder that the driver and all executors share as a file system.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, DataSourceStreamReader, InputPartition, WriterCommitMessage

#: Bytes of a file that one task reads at most, about.
SPAN = 64 * 2**20


def _local(path: str) -> str:
    if path.startswith("file:"):
        return "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        raise ValueError(f"{path} is no shared file system")
    return path


@dataclass
class _Written(WriterCommitMessage):
    file: str
    rows: int


def _put(path: str, batches: Iterator) -> _Written:
    """A file of the task's lines, complete on disk before it is reported."""
    name = f"{uuid.uuid4().hex}.jsonl"
    os.makedirs(f"{path}/data", exist_ok=True)
    rows = 0
    with open(f"{path}/data/{name}", "wb") as out:
        for batch in batches:
            lines = [x for x in batch.column(0).to_pylist() if x is not None]
            out.writelines(line.encode() + b"\n" for line in lines)
            rows += len(lines)
        out.flush()
        os.fsync(out.fileno())
    return _Written(name, rows)


def _drop(path: str, messages: list[_Written | None]) -> None:
    for m in messages:
        if m is not None and os.path.exists(f"{path}/data/{m.file}"):
            os.remove(f"{path}/data/{m.file}")


def _publish(path: str, messages: list[_Written | None], name: str | None = None, replaces: bool = False, seen: list[str] | None = None) -> bool:
    """Make files visible, with replaces in place of those of the manifests seen (all, if not told); a named manifest that is there already stands, and the files go.

    With seen it is an error if another numbered manifest came meanwhile.
    """
    os.makedirs(f"{path}/commits", exist_ok=True)
    held = [{"file": m.file, "rows": m.rows} for m in messages if m is not None and m.rows]
    draft = f"{path}/commits/.{uuid.uuid4().hex}"
    with open(draft, "w") as out:
        json.dump({"replaces": (manifests(path) if seen is None else seen) if replaces else [], "files": held}, out)
        out.flush()
        os.fsync(out.fileno())
    try:
        number = _next(manifests(path) if seen is None else seen)
        while True:
            target = f"{path}/commits/{name}.json" if name else f"{path}/commits/{number:012d}.json"
            try:
                os.link(draft, target)  # fails where another writer has the name
                return True
            except FileExistsError:
                if name:
                    _drop(path, messages)
                    return False
                if seen is not None:
                    _drop(path, messages)
                    raise ValueError(f"{path} was changed meanwhile; read it and try again") from None
                number += 1
    finally:
        os.remove(draft)


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, replaces: bool, seen: list[str] | None) -> None:
        self.path, self.replaces, self.seen = path, replaces, seen

    def write(self, iterator: Iterator) -> _Written:
        return _put(self.path, iterator)

    def commit(self, messages: list[_Written | None]) -> None:
        _publish(self.path, messages, replaces=self.replaces, seen=self.seen)

    def abort(self, messages: list[_Written | None]) -> None:
        _drop(self.path, messages)


class _StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str, name: str) -> None:
        self.path, self.name = path, name

    def write(self, iterator: Iterator) -> _Written:
        return _put(self.path, iterator)

    def commit(self, messages: list[_Written | None], batchId: int) -> None:  # noqa: N803
        _publish(self.path, messages, f"{self.name}-{batchId:012d}")

    def abort(self, messages: list[_Written | None], batchId: int) -> None:  # noqa: N803
        _drop(self.path, messages)


class LogSource(DataSource):
    """Format ``dwellspan_log``: lines (one string column) into a log; mode overwrite replaces what it holds. Options path, seen (the manifests that it replaces, as JSON), and query for streams."""

    @classmethod
    def name(cls) -> str:
        return "dwellspan_log"

    def schema(self) -> str:
        return "value string"

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(_local(self.options["path"]), overwrite, json.loads(self.options.get("seen", "null")))

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> DataSourceStreamArrowWriter:  # noqa: N802
        return _StreamWriter(_local(self.options["path"]), self.options["query"])


def _whole(path: str) -> int:
    """Bytes of a file up to its last line end."""
    with open(path, "rb") as f:
        at = f.seek(0, os.SEEK_END)
        while at > 0:
            start = max(0, at - 65536)
            f.seek(start)
            found = f.read(at - start).rfind(b"\n")
            if found >= 0:
                return start + found + 1
            at = start
    return 0


@dataclass
class _Span(InputPartition):
    file: str
    start: int
    end: int


class _Tail(DataSourceStreamReader):
    def __init__(self, path: str, suffix: str, span: int) -> None:
        self.path, self.suffix, self.span = path, suffix, span

    def initialOffset(self) -> dict:  # noqa: N802
        return {}

    def latestOffset(self) -> dict:  # noqa: N802
        names = sorted(n for n in os.listdir(self.path) if n.endswith(self.suffix) and not n.startswith((".", "_"))) if os.path.isdir(self.path) else []
        return {n: _whole(f"{self.path}/{n}") for n in names}

    def partitions(self, start: dict, end: dict) -> list[_Span]:
        out = []
        for name, upto in end.items():
            at = start.get(name, 0)
            if upto < at:
                raise ValueError(f"{name} has become shorter than what was read of it")
            out += [_Span(name, k, min(k + self.span, upto)) for k in range(at, upto, self.span)]
        return out or [_Span("", 0, 0)]

    def read(self, partition: _Span) -> Iterator:
        """Lines that begin within the span; the one at its end is read to its end."""
        import pyarrow as pa

        if not partition.file:
            return
        with open(f"{self.path}/{partition.file}", "rb") as f:
            at = partition.start
            if at:  # a line that began before belongs to the span before
                f.seek(at - 1)
                at += len(f.readline()) - 1
            lines: list[str] = []
            while at < partition.end:
                line = f.readline()
                at += len(line)
                if line.strip():
                    lines.append(line.rstrip(b"\r\n").decode("utf-8", "replace"))
                if len(lines) >= 4096:
                    yield pa.RecordBatch.from_arrays([pa.array([partition.file] * len(lines)), pa.array(lines)], ["file", "value"])
                    lines = []
            if lines:
                yield pa.RecordBatch.from_arrays([pa.array([partition.file] * len(lines)), pa.array(lines)], ["file", "value"])


class TailSource(DataSource):
    """Format ``dwellspan_tail``: whole lines of the files of a folder as they grow; options path, suffix (.jsonl) and span."""

    @classmethod
    def name(cls) -> str:
        return "dwellspan_tail"

    def schema(self) -> str:
        return "file string, value string"

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:  # noqa: N802
        return _Tail(_local(self.options["path"]), self.options.get("suffix", ".jsonl"), int(self.options.get("span", SPAN)))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(LogSource)
    spark.dataSource.register(TailSource)


def append(df: DataFrame, path: str) -> None:
    """Append the rows of df, all or none of them."""
    register(df.sparkSession)
    df.select(F.to_json(F.struct("*")).alias("value")).write.format("dwellspan_log").option("path", path).mode("append").save()


def append_stream(stream: DataFrame, path: str, query: str, checkpoint: str):
    """A stream writer whose batches are appended once each; the name of the query and its checkpoint belong together."""
    register(stream.sparkSession)
    lines = stream.select(F.to_json(F.struct("*")).alias("value"))
    return lines.writeStream.format("dwellspan_log").option("path", path).option("query", query).option("checkpointLocation", checkpoint)


def manifests(path: str) -> list[str]:
    folder = f"{_local(path)}/commits"
    return sorted(n for n in os.listdir(folder) if not n.startswith(".")) if os.path.isdir(folder) else []


def _next(names: list[str]) -> int:
    """The number behind all numbered manifests."""
    return max((int(n.split(".")[0]) + 1 for n in names if n.split(".")[0].isdigit()), default=0)


def committed(path: str) -> list[str]:
    """The files that readers see."""
    path, held = _local(path), {}
    for name in manifests(path):
        with open(f"{path}/commits/{name}") as f:
            held[name] = json.load(f)
    gone = {n for found in held.values() for n in found["replaces"]}
    return [f"{path}/data/{x['file']}" for name, found in held.items() if name not in gone for x in found["files"]]


def upsert(new: DataFrame, path: str, keys: tuple[str, ...], schema: T.StructType | str) -> None:
    """Put rows in place of those of the same keys, keeping their created (``files.upserted``): readers see all of it or nothing, and a writer that comes between makes this one fail."""
    from .files import upserted

    spark, seen = new.sparkSession, json.dumps(manifests(path))
    register(spark)
    whole = upserted(read(spark, path, schema), new, keys)
    whole.select(F.to_json(F.struct("*")).alias("value")).write.format("dwellspan_log").option("path", path).option("seen", seen).mode("overwrite").save()


def read(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The rows of a log as it stands now."""
    files = committed(path)
    return spark.read.schema(schema).json([f"file://{f}" for f in files]) if files else spark.createDataFrame([], schema)


def tail(spark: SparkSession, path: str, schema: T.StructType | str, suffix: str = ".jsonl", span: int = SPAN) -> DataFrame:
    """A stream of file and the columns of schema of each whole line; a line that is no JSON has nulls."""
    register(spark)
    live = spark.readStream.format("dwellspan_tail").option("path", path).option("suffix", suffix).option("span", span).load()
    return live.select("file", F.from_json("value", schema).alias("row")).select("file", "row.*")


def vacuum(path: str, older_s: float = 86_400) -> int:
    """Delete files that stand in no manifest and are older than the longest write; how many."""
    path, n = _local(path), 0
    seen, now = {f.rsplit("/", 1)[1] for f in committed(path)}, time.time()
    for name in os.listdir(f"{path}/data") if os.path.isdir(f"{path}/data") else []:
        if name not in seen and now - os.path.getmtime(f"{path}/data/{name}") >= older_s:
            os.remove(f"{path}/data/{name}")
            n += 1
    return n
