"""Images of a folder, of which only the wanted ones are opened.

``dwellspan_images`` is a data source whose scan takes conditions on names: equal to one, in a list, beginning
with a text. Files that do not fit are never opened, and tasks are planned over those that do. ``contents`` opens the files of a table
of paths, for sets too large for a list.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, StringStartsWith
from pyspark.sql.types import BinaryType, StructField, StructType

from .applog import _local

#: Bytes of files that a task of a scan opens, about.
TASK_BYTES = 64 * 2**20


def _test(one: Filter):
    """Whether a name fits a condition, or None for a condition that the scan does not take."""
    if getattr(one, "attribute", None) != ("name",):
        return None
    if isinstance(one, EqualTo):
        return lambda n: n == one.value
    if isinstance(one, In):
        wanted = set(one.value)
        return wanted.__contains__
    if isinstance(one, StringStartsWith):
        return lambda n: n.startswith(one.value)
    return None


@dataclass
class _Files(InputPartition):
    paths: list[str]


class ImageReader(DataSourceReader):
    def __init__(self, path: str, task_bytes: int) -> None:
        self.path, self.task_bytes, self.tests = path, task_bytes, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        for one in filters:
            test = _test(one)
            if test is None:
                yield one  # Spark applies it
            else:
                self.tests.append(test)

    def partitions(self) -> list[_Files]:
        """Files that fit, a task's worth each."""
        out: list[_Files] = []
        room = 0
        for folder, _, names in sorted(os.walk(self.path)):
            for name in sorted(names):
                if name.startswith((".", "_")) or not all(t(name) for t in self.tests):
                    continue
                size = os.path.getsize(f"{folder}/{name}")
                if not out or room < size:
                    out.append(_Files([]))
                    room = self.task_bytes
                out[-1].paths.append(f"{folder}/{name}")
                room -= size
        return out or [_Files([])]

    def read(self, partition: _Files) -> Iterator[tuple]:
        for path in partition.paths:
            with open(path, "rb") as f:
                content = f.read()
            yield path.rsplit("/", 1)[1], path, len(content), content


class ImageSource(DataSource):
    """Format ``dwellspan_images``: name, path, length and content of the files of a folder and those in it; options path and task_bytes."""

    @classmethod
    def name(cls) -> str:
        return "dwellspan_images"

    def schema(self) -> str:
        return "name string, path string, length bigint, content binary"

    def reader(self, schema: StructType) -> ImageReader:
        return ImageReader(_local(self.options["path"]), int(self.options.get("task_bytes", TASK_BYTES)))


def images(spark: SparkSession, path: str) -> DataFrame:
    """The folder as a table; conditions on name reach its scan."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ImageSource)
    return spark.read.format("dwellspan_images").option("path", path).load()


def contents(files: DataFrame, path: str = "path") -> DataFrame:
    """files with content, read by path in whatever store it names; a file that is gone has null."""
    at = files.columns.index(path)
    schema = StructType([*files.schema.fields, StructField("content", BinaryType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs

        for batch in batches:
            for row in range(batch.num_rows):  # one content at a time
                one = batch.slice(row, 1)
                uri, content = one.column(at)[0].as_py(), None
                if uri is not None:
                    store, inside = fs.FileSystem.from_uri(uri if "://" in uri else f"file://{_local(uri)}")
                    if store.get_file_info(inside).type == fs.FileType.File:
                        with store.open_input_file(inside) as f:
                            content = f.read()
                yield pa.RecordBatch.from_arrays([*one.columns, pa.array([content], pa.binary())], names=[*batch.schema.names, "content"])

    return files.mapInArrow(run, schema)
