"""What the operators of this subpackage share: word rules, tables and the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space of the word rule: space and \x09-\x0D. It is what ``bytes.split()`` splits at.
SPACE_CLASS = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE_CLASS}]+"
#: Where sessions without spark.checkpoint.dir (tests, notebooks) keep intermediate tables.
LOCAL_CHECKPOINTS = "/tmp/checkpoints/dwellspan"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = LOCAL_CHECKPOINTS
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def own_dir(spark: SparkSession) -> str:
    """Where this application keeps its intermediate tables."""
    return f"{shared_dir(spark)}/dwellspan-{spark.sparkContext.applicationId}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back; this cuts the lineage and survives lost executors.

    The tables stay until ``drop_written``, as results that are not yet computed may read them.
    """
    return written_at(df, label)[0]


def written_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """As ``written``, with the table's path, which ``drop_path`` takes."""
    path = f"{own_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_path(spark: SparkSession, path: str) -> None:
    held = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    held.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(held, True)


def drop_written(spark: SparkSession) -> None:
    """Delete all tables that this application has written; call it when its results are stored."""
    drop_path(spark, own_dir(spark))


#: Most rows and bytes of an Arrow batch that goes to Python; the session's own settings hold where they are smaller.
BATCH_ROWS, BATCH_BYTES = 2048, 16 * 2**20


def _small_batches(spark: SparkSession) -> None:
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        now = str(spark.conf.get(key)).removesuffix("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def map_batches(df: DataFrame, run: Callable[[Iterator], Iterator], schema: str | T.StructType) -> DataFrame:
    """df.mapInArrow in batches of bounded size; a worker gives its memory back when a task is done."""

    def bounded(batches: Iterator) -> Iterator:
        import ctypes
        import gc

        import pyarrow as pa

        try:
            yield from run(batches)
        finally:
            gc.enable()
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):
                pass  # another C library

    _small_batches(df.sparkSession)
    return df.mapInArrow(bounded, schema)


#: Bits of a key filter: about so many a key, within these bounds; with far more keys it lets more others through.
FILTER_BITS, MIN_FILTER_BITS, MAX_FILTER_BITS, FILTER_SLICES = 16, 2**16, 2**26, 64


def key_filter(hashes: DataFrame) -> bytes:
    """A Bloom filter of 64-bit hashes, the one column of hashes: at most MAX_FILTER_BITS / 8 bytes."""
    import zlib

    bits, n = MIN_FILTER_BITS, hashes.count()
    while bits < MAX_FILTER_BITS and bits < FILTER_BITS * n:
        bits *= 2

    def build(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        held, any_row = np.zeros(bits, bool), False
        for batch in batches:
            k = batch.column(0).to_numpy().view(np.uint64)
            any_row |= len(k) > 0
            for at in (k, k >> np.uint64(32)):
                held[(at & np.uint64(bits - 1)).astype(np.int64)] = True
        if any_row:
            for part, own in enumerate(np.split(np.packbits(held), FILTER_SLICES)):
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([zlib.compress(own.tobytes(), 1)], pa.binary())], ["part", "bits"])

    def meet(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        met: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = np.frombuffer(zlib.decompress(raw), np.uint8)
                met[part] = met[part] | own if part in met else own
        for part, own in met.items():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([own.tobytes()], pa.binary())], ["part", "bits"])

    parts = map_batches(hashes, build, "part int, bits binary").repartition(FILTER_SLICES, "part")
    found = {r.part: bytes(r.bits) for r in map_batches(parts, meet, "part int, bits binary").collect()}
    return b"".join(found.get(k, bytes(bits // 8 // FILTER_SLICES)) for k in range(FILTER_SLICES))


def may_hold(filter_: bytes, hashes):
    """Whether a key filter may hold each of some hashes (a NumPy array); it never misses one that it holds."""
    import numpy as np

    held, mask, out = np.frombuffer(filter_, np.uint8), np.uint64(8 * len(filter_) - 1), True
    for at in (hashes.view(np.uint64), hashes.view(np.uint64) >> np.uint64(32)):
        at = (at & mask).astype(np.int64)
        out = out & (held[at >> 3] >> (7 - (at & 7)) & 1).astype(bool)
    return out


def n_words(text: Column) -> Column:
    """Words of a text as a long; null counts none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
