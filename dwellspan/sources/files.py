"""Files of a run: JSON lines, JSON documents, CSV, images; and how they are written."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import truthy

BAD_ROW = "_bad_row"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in any store that Spark reads."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def json_lines(spark: SparkSession, path: str, schema: T.StructType, keep_bad: bool = False) -> DataFrame:
    """JSON lines; blank lines and half-written ones are left out, or with keep_bad kept in BAD_ROW. A missing file is an empty table."""
    if not exists(spark, path):
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(BAD_ROW, T.StringType())]) if keep_bad else schema)
    if not keep_bad:
        return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    wide = T.StructType([*schema.fields, T.StructField(BAD_ROW, T.StringType())])
    return spark.read.schema(wide).option("columnNameOfCorruptRecord", BAD_ROW).json(path)


def json_document(spark: SparkSession, path: str, entry: T.StructType, key: str) -> DataFrame:
    """Entries of a JSON document that is a list of names or objects, or an object that holds the list under key; entries with keys that begin with _ are comments."""
    text = spark.read.text(path, wholetext=True)
    held = F.coalesce(F.get_json_object("value", f"$.{key}"), F.col("value"))
    items = text.select(F.explode(F.from_json(held, "array<string>")).alias("item"))
    as_object = F.from_json("item", entry)
    first = entry.fields[0].name
    plain = ~F.col("item").startswith("{")
    named = items.filter(plain | ~F.coalesce(F.exists(F.json_object_keys("item"), lambda k: k.startswith("_")), F.lit(False)))
    return named.select(as_object.alias("e"), "item", plain.alias("plain")).select(
        *(F.when(F.col("plain") & F.lit(f.name == first), F.col("item").cast(f.dataType) if f.name == first else F.lit(None).cast(f.dataType)).otherwise(F.col("e")[f.name]).alias(f.name) for f in entry.fields)
    )


def json_map(spark: SparkSession, path: str, value: str = "array<string>") -> DataFrame:
    """key, value of a JSON object; keys that begin with _ are comments."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", f"map<string,{value}>"))).filter(~F.col("key").startswith("_"))


def csv(spark: SparkSession, path: str, schema: T.StructType, flags: tuple[str, ...] = ()) -> DataFrame:
    """CSV with a header and perhaps a byte-order mark; what does not parse as its type is null, flags are read as text booleans."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    raw = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    raw = raw.toDF(*(c.lstrip("﻿") for c in raw.columns))
    value = lambda f: truthy(F.col(f"`{f.name}`")) if f.name in flags else F.col(f"`{f.name}`").try_cast(f.dataType)
    return raw.select(*((value(f) if f.name in raw.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields))


def image_gallery(spark: SparkSession, path: str) -> DataFrame:
    """name, position (from 0), path of image files NAME__2.png by NAME; a row for each file, contents not read (``images.contents`` reads them)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "")
    return files.select(F.split(stem, "__")[0].alias("name"), "path").withColumn("position", F.row_number().over(Window.partitionBy("name").orderBy("path")) - 1).select("name", "position", "path")


def image_metadata(spark: SparkSession, images: str, metadata: str, schema: T.StructType, file: str = "file") -> DataFrame:
    """Image files (path, length, content) with their metadata rows by file name; only files that have such rows are opened."""
    from .images import contents

    rows = json_lines(spark, metadata, schema)
    files = spark.read.format("binaryFile").load(images).select("path", "length", F.element_at(F.split("path", "/"), -1).alias(file))
    wanted = files.join(rows.select(file).distinct(), file, "left_semi")
    return contents(wanted.select(file, "length", "path")).join(rows, file)


def strided(frames: DataFrame, frame: str, fps: float, rate: float) -> DataFrame:
    """Every step-th frame, step being what gives about rate frames a second."""
    step = max(1, round(fps / max(rate, 0.01)))
    return frames.filter(F.pmod(F.col(frame), F.lit(step)) == 0)


def manifest(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The one JSON document of a run, over as many lines as it likes; a missing file is an empty table."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", True).json(path)


def first_config(spark: SparkSession, *paths: str | None) -> str:
    """The first of some places where a configuration may lie; an error names them all if none is there."""
    for path in paths:
        if path and exists(spark, path):
            return path
    raise FileNotFoundError(f"no configuration at any of {', '.join(p for p in paths if p) or 'no place'}")


def video_info(manifest: DataFrame) -> DataFrame:
    """run, fps, frames, width, height, duration_s; an unknown rate is 25."""
    fps = F.coalesce(F.nullif(F.col("video.fps"), F.lit(0.0)), F.lit(25.0))
    return manifest.select("run", fps.alias("fps"), "video.frames", "video.width", "video.height", (F.col("video.frames") / fps).alias("duration_s"))


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def append_log(entries: DataFrame, path: str, key: str, by: str) -> None:
    """Append entries with who and when to a log (``applog``), all or none; an entry without its key is an error."""
    from .applog import append

    checked = entries.withColumn(key, F.when(F.col(key).isNull(), F.raise_error(F.lit(f"an entry without {key}")).cast(entries.schema[key].dataType)).otherwise(F.col(key)))
    append(checked.withColumn("by", F.lit(by)).withColumn("at", F.current_timestamp().cast("timestamp_ntz")), path)


def write_csv(df: DataFrame, path: str, mark: bool = False) -> None:
    """One CSV with a header, for tables of reports; an empty table gives the header only. With mark it begins with a byte-order mark, as spreadsheets want it."""
    if mark and df.columns:
        df = df.withColumnRenamed(df.columns[0], "\ufeff" + df.columns[0])
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def upserted(old: DataFrame, new: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """old with the rows of new in place of those of the same keys; what both have keeps its created."""
    kept = old.join(new.select(*keys), list(keys), "left_anti")
    created = old.select(*keys, F.col("created").alias("created_"))
    fresh = new.join(created, list(keys), "left").withColumn("created", F.coalesce("created_", "created")).drop("created_")
    return kept.unionByName(fresh, allowMissingColumns=True)


def write_splits(df: DataFrame, path: str, shares: Mapping[str, float], key: str) -> None:
    """df as Parquet in a folder for each part, drawn by digest of the key."""
    from ..operators.sequences import hash_split

    hash_split(df, key, dict(shares)).write.mode("overwrite").partitionBy("split").parquet(path)


def write_dataset(df: DataFrame, path: str, shares: Mapping[str, float], key: str, names: tuple[str, ...]) -> None:
    """Splits as write_splits, and beside them a descriptor, path with .yaml behind it, with the folder of each split and the numbered class names."""
    write_splits(df, path, shares, key)
    lines = [f"path: {path}", *(f"{part}: split={part}" for part in shares), "names:", *(f"  {k}: {name}" for k, name in enumerate(names))]
    spark = df.sparkSession
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.yaml")
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    out.write(bytearray("\n".join([*lines, ""]).encode()))
    out.close()
