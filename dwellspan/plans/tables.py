"""The test tables as the relations that operators take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.intervals import HOUR, SECOND, wall_micros

#: Events from the strongest evidence to the weakest.
EVENT_PRIORITY = ("purchase", "signup", "click", "view", "error")
#: 2024-01-01 and 2024-01-31, within which all events lie.
LO_US, HI_US = 1_704_067_200 * SECOND, 1_706_659_200 * SECOND


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str, covers_us: int = HOUR) -> DataFrame:
    """Events that each cover [start_us, end_us)."""
    at = wall_micros(F.col("ts"))
    return table(spark, sf_dir, "events").withColumns({"start_us": at, "at_us": at, "end_us": at + covers_us})


def long(c: str | Column, name: str | None = None) -> Column:
    column = F.col(c) if isinstance(c, str) else c
    return column.cast("long").alias(name or c)


def rounded(c: str | Column, name: str | None = None, digits: int = 6) -> Column:
    column = F.col(c) if isinstance(c, str) else c
    return F.round(column.cast("double"), digits).alias(name or c)
