"""Tables between the rounds of an iterative job."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Where sessions on a local master without spark.checkpoint.dir keep them.
LOCAL = "/tmp/checkpoints/dwellspan"


def shared_folder(spark: SparkSession) -> str:
    """A folder of this application that the driver and all executors share."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{(found or LOCAL).rstrip('/')}/dwellspan-{spark.sparkContext.applicationId}"


def cut(df: DataFrame, by: str | None = None) -> DataFrame:
    """df, written to the shared folder and read back: it is computed once, its lineage ends, and it survives lost executors. With by, a filter on that column reads only what it lets through."""
    path = f"{shared_folder(df.sparkSession)}/rounds-{uuid.uuid4().hex}"
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
