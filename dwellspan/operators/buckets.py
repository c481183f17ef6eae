"""Window functions over a key's time without holding all of a key in one task.

A key's rows are dealt by time bucket. What crosses a bucket's edge, one row or one sum a bucket, is
worked out on a table of buckets and handed to the bucket behind.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def beside(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    """right with its keys renamed, and the null-safe test that they agree."""
    renamed = right.withColumnsRenamed({k: f"{k}_of_bucket" for k in keys})
    test = F.lit(True)
    for k in keys:
        test = test & left[k].eqNullSafe(renamed[f"{k}_of_bucket"])
    return renamed, test


def dealt(df: DataFrame, at: str, bucket: int) -> DataFrame:
    return df.withColumn("bucket_", F.floor(F.col(at) / bucket))


def previous(df: DataFrame, keys: Sequence[str], at: str, take: Sequence[str], name: str = "previous_") -> DataFrame:
    """Rows with a bucket_ get a struct of at and take of the row before them in their key, null for the first."""
    own = [*keys, "bucket_"]
    row = F.struct(at, *take)
    local = df.withColumn(name, F.lag(row).over(Window.partitionBy(*own).orderBy(at)))
    last = df.groupBy(*own).agg(F.max_by(row, at).alias("last_"))
    edges = last.withColumn("edge_", F.lag("last_").over(Window.partitionBy(*keys).orderBy("bucket_"))).drop("last_")
    edges, test = beside(local, edges, own)
    return local.join(edges, test, "left").withColumn(name, F.coalesce(name, "edge_")).drop("edge_", *(f"{k}_of_bucket" for k in own))


def running(df: DataFrame, keys: Sequence[str], at: str, value: str, name: str) -> DataFrame:
    """Rows with a bucket_ get the sum of value over the rows of their key up to them."""
    own = [*keys, "bucket_"]
    upto = Window.partitionBy(*own).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    local = df.withColumn(name, F.sum(value).over(upto))
    sums = df.groupBy(*own).agg(F.sum(value).alias("sum_"))
    before = Window.partitionBy(*keys).orderBy("bucket_").rowsBetween(Window.unboundedPreceding, -1)
    starts, test = beside(local, sums.withColumn("start_", F.coalesce(F.sum("sum_").over(before), F.lit(0))).drop("sum_"), own)
    return local.join(starts, test, "left").withColumn(name, F.col(name) + F.col("start_")).drop("start_", *(f"{k}_of_bucket" for k in own))


def last_seen(df: DataFrame, keys: Sequence[str], at: str, value: str, name: str, forward: bool = False) -> DataFrame:
    """Rows with a bucket_ get the last value that is not null in their key up to them; the first one from them on, when forward."""
    own = [*keys, "bucket_"]
    whole = (0, Window.unboundedFollowing) if forward else (Window.unboundedPreceding, 0)
    beyond = (1, Window.unboundedFollowing) if forward else (Window.unboundedPreceding, -1)
    pick = F.first if forward else F.last
    local = df.withColumn(name, pick(value, ignorenulls=True).over(Window.partitionBy(*own).orderBy(at).rowsBetween(*whole)))
    seen = F.when(F.col(value).isNotNull(), F.struct(at, value))
    edges = df.groupBy(*own).agg((F.min(seen) if forward else F.max(seen)).alias("seen_"))
    far = pick(F.col("seen_")[value], ignorenulls=True).over(Window.partitionBy(*keys).orderBy("bucket_").rowsBetween(*beyond))
    edges, test = beside(local, edges.withColumn("far_", far).drop("seen_"), own)
    return local.join(edges, test, "left").withColumn(name, F.coalesce(name, "far_")).drop("far_", *(f"{k}_of_bucket" for k in own))


def numbered(df: DataFrame, keys: Sequence[str], at: str, bucket: int, name: str = "rn_", tie: Sequence[str] = ()) -> DataFrame:
    """df with a bucket_ and each row's number from 1 in its key, by at and then tie."""
    own = [*keys, "bucket_"]
    local = dealt(df, at, bucket).withColumn(name, F.row_number().over(Window.partitionBy(*own).orderBy(at, *tie)).cast("long"))
    counts = local.groupBy(*own).agg(F.count("*").alias("count_"))
    before = Window.partitionBy(*keys).orderBy("bucket_").rowsBetween(Window.unboundedPreceding, -1)
    starts, test = beside(local, counts.select(*own, F.coalesce(F.sum("count_").over(before), F.lit(0)).alias("start_")), own)
    return local.join(starts, test, "left").withColumn(name, F.col(name) + F.col("start_")).drop("start_", *(f"{k}_of_bucket" for k in own))
