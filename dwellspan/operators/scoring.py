"""Measured seconds against a reference count, runs against runs, readers against readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOLERANCE = 0.20


def verdict(want: Column, got: Column, tolerance: float = TOLERANCE) -> Column:
    off = got - want
    return (
        F.when((want == 0) & (got == 0), "ok").when(want == 0, "over").when(got == 0, "MISSED")
        .when(F.abs(off) <= tolerance * want, "ok").when(off < 0, "under").otherwise("over")
    )


def score(truth: DataFrame, run: DataFrame, key: str = "brand", seconds: str = "seconds", tolerance: float = TOLERANCE) -> DataFrame:
    """key, want, got, error, verdict for each brand of the truth."""
    want = truth.select(key, F.col(seconds).cast("double").alias("want"))
    got = run.select(key, F.col(seconds).cast("double").alias("got"))
    out = want.join(got, key, "left").withColumn("got", F.coalesce("got", F.lit(0.0)))
    return out.withColumn("error", F.col("got") - F.col("want")).withColumn("verdict", verdict(F.col("want"), F.col("got"), tolerance))


def extra(truth: DataFrame, run: DataFrame, key: str = "brand") -> DataFrame:
    """What the run reports and the truth has not."""
    return run.join(truth.select(key), key, "left_anti")


def totals(scored: DataFrame) -> DataFrame:
    """captured, mae, n_ok, n_missed, n_brands."""
    want = F.sum("want")
    return scored.agg(
        F.coalesce(F.try_divide(F.sum(F.least("want", "got")), want), F.lit(0.0)).alias("captured"), F.coalesce(F.avg(F.abs("error")), F.lit(0.0)).alias("mae"),
        F.count_if(F.col("verdict") == "ok").alias("n_ok"), F.count_if(F.col("verdict") == "MISSED").alias("n_missed"), F.count("*").alias("n_brands"),
    )


def common_window(samples: DataFrame, run: str, at: str) -> DataFrame:
    """samples up to the earliest last time of all runs."""
    last = samples.groupBy(run).agg(F.max(at).alias("last")).agg(F.min("last").alias("upto_"))
    return samples.join(F.broadcast(last), F.col(at) <= F.col("upto_")).drop("upto_")  # one row


def compare(samples: DataFrame, run: str, brand: str, runs: list[str], every_s: float) -> DataFrame:
    """brand and the seconds that each run gives it, 0 where it has none."""
    return samples.groupBy(brand).pivot(run, runs).agg((F.count(F.lit(1)) * every_s).cast("double")).na.fill(0.0)


def agreement(first: DataFrame, second: DataFrame, item: str, brand: str) -> DataFrame:
    """brand, tp, fn, fp, recall, precision over the items that both readers have."""
    shared = first.select(item).distinct().join(second.select(item).distinct(), item)
    a = first.join(shared, item, "left_semi").select(item, brand).filter(F.col(brand).isNotNull()).distinct().withColumn("a_", F.lit(1))
    b = second.join(shared, item, "left_semi").select(item, brand).filter(F.col(brand).isNotNull()).distinct().withColumn("b_", F.lit(1))
    out = a.join(b, [item, brand], "full").groupBy(brand).agg(F.count_if(F.expr("a_ = 1 and b_ = 1")).alias("tp"), F.count_if(F.col("b_").isNull()).alias("fn"), F.count_if(F.col("a_").isNull()).alias("fp"))
    return out.withColumn("recall", F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))).withColumn("precision", F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")))


def agreement_totals(agreed: DataFrame) -> DataFrame:
    """recall, precision, n_missed, n_invented over all brands, and the number of brands that are often missed or invented."""
    tp, fn, fp = F.sum("tp"), F.sum("fn"), F.sum("fp")
    missing = (F.col("tp") + F.col("fn") >= 3) & (F.col("recall") < 0.6)
    inventing = ~F.coalesce(missing, F.lit(False)) & (F.col("fp") >= 3) & F.coalesce(F.col("precision") < 0.6, F.lit(True))
    return agreed.agg(F.try_divide(tp, tp + fn).alias("recall"), F.try_divide(tp, tp + fp).alias("precision"), fn.alias("n_missed"), fp.alias("n_invented"), F.count_if(missing).alias("brands_missed"), F.count_if(inventing).alias("brands_invented"))


def exact_matches(first: DataFrame, second: DataFrame, item: str, brand: str) -> DataFrame:
    """n_shared, n_exact: items of both readers, and those with equal sets of brands."""
    held = lambda df, name: df.groupBy(item).agg(F.array_sort(F.collect_set(brand)).alias(name))
    return held(first, "a_").join(held(second, "b_"), item).agg(F.count("*").alias("n_shared"), F.count_if(F.col("a_") == F.col("b_")).alias("n_exact"))
