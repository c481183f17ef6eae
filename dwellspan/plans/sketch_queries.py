"""Merged sketches against exact figures: SQL has the exact ones, and true where the error must be within its bound."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sketches
from .tables import events

_SHARES = (0.1, 0.5, 0.9)


def _days(spark, d):
    return events(spark, d).select("event_type", F.to_date("ts").alias("day"), "user_id", "value", F.concat(F.lit("u"), F.col("user_id") % 40).alias("text"))


def sketched_runs(spark, d):
    """Days as runs, summarised apart and merged: distinct users, quantiles of values, frequent texts."""
    rows = _days(spark, d)
    found = sketches.answers(sketches.merged(sketches.summarise(rows, ["event_type", "day"], "user_id", "value", "text"), ["event_type"]), ["event_type"], _SHARES)
    exact = rows.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))
    both = rows.join(F.broadcast(found), "event_type")  # a row for each event type
    ranks = both.groupBy("event_type").agg(*(F.avg((F.col("value") <= F.col("quantiles")[k]).cast("double")).alias(f"r{k}") for k in range(len(_SHARES))))
    tally = rows.groupBy("event_type", "text").agg(F.count("*").alias("c"))
    named = found.select("event_type", "n", F.explode("frequent").alias("f")).join(tally.withColumnRenamed("text", "t"), "event_type").filter("f.item = t")
    counts = named.groupBy("event_type").agg(F.max(F.abs(F.col("f.count") - F.col("c")) / F.col("n")).alias("off"), F.count("*").alias("shown"))
    near = F.lit(True)
    for k, s in enumerate(_SHARES):
        near = near & (F.abs(F.col(f"r{k}") - s) <= sketches.RANK_BOUND)
    return found.join(exact, "event_type").join(ranks, "event_type").join(counts, "event_type").select(
        "event_type", "n", "users", (F.abs(F.col("distinct") - F.col("users")) <= sketches.DISTINCT_BOUND * F.col("users") + 1).alias("distinct_ok"), near.alias("quantiles_ok"),
        ((F.col("off") <= 3.5 / sketches.TRACKED) & (F.col("shown") == 5)).alias("frequent_ok"),
    )


SKETCHED_RUNS = "SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, true AS distinct_ok, true AS quantiles_ok, true AS frequent_ok FROM events GROUP BY event_type"


def sketched_totals(spark, d):
    """Users seen up to each day, from the days' sketches."""
    rows = _days(spark, d)
    found = sketches.cumulative(sketches.summarise(rows, ["event_type", "day"], "user_id", "value", "text"), ["event_type"], "day")
    first = rows.groupBy("event_type", "user_id").agg(F.min("day").alias("first"))
    new = first.groupBy("event_type", F.col("first").alias("day")).agg(F.count("*").alias("new"))
    from pyspark.sql import Window

    upto = Window.partitionBy("event_type").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    exact = found.join(new, ["event_type", "day"], "left").withColumn("users", F.sum(F.coalesce("new", F.lit(0))).over(upto))
    return exact.select("event_type", F.col("day").cast("string").alias("day"), "n", "users", (F.abs(F.col("distinct") - F.col("users")) <= sketches.DISTINCT_BOUND * F.col("users") + 1).alias("distinct_ok"))


SKETCHED_TOTALS = """WITH f AS (SELECT event_type, user_id, min(ts::DATE) AS first FROM events GROUP BY ALL), d AS (SELECT event_type, ts::DATE AS day, count(*) AS c FROM events GROUP BY ALL)
SELECT event_type, day::VARCHAR AS day, (sum(c) OVER (PARTITION BY event_type ORDER BY day))::BIGINT AS n, (SELECT count(*) FROM f WHERE f.event_type = d.event_type AND f.first <= d.day) AS users, true AS distinct_ok FROM d"""


QUERIES = {f.__name__: f for f in (sketched_runs, sketched_totals)}
SQL = {name: globals()[name.upper()] for name in QUERIES}
