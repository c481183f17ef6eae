"""Summaries of runs that can be merged: distinct entities, quantiles and frequent texts without counting again.

A run is summarised once, in a row of bytes for each key; any set of runs is then answered from these rows. Errors:
distinct counts have a relative standard error of 1.04 / sqrt(2^lg_k) (0.016 by default), quantiles a rank error of about 0.0165 with
99 % confidence whatever the number of values, and a frequent text's count is off by 3.5 / tracked of all texts at most. Null values of a column don't count in its sketch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LG_K = 12
TRACKED = 4096
#: Bounds that hold beyond reasonable doubt (three standard errors of distinct counts).
DISTINCT_BOUND, RANK_BOUND = 3 * 1.04 / 2 ** (LG_K / 2), 0.03


def summarise(df: DataFrame, keys: Sequence[str], entity: str, value: str, text: str, tracked: int = TRACKED) -> DataFrame:
    """keys, n, entities, values_, texts: a mergeable summary of each key; keys hold the run."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("n"), F.hll_sketch_agg(entity, LG_K).alias("entities"), F.kll_sketch_agg_double(F.col(value).cast("double")).alias("values_"),
        F.expr(f"approx_top_k_accumulate(`{text}`, {tracked})").alias("texts"),
    )


def merged(summaries: DataFrame, keys: Sequence[str], tracked: int = TRACKED) -> DataFrame:
    """Summaries of all runs of each key as one, of the same form."""
    return summaries.groupBy(*keys).agg(F.sum("n").alias("n"), F.hll_union_agg("entities").alias("entities"), F.kll_merge_agg_double("values_").alias("values_"), F.expr(f"approx_top_k_combine(texts, {tracked})").alias("texts"))


def cumulative(summaries: DataFrame, keys: Sequence[str], run: str) -> DataFrame:
    """keys, run, n, distinct: what all runs of a key up to each one hold together; distinct entities can't be added up, but their sketches can."""
    upto = Window.partitionBy(*keys).orderBy(run).rowsBetween(Window.unboundedPreceding, 0)
    return summaries.select(*keys, run, F.sum("n").over(upto).alias("n"), F.hll_sketch_estimate(F.hll_union_agg("entities").over(upto)).alias("distinct"))


def answers(summaries: DataFrame, keys: Sequence[str], shares: Sequence[float] = (0.1, 0.5, 0.9), top: int = 5) -> DataFrame:
    """keys, n, distinct, quantiles (one for each share), frequent (text and count, most frequent first)."""
    wanted = F.array(*(F.lit(float(s)) for s in shares))
    return summaries.select(*keys, "n", F.hll_sketch_estimate("entities").alias("distinct"), F.kll_sketch_get_quantile_double("values_", wanted).alias("quantiles"), F.expr(f"approx_top_k_estimate(texts, {top})").alias("frequent"))
