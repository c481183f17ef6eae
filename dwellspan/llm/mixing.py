"""Mix sources to target weights: whole epochs first, then a weighted sample without replacement.

Each document draws the key -ln(u) / weight from a digest of its id, so reruns agree. Within a
source the documents of the smallest keys fill what is left of the target after whole epochs.
Keys fall into buckets; only the bucket in which a source's budget ends is sorted, so a source
that holds most of the rows is never sorted by one task.

Null texts have size 0, null sources form a source of their own. A document's key depends on its
id and weight only: repeated ids of one weight have equal keys, ties go by id and size. Rows that agree in all of these are
still decided one by one: where a source's budget ends among them, as many of them are in as fit, whichever these
are. Documents whose weight is null or not positive come last. ``mix`` keeps all columns but those named mix_*.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import n_words, table, written

#: Weights of the sources in the order of their code points, repeating.
WEIGHTS = (1.0, 2.0, 3.0)
MAX_EPOCHS = 3
BUCKETS = 4096
SYMBOLS = "[#*$%&|<>]"


def quality_weight(text: Column, size: Column) -> Column:
    """1 for plain prose, less as symbols take the place of words; exact in doubles for any engine."""
    return F.coalesce(1 / (1 + F.regexp_count(text, F.lit(SYMBOLS)) / F.greatest(size, F.lit(1))), F.lit(1.0))


def exponential_key(doc_id: Column, weight: Column) -> Column:
    """-ln(u) / weight with u in (0, 1) from the first 52 bits of the id's md5."""
    bits = F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 13), 16, 10).cast("double")
    return F.when(weight > 0, -F.log((bits + 0.5) / float(2**52)) / weight).otherwise(F.lit(float("inf")))


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add target to rows (source, source_size), one for each source.

    Sources are filled by weight up to max_epochs times their size. In the order of cap / weight the
    capped ones come first, so prefix sums find all of them at once.
    """
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights) + 1)
    capped = sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_epochs)
    tight = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before, everywhere = tight.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(1))
    rest = F.sum("source_size").over(everywhere) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    rest_weight = F.sum("weight").over(everywhere) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = capped.withColumn("level", rest / rest_weight)
    # the level of the first source that is not capped holds for all after it
    first = F.min(F.when(F.col("cap") >= F.col("level") * F.col("weight"), F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(everywhere)["level"]
    return level.select("source", "source_size", F.round(F.least(F.col("cap").cast("double"), F.coalesce(first, F.lit(0.0)) * F.col("weight")), 6).alias("target"))


def mix(docs: DataFrame, size: Column, weight: Column, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """docs with mix_size, mix_source_size, mix_target and mix_copies (how often the mix takes the row) added.

    Only ids, sizes and keys are dealt out for the plan; texts meet the plan of their bucket, and
    rows of the buckets in which budgets end meet their own decision.
    """
    names = [c for c in docs.columns if not c.startswith("mix_")]
    columns = [F.col(f"`{c}`") for c in names]
    # the generator keeps the measures from being computed again for each of their uses
    measured = docs.select(*columns, F.explode(F.array(F.struct(size.alias("size"), weight.alias("weight")))).alias("mix_m"))
    own = measured.select(*columns, F.col("mix_m.size").alias("mix_size"), exponential_key(F.col("doc_id"), F.col("mix_m.weight")).alias("mix_key"))
    own = own.withColumn("mix_bucket", F.floor((1 - F.exp(-F.col("mix_key"))) * (BUCKETS - 1)).cast("int"))
    keyed = written(own.select("doc_id", "source", F.col("mix_size").alias("size"), F.col("mix_key").alias("key"), F.col("mix_bucket").alias("bucket")), "mix-keys")
    binned = keyed.groupBy("source", "bucket").agg(F.sum("size").alias("in_bucket"))
    sources = targets(binned.groupBy("source").agg(F.sum("in_bucket").alias("source_size")), weights, max_epochs)
    sources = sources.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))).otherwise(0))
    sources = sources.withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size")).withColumnRenamed("source", "s")
    upto = Window.partitionBy("source").orderBy("bucket")
    edges = binned.withColumn("before", F.sum("in_bucket").over(upto) - F.col("in_bucket"))
    cut = (F.col("before") < F.col("budget")) & (F.col("before") + F.col("in_bucket") > F.col("budget"))
    plan = edges.join(sources, F.col("source").eqNullSafe(F.col("s"))).select(
        F.col("source").alias("mix_p_source"), F.col("bucket").alias("mix_p_bucket"), F.col("before").alias("mix_p_before"), F.col("source_size").alias("mix_source_size"),
        F.col("target").alias("mix_target"), F.col("epochs").alias("mix_p_epochs"), F.col("budget").alias("mix_p_budget"), cut.alias("mix_p_cut"),
    )
    plan = written(plan, "mix-plan")
    here = F.col("mix_p_source").eqNullSafe(F.col("source")) & (F.col("mix_p_bucket") == F.col("bucket"))
    # rows that agree are one group; those in are the first whose second half the budget reaches
    groups = keyed.join(plan.filter("mix_p_cut"), here).groupBy("source", "bucket", "key", "doc_id", "size", "mix_p_before", "mix_p_budget").agg(F.count("*").alias("n"))
    inside = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    room = F.col("mix_p_budget") - F.col("mix_p_before") - F.coalesce(F.sum(F.col("size") * F.col("n")).over(inside), F.lit(0))
    fits = F.when(F.col("size") == 0, F.when(room >= 0, F.col("n")).otherwise(0)).otherwise(F.least(F.col("n"), F.greatest(F.lit(0), F.floor(room / F.greatest("size", F.lit(1)) + 0.5))))
    ends = groups.select(F.col("doc_id").alias("mix_e_id"), F.col("source").alias("mix_e_source"), F.col("size").alias("mix_e_size"), F.col("key").alias("mix_e_key"), F.col("n").alias("mix_e_n"), fits.cast("long").alias("mix_e_in"))
    ends = written(ends, "mix-ends")
    planned = own.join(plan, own["source"].eqNullSafe(F.col("mix_p_source")) & (F.col("mix_bucket") == F.col("mix_p_bucket")))
    ends_here = own["doc_id"].eqNullSafe(F.col("mix_e_id")) & own["source"].eqNullSafe(F.col("mix_e_source")) & (F.col("mix_size") == F.col("mix_e_size")) & (F.col("mix_key") == F.col("mix_e_key"))
    planned = planned.join(ends, ends_here, "left")

    def decided(rows: DataFrame, last: Column) -> DataFrame:
        more = F.when(F.col("mix_p_cut"), F.coalesce(last, F.lit(False))).otherwise(F.col("mix_p_before") < F.col("mix_p_budget"))
        return rows.select(*(F.col(f"`{c}`") for c in names), "mix_size", "mix_source_size", "mix_target", (F.col("mix_p_epochs") + more.cast("long")).alias("mix_copies"))

    split = F.col("mix_e_in").between(1, F.col("mix_e_n") - 1)
    if ends.filter(split).isEmpty():
        return decided(planned, F.col("mix_e_in") > 0)
    # one group a source at most; its rows are numbered by file and place, so that no task has to hold all of them
    some = written(planned.filter(split), "mix-split").withColumn("mix_part", F.spark_partition_id()).withColumn("mix_at", F.monotonically_increasing_id())
    group = ["mix_e_source", "mix_e_id", "mix_e_size", "mix_e_key"]
    parts = some.groupBy(*group, "mix_part").agg(F.count("*").alias("mix_n"))
    parts = parts.withColumn("mix_first", F.sum("mix_n").over(Window.partitionBy(*group).orderBy("mix_part")) - F.col("mix_n")).select(*(F.col(c).alias(f"mix_g_{c}") for c in group), F.col("mix_part").alias("mix_g_part"), "mix_first")
    same = [F.col(c).eqNullSafe(F.col(f"mix_g_{c}")) for c in group]
    placed = some.join(parts, (F.col("mix_part") == F.col("mix_g_part")) & same[0] & same[1] & same[2] & same[3])
    number = F.col("mix_first") + F.row_number().over(Window.partitionBy("mix_part", *group).orderBy("mix_at"))
    placed = placed.withColumn("mix_number", number)
    return decided(planned.filter(F.coalesce(~split, F.lit(True))), F.col("mix_e_in") > 0).union(decided(placed, F.col("mix_number") <= F.col("mix_e_in")))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, size = table(spark, sf_dir, "documents").select("doc_id", "source", "text"), n_words(F.col("text"))
    mixed = mix(docs, size, quality_weight(F.col("text"), size))
    return mixed.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_copies")).alias("taken"))


OP8_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         coalesce(len(regexp_extract_all(text, '[#*$%&|<>]')), 0) AS symbols, text IS NULL AS none FROM documents),
keyed AS (
  SELECT doc_id, source, size,
         -ln((('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13))::BIGINT + 0.5) / 4503599627370496.0::DOUBLE)
           / (CASE WHEN none THEN 1.0::DOUBLE ELSE 1 / (1 + symbols::DOUBLE / greatest(size, 1)) END) AS key FROM sized),
sources AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS pos FROM keyed GROUP BY source),
weighed AS (SELECT *, ((pos - 1) % 3 + 1)::DOUBLE AS weight, source_size * 3 AS cap FROM sources),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER tight, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER tight, 0)) AS level
  FROM weighed WINDOW tight AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
first_open AS (SELECT coalesce(arg_min(level, cap / weight) FILTER (cap >= level * weight), 0) AS level FROM levels),
aims AS (
  SELECT source, source_size, round(least(cap::DOUBLE, f.level * weight), 6) AS target FROM levels CROSS JOIN first_open f),
epochs AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM aims),
summed AS (
  SELECT k.doc_id, k.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS budget,
         sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.size ROWS UNBOUNDED PRECEDING) AS here
  FROM keyed k JOIN epochs e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (epochs + CASE WHEN budget > 0 AND here - size / 2.0 <= budget THEN 1 ELSE 0 END))::BIGINT AS taken
FROM summed
"""
