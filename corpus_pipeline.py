"""From raw documents to packed sequences: five stages, each applying one operator to all that the one before kept.

Stages take (spark, docs, sf_dir) and, but for the last, return the columns of documents. Run() writes each
stage as Parquet in the shared folder and rereads it.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellspan.llm.common import WORD, n_words, table, written
from dwellspan.llm.linededup import drop_frequent_lines
from dwellspan.llm.minhash import near_duplicates
from dwellspan.llm.mixing import mix, quality_weight
from dwellspan.llm.packing import pack, pieces
from dwellspan.llm.quality import judge

#: Words that a packing task remembers; fewer than by default, as workers of earlier stages still hold memory.
CACHE_WORDS = 150_000
#: Least similarity, in percent, of near-duplicates; op3 alone has 85.
PERCENT = 80
#: Tokenising can't be said in SQL.
ORACLE_SQL = None


#: Columns that stages read or change.
OWN = ("doc_id", "text", "lang", "source", "n_chars")


def shielded(stage: Callable) -> Callable:
    """The stage with other columns under names that no operator uses, and the names of documents afterwards."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        safe = docs.toDF(*(c if c in OWN else f"extra_column_{k}" for k, c in enumerate(docs.columns)))
        return stage(spark, safe, sf_dir).toDF(*docs.columns)

    return run


@shielded
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep.

    Null and empty texts have no words and go; texts of any length are judged whole. Each row is judged by itself,
    so repeated rows and ids stay or go together with their text. Columns of any name are kept as they are; an empty table gives an empty one.
    """
    return judge(docs).filter("kept").select(*docs.columns)


@shielded
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten or more documents hold stay in the first of them only; documents that lose all their words go.

    The first is the one of the smallest id; where rows repeat that id all of them keep the line, and rows without an id come last. A null or empty
    text is one empty line, which no rule drops, and stays. n_chars is counted anew; other columns are kept, also those
    named as the operator's own; an empty table gives an empty one.
    """
    out = drop_frequent_lines(docs, keep_first=True).filter(r"n_dropped = 0 or text rlike '[^\\x20\\x09-\\x0D]'")
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


@shielded
def near_duplicate_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of the smallest id of each group, and one of equal rows without words; rows without an id come last.

    Rows are judged by a key of their own, as ids may be null or repeated: of equal rows one stays, whichever, and of rows
    of one id with other texts each stays that no other resembles. Ties of ids go by the text's digest. Texts of any length are compared whole.
    Columns of any name are kept as they are; an empty table gives an empty one.
    """
    rows = written(docs.withColumn("row", F.monotonically_increasing_id()), "rows")
    id_, text = F.col("doc_id"), F.coalesce("text", F.lit(""))
    blank = F.when(~text.rlike(WORD), F.concat_ws(" ", F.coalesce(id_.cast("string"), F.lit("-")), F.when(F.col("text").isNull(), "-").otherwise(F.sha2("text", 256))))
    near = near_duplicates(rows.select(F.col("row").alias("doc_id"), "text"), PERCENT).select(F.col("doc_id").alias("row"), "component_id")
    judged = near.join(rows.select("row", blank.alias("blank"), F.struct(id_.isNull().alias("last"), id_.alias("id"), F.xxhash64("text").alias("digest"), "row").alias("rank")), "row")
    judged = written(judged.select("row", "rank", F.coalesce("blank", F.concat(F.lit("#"), "component_id")).alias("group")), "near-duplicates")
    kept = judged.groupBy("group").agg(F.min("rank")["row"].alias("row"))
    gone = written(judged.select("row").join(kept, "row", "left_anti"), "gone")
    return rows.join(gone, "row", "left_anti").select(*docs.columns)


@shielded
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, as equal rows.

    Null and empty texts have size 0 and come once with each epoch of their source; a null source is one of its own. Rows that agree in all that
    decides are taken one by one. Columns of any name are kept, but those named mix_* are the operator's; an empty table gives an empty one.
    """
    size = n_words(F.col("text"))
    mixed = mix(docs, size, quality_weight(F.col("text"), size)).filter("mix_copies > 0")
    return mixed.withColumn("mix_copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies")))).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences.

    Null and empty texts give one piece, the end id; long ones are cut. Each row is packed, repeated ones too, which then
    differ in their places only. Other columns are left out; an empty table gives an empty one.
    """
    return pack(pieces(docs, cache_words=CACHE_WORDS, keep_words=False))


STAGES = [("quality rules", quality), ("line dedup", lines), ("MinHash near-dedup", near_duplicate_groups), ("mixing", mixture), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
