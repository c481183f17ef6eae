"""The engine from SQL: temporary functions, table functions and views of a run's files.

    from dwellspan import sql
    sql.register(spark)
    spark.sql("SELECT * FROM name_matches(TABLE(listed_and_texts))")

Table functions take one table of names and of what is looked up in them, told apart by a flag; they ask for its rows
by partition, names first, so a partition's list of names is read once and its texts follow one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn

from .functions.text import CYRILLIC, LATIN
from .operators.resolve import many_matches, search_rank
from .sources.files import exists
from .sources.schemas import DDL

#: Scalar functions as SQL text: name, parameters, type, body.
FUNCTIONS = (
    ("norm_name", "s STRING", "STRING", f"regexp_replace(translate(upper(s), '{CYRILLIC}', '{LATIN}'), '[^\\\\p{{L}}\\\\p{{N}}]', '')"),
    ("norm_spaced", "s STRING", "STRING", "trim(regexp_replace(upper(s), '[^\\\\p{L}\\\\p{N}]+', ' '))"),
    ("mmss", "seconds DOUBLE", "STRING", "format_string('%02d:%02d', cast(floor(round(seconds) / 60) as bigint), cast(round(seconds) as bigint) % 60)"),
    ("span_us", "start_us BIGINT, end_us BIGINT", "BIGINT", "greatest(end_us - start_us, 0)"),
)


def _asked(table: AnalyzeArgument, out: list[tuple[str, T.DataType]]) -> AnalyzeResult:
    """part and id keep their types, whatever these are."""
    if not table.isTable:
        raise ValueError("a table is wanted: TABLE(part, is_text, id, text)")
    held = {f.name: f.dataType for f in table.dataType.fields}
    missing = [c for c in ("part", "is_text", "id", "text") if c not in held]
    if missing:
        raise ValueError(f"the table has no {', '.join(missing)}")
    schema = T.StructType()
    for name, kind in [("part", held["part"]), ("id", held["id"]), *out]:
        schema.add(name, kind)
    return AnalyzeResult(schema, partitionBy=[PartitioningColumn("part")], orderBy=[OrderingColumn("is_text"), OrderingColumn("id")])


class NameMatches:
    """For a table (part, is_text, id, text): part, id, name, score of all names of a part that a text of it may hold, the best first. Null texts and names don't count."""

    @staticmethod
    def analyze(table: AnalyzeArgument) -> AnalyzeResult:
        return _asked(table, [("name", T.StringType()), ("score", T.DoubleType())])

    def __init__(self) -> None:
        self.names: list[tuple[str, str]] = []
        self.known: dict[str, list[tuple[str, float]]] = {}

    def eval(self, row):
        if row["text"] is None:
            return
        text = " ".join("".join(c if c.isalnum() else " " for c in row["text"].upper()).split())
        if not row["is_text"]:
            self.names.append((text, row["text"]))
            return
        if text not in self.known:
            if len(self.known) >= 10_000:
                self.known.clear()
            self.known[text] = many_matches(text, self.names)
        for name, score in self.known[text]:
            yield row["part"], row["id"], name, score


class NameSearch:
    """For a table (part, is_text, id, text): part, id, place (from 1), name of the names of a part that answer a typed query of it."""

    @staticmethod
    def analyze(table: AnalyzeArgument) -> AnalyzeResult:
        return _asked(table, [("place", T.IntegerType()), ("name", T.StringType())])

    def __init__(self) -> None:
        self.names: list[str] = []

    def eval(self, row):
        if row["text"] is None:
            return
        if not row["is_text"]:
            self.names.append(row["text"])
            return
        for place, name in enumerate(search_rank(row["text"], self.names), 1):
            yield row["part"], row["id"], place, name


def register(spark: SparkSession) -> None:
    """Functions and table functions of this session."""
    for name, parameters, kind, body in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
    spark.udtf.register("name_matches", F.udtf(NameMatches))
    spark.udtf.register("name_search", F.udtf(NameSearch))


def open_run(spark: SparkSession, folder: str, prefix: str = "") -> list[str]:
    """Temporary views over the JSON lines of a run, by their schemas: <folder>/<name>.jsonl as <prefix><name>. The names of the views that were made."""
    made = []
    for name, ddl in DDL.items():
        if exists(spark, f"{folder}/{name}.jsonl"):
            spark.read.schema(ddl).option("mode", "DROPMALFORMED").json(f"{folder}/{name}.jsonl").createOrReplaceTempView(f"{prefix}{name}")
            made.append(f"{prefix}{name}")
    return made


def query(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """The result of a query in SQL over frames by name; ``{name}`` in the text stands for each."""
    return spark.sql(text, **tables)
