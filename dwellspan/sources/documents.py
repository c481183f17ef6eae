"""JSON documents of any shape as VARIANT columns, with the schema found on read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read(spark: SparkSession, path: str) -> DataFrame:
    """path, doc: a row for each file, doc null where the text is no JSON."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.col("_metadata.file_path").alias("path"), F.try_parse_json("value").alias("doc"))


def is_object(value: Column) -> Column:
    return F.schema_of_variant(value).startswith("OBJECT")


def entries(docs: DataFrame, key: str, doc: str = "doc") -> DataFrame:
    """docs without doc, with pos and entry (a variant) for each entry of a document: a list, or an object that holds one under key. Objects with a key that begins with _ are comments; other documents have no entries."""
    held = F.coalesce(F.try_variant_get(doc, f"$.{key}", "variant"), F.col(doc))
    rest = [c for c in docs.columns if c != doc]
    listed = docs.select(*rest, F.try_variant_get(held, "$", "array<variant>").alias("held_")).select(*rest, F.posexplode("held_").alias("pos", "entry"))
    comment = is_object(F.col("entry")) & F.coalesce(F.exists(F.map_keys(F.try_variant_get("entry", "$", "map<string,variant>")), lambda k: k.startswith("_")), F.lit(False))
    return listed.filter(~F.coalesce(F.is_variant_null("entry"), F.lit(True)) & ~F.coalesce(comment, F.lit(False)))


def found_schema(entries_: DataFrame, entry: str = "entry") -> str:
    """The schema that all entries together have, as Spark names that of a variant."""
    return entries_.agg(F.schema_of_variant_agg(entry)).first()[0]


def typed(entries_: DataFrame, schema: T.StructType | str, entry: str = "entry") -> DataFrame:
    """entries_ without entry, with the fields of schema; an entry that is a bare value is its first field. What is not there, or of another type, is null."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    whole = is_object(F.col(entry))
    fields = []
    for n, f in enumerate(schema.fields):
        kind = f.dataType.simpleString()
        own = F.when(whole, F.try_variant_get(entry, f"$.{f.name}", kind))
        fields.append((own.otherwise(F.try_variant_get(entry, "$", kind)) if n == 0 else own).alias(f.name))
    return entries_.select(*[c for c in entries_.columns if c != entry], *fields)
