import json

import pytest

from dwellspan import sql
from dwellspan.functions import text
from dwellspan.operators.resolve import many_matches, search_rank


def test_functions_say_what_the_column_functions_say(spark):
    from pyspark.sql import functions as F

    sql.register(spark)
    rows = spark.createDataFrame([("Лето heIN-3", 61.5, 5, 9), (None, None, 9, 5), ("ТЕСТ", 3600.4, None, 1)], "s string, x double, a long, b long")
    got = sql.query(spark, "SELECT norm_name(s), norm_spaced(s), mmss(x), span_us(a, b) FROM {rows}", rows=rows).collect()
    want = rows.select(text.norm_name(F.col("s")), text.norm_spaced(F.col("s")), text.mmss(F.col("x"))).collect()
    assert [tuple(r)[:3] for r in got] == [tuple(r) for r in want] and [r[3] for r in got] == [4, 0, None if got[2][3] is None else 0]


def test_table_functions_keep_types_partition_and_order(spark):
    sql.register(spark)
    names = {"x": ["World Cup", "LAYS", None], "y": ["Finax"]}
    rows = [(p, False, n, name) for p, held in names.items() for n, name in enumerate(held)]
    rows += [("x", True, 10, "the world cup final"), ("y", True, 11, "the world cup, final"), ("x", True, 12, None), ("z", True, 13, "no names"), ("x", True, 14, "")]
    both = spark.createDataFrame(rows, "part string, is_text boolean, id int, text string").repartition(5)
    both.createOrReplaceTempView("both_")
    got = spark.sql("SELECT * FROM name_matches(TABLE(both_))")
    assert got.dtypes == [("part", "string"), ("id", "int"), ("name", "string"), ("score", "double")]
    expected = [("x", 10, *m) for m in many_matches("THE WORLD CUP FINAL", [("WORLD CUP", "World Cup"), ("LAYS", "LAYS")])] + [("y", 11, *m) for m in many_matches("THE WORLD CUP FINAL", [("FINAX", "Finax")])]
    assert sorted(map(tuple, got.collect())) == sorted(expected)
    found = spark.sql("SELECT part, id, name FROM name_search(TABLE(SELECT part, is_text, id, substr(text, 1, 5) AS text FROM both_)) ORDER BY part, id, place").collect()
    assert [tuple(r) for r in found if r.id == 10] == [("x", 10, n) for n in search_rank("the w", ["World", "LAYS"])]
    with pytest.raises(Exception, match="no is_text, text"):
        spark.sql("SELECT * FROM name_matches(TABLE(SELECT part, id FROM both_))").collect()


def test_a_run_as_views(spark, tmp_path):
    (tmp_path / "truth.jsonl").write_text(json.dumps({"brand": "A", "seconds": 2.5}) + "\n" + '{"brand": "B", "sec')
    (tmp_path / "exposure_detail.jsonl").write_text("\n".join(json.dumps({"brand": b, "seconds": s}) for b, s in (("A", 1.0), ("A", 1.0), ("C", 3.0))))
    assert sorted(sql.open_run(spark, str(tmp_path), "r1_")) == ["r1_exposure_detail", "r1_truth"]
    got = spark.sql("SELECT t.brand, t.seconds AS truth, sum(e.seconds) AS found FROM r1_truth t LEFT JOIN r1_exposure_detail e USING (brand) GROUP BY ALL").collect()
    assert [tuple(r) for r in got] == [("A", 2.5, 2.0)]
