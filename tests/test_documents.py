import json

import pytest

from dwellspan.sources import documents, files

ENTRIES = [{"name": "Acme", "aliases": ["AC"], "paying": False, "more": {"x": [1, 2.5]}}, {"name": "Bolt", "aliases": "none"}, {"_comment": "x"}, "Cord", 7, None]
SCHEMA = "name string, aliases array<string>, paying boolean"


@pytest.mark.parametrize("shape", ["list", "wrapped"])
def test_documents_of_any_shape(spark, tmp_path, shape):
    (tmp_path / "s.json").write_text(json.dumps({"sponsors": ENTRIES, "note": 1} if shape == "wrapped" else ENTRIES, indent=1))
    held = documents.entries(documents.read(spark, str(tmp_path / "s.json")), "sponsors")
    got = documents.typed(held, SCHEMA).orderBy("pos").collect()
    assert [(r.pos, r.name, r.aliases, r.paying) for r in got] == [(0, "Acme", ["AC"], False), (1, "Bolt", None, None), (3, "Cord", None, None), (4, "7", None, None)]
    assert got[0].path.endswith("/s.json")
    assert "more: OBJECT<x: ARRAY<" in documents.found_schema(held.where("pos < 1")) and documents.found_schema(held) == "VARIANT"
    assert held.selectExpr("try_variant_get(entry, '$.more.x[1]', 'double') AS x").where("x is not null").first().x == 2.5
    plain = files.json_document(spark, str(tmp_path / "s.json"), __import__("pyspark").sql.types.StructType.fromDDL("name string, paying boolean"), "sponsors").collect()
    assert [r.name for r in plain][:2] == ["Acme", "Bolt"]


@pytest.mark.parametrize("text", ["{", "", "3", '"x"', '{"other": [1]}', '{"sponsors": 5}', "[]"])
def test_documents_without_entries(spark, tmp_path, text):
    (tmp_path / "s.json").write_text(text)
    assert documents.entries(documents.read(spark, str(tmp_path)), "sponsors").count() == 0
