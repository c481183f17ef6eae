import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, In, StringContains, StringStartsWith

from dwellspan.sources import files, images


@pytest.fixture
def folder(tmp_path):
    os.makedirs(f"{tmp_path}/deep")
    for n in range(40):
        (tmp_path / ("deep" if n % 4 == 0 else ".") / f"f{n:02d}.png").write_bytes(bytes([n]) * (n + 1))
    return tmp_path


@pytest.mark.parametrize("condition, wanted", [
    ("name = 'f07.png'", {"f07.png"}), ("name in ('f01.png', 'f08.png', 'none.png')", {"f01.png", "f08.png"}), ("name like 'f1%'", {f"f1{k}.png" for k in range(10)}),
    ("name = 'none'", set()), ("name in ('f01.png', 'f02.png') and length > 2", {"f02.png"}), ("length < 3", {"f00.png", "f01.png"}),
])
def test_conditions_give_the_rows_they_would_without_the_scan(spark, folder, condition, wanted):
    found = images.images(spark, str(folder)).where(condition).collect()
    assert {r.name for r in found} == wanted
    assert all(r.content == bytes([int(r.name[1:3])]) * r.length and r.path.endswith(r.name) for r in found)


def test_only_wanted_files_are_planned_and_opened(spark, folder):
    reader = images.ImageSource({"path": str(folder), "task_bytes": "40"}).reader(None)
    rest = StringContains(("name",), "5")
    assert list(reader.pushFilters([In(("name",), ("f05.png", "f12.png", "f39.png")), rest])) == [rest]
    planned = reader.partitions()
    assert [[p.rsplit("/", 1)[1] for p in part.paths] for part in planned] == [["f05.png"], ["f39.png"], ["f12.png"]] and planned[2].paths[0].endswith("deep/f12.png")
    assert len(images.ImageSource({"path": str(folder)}).reader(None).partitions()[0].paths) == 40
    for one in (EqualTo(("length",), 3), EqualTo(("name", "x"), "a"), StringContains(("name",), "5")):
        assert images._test(one) is None
    assert images._test(StringStartsWith(("name",), "f1"))("f12.png")
    # a file that can't be opened would fail the query if the scan touched it
    os.rename(folder / "f09.png", folder / "hidden")
    os.symlink(folder / "nowhere", folder / "g.png")
    assert images.images(spark, str(folder)).where("name in ('f01.png', 'f02.png')").count() == 2


def test_metadata_opens_only_files_it_names(spark, folder):
    (folder / "deep" / "m.jsonl").write_text("\n".join(json.dumps({"file": f, "brand": b}) for f, b in (("f04.png", "A"), ("f08.png", "B"), ("f08.png", "C"), ("gone.png", "D"))))
    got = files.image_metadata(spark, f"{folder}/deep/*.png", f"{folder}/deep/m.jsonl", "file string, brand string")
    assert sorted((r.file, r.brand, r.length, len(r.content)) for r in got.collect()) == [("f04.png", "A", 5, 5), ("f08.png", "B", 9, 9), ("f08.png", "C", 9, 9)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "content" not in plan.split("Relation", 1)[0] or "LeftSemi" in plan


def test_contents_of_any_table_of_paths(spark, folder):
    paths = spark.createDataFrame([(f"{folder}/f01.png", 1), (f"file://{folder}/f02.png", 2), (f"{folder}/none", 3), (None, 4)], "at string, k int")
    got = {r.k: r.content for r in images.contents(paths, "at").collect()}
    assert got == {1: b"\x01\x01", 2: b"\x02\x02\x02", 3: None, 4: None}
    gallery = files.image_gallery(spark, str(folder))
    assert gallery.agg(F.count("*")).first()[0] == 40 and images.contents(gallery).where("content is null").count() == 0
