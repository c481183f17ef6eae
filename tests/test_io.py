import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwellspan.operators import sequences
from dwellspan.sources import applog, files
from dwellspan.sources.schemas import DDL, schema
from dwellspan.streaming import observations as stream


def test_schemas_parse(spark):
    assert all(len(schema(name).fields) > 1 for name in DDL)


def test_json_lines(spark, tmp_path):
    p = tmp_path / "r.jsonl"
    p.write_text('{"gid": 1, "brands": ["A"]}\n\n{"gid": 2, "brands": []}\n{"gid": 3, "bra')
    s = schema("readings")
    assert sorted(r.gid for r in files.json_lines(spark, str(p), s).collect()) == [1, 2]
    assert files.json_lines(spark, str(p), s, keep_bad=True).cache().filter(F.col(files.BAD_ROW).isNotNull()).count() == 1
    assert files.json_lines(spark, str(tmp_path / "none"), s).count() == 0


@pytest.mark.parametrize("shape", ["names", "objects", "wrapped"])
def test_json_documents_of_any_shape(spark, tmp_path, shape):
    entries = ["Acme", "Bolt"] if shape == "names" else [{"name": "Acme", "aliases": ["AC"], "paying": False}, {"name": "Bolt"}, {"_comment": "x"}]
    (tmp_path / "s.json").write_text(json.dumps({"sponsors": entries} if shape == "wrapped" else entries, indent=1))
    got = files.json_document(spark, str(tmp_path / "s.json"), T.StructType.fromDDL("name string, aliases array<string>, paying boolean"), "sponsors").collect()
    assert [r.name for r in got] == ["Acme", "Bolt"]
    assert got[0].aliases == (None if shape == "names" else ["AC"])


def test_json_map_and_csv(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"_note": ["x"], "1": ["A", "B"], "2": []}')
    assert {r.key: r.value for r in files.json_map(spark, str(tmp_path / "m.json")).collect()} == {"1": ["A", "B"], "2": []}
    (tmp_path / "a.csv").write_bytes("﻿brand,paying,exposure_s\nA,True,1.5\nB,0,oops\nC,,2\n".encode())
    got = {r.brand: (r.paying, r.exposure_s, r.missing) for r in files.csv(spark, str(tmp_path / "a.csv"), T.StructType.fromDDL("brand string, paying boolean, exposure_s double, missing int"), ("paying",)).collect()}
    assert got == {"A": (True, 1.5, None), "B": (False, None, None), "C": (True, 2.0, None)}


def test_logs_and_upserts(spark, tmp_path):
    log = str(tmp_path / "log")
    for n in (1, 2):
        files.append_log(spark.createDataFrame([(7, [f"v{n}"])], "gid int, brands array<string>"), log, "gid", "me")
    assert applog.read(spark, log, "gid int, brands array<string>, by string, at timestamp_ntz").where("by = 'me' and at is not null").count() == 2
    with pytest.raises(Exception, match="without gid"):
        files.append_log(spark.createDataFrame([(None, ["x"])], "gid int, brands array<string>"), log, "gid", "me")
    old = spark.createDataFrame([("r", "a", 1, "x"), ("r", "b", 1, "y")], "run string, stage string, created int, v string")
    new = spark.createDataFrame([("r", "b", 9, "z"), ("r", "c", 9, "w")], "run string, stage string, created int, v string")
    got = sorted((r.stage, r.created, r.v) for r in files.upserted(old, new, ("run", "stage")).collect())
    assert got == [("a", 1, "x"), ("b", 1, "z"), ("c", 9, "w")]


def test_images_and_splits(spark, tmp_path):
    for name in ("ACME__1.png", "ACME__2.png", "BOLT.png"):
        (tmp_path / name).write_bytes(name.encode())
    assert sorted((r.name, r.position, r.path.rsplit("/", 1)[1]) for r in files.image_gallery(spark, str(tmp_path)).collect()) == [("ACME", 0, "ACME__1.png"), ("ACME", 1, "ACME__2.png"), ("BOLT", 0, "BOLT.png")]
    files.write_splits(spark.range(300), str(tmp_path / "out"), {"train": 0.8, "val": 0.2}, "id")
    got = {r.split: r["count"] for r in spark.read.parquet(str(tmp_path / "out")).groupBy("split").count().collect()}
    assert sum(got.values()) == 300 and 200 < got["train"] < 280


def test_stride(spark):
    assert files.strided(spark.range(100).withColumnRenamed("id", "frame"), "frame", 25, 5).count() == 20


def _stream(spark, path, sf_dir, files_n=4):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").orderBy("ts")
    for k, lo in enumerate(range(0, 1000, 1000 // files_n)):
        sequences.ranked(e, [], ["ts"]).filter((F.col("rank") >= lo) & (F.col("rank") < lo + 1000 // files_n)).drop("rank").coalesce(1).write.parquet(f"{path}/{k}")
    s = spark.read.parquet(f"{path}/0").schema
    return spark.readStream.schema(s).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(path), e


def test_streams_agree_with_batches(spark, tmp_path, sf_dir):
    live, e = _stream(spark, str(tmp_path / "in"), sf_dir)
    counts = stream.window_counts(stream.timed(live, "ts", "1 hour"), ["event_type"], "ts", "1 day")
    q = counts.writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c1")).start()
    q.awaitTermination(120)
    batch = stream.window_counts(e.withColumn("ts", F.col("ts").cast("timestamp")), ["event_type"], "ts", "1 day")
    key = lambda r: (r.event_type, r.start, r.n)
    assert sorted(map(key, spark.table("counts").collect())) == sorted(map(key, batch.collect()))
    spells = stream.session_spells(stream.timed(live, "ts", "1 hour"), ["user_id"], "ts", "12 hours")
    q = spells.writeStream.format("memory").queryName("spells").outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c2")).start()
    q.awaitTermination(120)
    batch = {(r.user_id, r.start, r.n) for r in stream.session_spells(e.withColumn("ts", F.col("ts").cast("timestamp")), ["user_id"], "ts", "12 hours").collect()}
    closed = {(r.user_id, r.start, r.n) for r in spark.table("spells").collect()}
    assert closed and closed <= batch


def test_running_union_and_late_rows(spark, tmp_path, sf_dir):
    from dwellspan.operators import intervals

    live, e = _stream(spark, str(tmp_path / "in"), sf_dir)
    at = F.unix_micros("ts")
    timed = stream.timed(live, "ts", "1 hour").withColumns({"start_us": at, "end_us": at + intervals.HOUR})
    q = stream.running_union(timed.select("event_type", "ts", "start_us", "end_us"), "event_type").writeStream.format("memory").queryName("unions").outputMode("update").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    q.awaitTermination(120)
    got = {r.event_type: r.u for r in spark.table("unions").groupBy("event_type").agg(F.max("union_us").alias("u")).collect()}
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    want = {r.event_type: r.union_us for r in intervals.union_measure(e.withColumns({"start_us": at, "end_us": at + intervals.HOUR}), ["event_type"]).collect()}
    assert got == want

    on_time, late = str(tmp_path / "ok"), str(tmp_path / "late")
    write = stream.split_late(on_time, late, "ts", 3600)
    first = e.orderBy(F.desc("ts")).limit(500)
    write(first, 0)
    write(e.join(first.select("event_id"), "event_id", "left_anti").select(*e.columns), 1)
    assert stream.read_log(spark, on_time).count() + stream.read_log(spark, late).count() == 1000 and stream.read_log(spark, late).count() > 400
    again = [stream.read_log(spark, p).count() for p in (on_time, late)]
    write(e.join(first.select("event_id"), "event_id", "left_anti").select(*e.columns), 1)  # the last batch once more
    for n in (2, 3, 3):  # empty batches
        write(e.limit(0), n)
    assert [stream.read_log(spark, p).count() for p in (on_time, late)] == again
    assert len(list((tmp_path / "late_marks").glob("b*"))) <= 3
    keep = stream.keep_last(str(tmp_path / "log"), ["user_id"], "event_id")
    keep(e.limit(10), 0)
    keep(e.limit(10), 0)  # a replay
    assert stream.read_log(spark, str(tmp_path / "log")).count() == 10
