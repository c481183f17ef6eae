import random

import pytest
from pyspark.sql import functions as F

from dwellspan.operators import buckets, clusters, coverage, identify, intervals, joins, records, report, resolve, sequences
from dwellspan.sources import files


def test_percentiles_against_numpy(spark):
    import numpy as np

    rnd = random.Random(1)
    rows = [("a", rnd.gauss(0, 1)) for _ in range(900)] + [("a", 1e9)] + [("b", 5.0)] * 40 + [(None, float(k)) for k in range(11)] + [("c", None)] * 3 + [("d", 2.0), ("d", 3.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: (r.p10, r.p50, r.p90) for r in records.percentiles(df, ["k"], "v").collect()}
    assert set(got) == {"a", "b", None, "d"}
    for k, v in got.items():
        assert np.allclose(v, np.percentile([x for key, x in rows if key == k], [10, 50, 90]))
    one = records.percentiles(df, [], "v", [0.25]).first()
    assert np.isclose(one.p25, np.percentile([x for _, x in rows if x is not None], 25))
    assert records.percentiles(df.limit(0), ["k"], "v").count() == 0


def test_bucketed_forms_equal_plain_ones(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice("ab") if rnd.random() < 0.9 else None, t, rnd.random(), rnd.randrange(3)) for t in rnd.sample(range(5000), 700)]
    df = spark.createDataFrame(rows, "k string, at_us long, distance double, shot int")
    plain = sequences.states(df, ["k"], "at_us", 40, 0.8, shot="shot")
    for bucket in (7, 300, 10_000):
        got = sequences.states(df, ["k"], "at_us", 40, 0.8, shot="shot", bucket=bucket)
        assert got.columns == plain.columns and sorted(got.collect(), key=str) == sorted(plain.collect(), key=str)
        runs = intervals.stitch(df, ["k"], 25, bucket=bucket)
        assert sorted(runs.collect(), key=str) == sorted(intervals.stitch(df, ["k"], 25, bucket=10**9).collect(), key=str)
    spans = df.select("k", F.col("at_us").alias("start_us"), (F.col("at_us") + 5).alias("end_us"), "shot")
    want = sorted(intervals.join_adjacent(spans, ["k"], ["shot"], 10).collect(), key=str)
    assert sorted(intervals.join_adjacent(spans, ["k"], ["shot"], 10, bucket=50).collect(), key=str) == want
    sums = buckets.running(buckets.dealt(df, "at_us", 100), ["k"], "at_us", "shot", "total").collect()
    assert sum(r.total for r in sums if r.k == "a") == sum(sum(s for k, t, _, s in rows if k == "a" and t <= u) for key, u, _, _ in rows if key == "a")


def test_payload_sweep_against_brute_force(spark):
    rnd = random.Random(3)
    obs = []
    for i in range(150):
        s = rnd.randrange(0, 400)
        obs.append((rnd.choice("xy"), s, s + rnd.randrange(1, 60), rnd.choice(["human", "scan"]), i, rnd.choice([None, 0.1, 0.5, 0.9])))
    df = spark.createDataFrame(obs, "k string, start_us long, end_us long, status string, id int, conf double")
    cells = coverage.ledger(df, ["k"], 0, 480, bucket=50)
    got = coverage.with_payload(cells, intervals.clamp(df, 0, 480), ["k"], ["id"], "conf", 50).collect()
    at = {(r.k, t): (r.status, r.id) for r in got for t in range(r.start_us, r.end_us)}
    assert len(at) == sum(r.end_us - r.start_us for r in got) == 2 * 480  # each moment once
    for k in "xy":
        for t in range(480):
            open_ = [o for o in obs if o[0] == k and o[1] <= t < o[2]]
            status = "human" if any(o[3] == "human" for o in open_) else "scan" if open_ else "uncovered"
            best = max((o for o in open_ if o[3] == status), key=lambda o: (o[5] is not None, o[5] or 0, o[4]), default=None)
            assert at[k, t] == (status, best[4] if best else None)
    for a, b in zip(sorted(got, key=lambda r: (r.k, r.start_us)), sorted(got, key=lambda r: (r.k, r.start_us))[1:], strict=False):
        assert a.k != b.k or (a.status, a.id) != (b.status, b.id)  # neighbours that agree are one


def test_null_keys_are_one_key(spark):
    rows = [(None, i, 2.0, [float(i % 3)]) for i in range(20)] + [(1, i, 2.0, [0.0]) for i in range(20)]
    df = spark.createDataFrame(rows, "k long, at long, severity double, v array<double>")
    cuts = sequences.spaced_cuts(df, ["k"], "at", "severity", 5).filter("cut").groupBy("k").count().collect()
    assert {r.k: r["count"] for r in cuts} == {None: 4, 1: 4}
    kept = sequences.skip_similar(df, ["k"], "at", "v", 0.5).filter("keep").groupBy("k").count().collect()
    assert {r.k: r["count"] for r in kept} == {None: 20, 1: 1}
    led = clusters.leader_clusters(df.withColumn("conf", F.lit(1.0)), ["k"], "at", "v", "conf", 0.3).groupBy("k").agg(F.count_distinct("cluster").alias("n")).collect()
    assert {r.k: r.n for r in led} == {None: 3, 1: 1}


def test_cuts_over_many_batches(spark):
    rnd = random.Random(4)
    rows = [(t, rnd.choice([0.5, 1.5, None])) for t in range(30_000)]
    got = {r.at for r in sequences.spaced_cuts(spark.createDataFrame(rows, "at long, severity double"), [], "at", "severity", 7).filter("cut").collect()}
    want, last = set(), None
    for t, s in rows:
        if s is not None and s > 1 and (last is None or t - last >= 7):
            want.add(t)
            last = t
    assert got == want


def test_closed_ranges(spark):
    points = spark.createDataFrame([(1, t) for t in (0, 5, 10, 15, 20, 21, 30)], "k int, t long")
    ranges = spark.createDataFrame([(1, 0, 10, "a"), (1, 10, 20, "b"), (1, 22, 30, "c")], "k int, lo long, hi long, n string")
    for bucket in (None, 7):
        got = {r.t: r.n for r in joins.point_in_range(points, ranges, ["k"], "t", "lo", "hi", ["n"], bucket=bucket, closed=True).collect()}
        assert got == {0: "a", 5: "a", 10: "a", 15: "b", 20: "b", 21: None, 30: "c"}
        got = {r.t: r.n for r in joins.point_in_range(points, ranges, ["k"], "t", "lo", "hi", ["n"], bucket=bucket).collect()}
        assert got == {0: "a", 5: "a", 10: "b", 15: "b", 20: None, 21: None, 30: None}


def test_every_lookalike_letter_folds(spark):
    from dwellspan.functions.text import CYRILLIC, LATIN, norm_name

    assert len(CYRILLIC) == len(LATIN) == 19
    df = spark.createDataFrame([(c, l) for c, l in zip(CYRILLIC, LATIN, strict=True)] + [("З", "З"), ("Ԛ", "Ԛ")], "c string, l string")
    for r in df.select("c", "l", norm_name(F.col("c")).alias("up"), norm_name(F.lower("c")).alias("low")).collect():
        assert r.up == r.low == r.l


def test_rejected_tokens_have_their_best_score(spark):
    index = resolve.name_index(spark.createDataFrame([("Heineken", None), ("Pepsi", ["Pepsi Max"])], "name string, aliases array<string>"))
    got = {r.token: (r.name, r.match) for r in resolve.resolve(spark.createDataFrame([("ha",), ("hei",), ("zzzzzzzzzzzzzzi",), ("PEPSl",)], "token string"), index).collect()}
    assert got["ha"] == (None, 0.0) and got["PEPSl"][0] == "Pepsi"
    assert got["hei"][0] is None and got["hei"][1] == pytest.approx(6 / 11)
    assert got["zzzzzzzzzzzzzzi"][0] is None and got["zzzzzzzzzzzzzzi"][1] == pytest.approx(2 / 20)


def test_reader_pass_edges(spark):
    index = resolve.name_index(spark.createDataFrame([("Pepsi", None)], "name string, aliases array<string>"))
    reads = spark.createDataFrame([(1, 10, 0, "PEPSY", 0.9, None), (1, 12, 0, "pepsi", 0.8, None), (1, 12, 1, "Pepsi", 0.7, None), (1, 12, 2, "Pepsi", 0.2, None), (2, 1, 0, "qqq", 0.9, None), (2, 1, 1, " qqqq ", 0.9, None)], "creative long, frame long, pos long, text string, conf double, poly array<struct<x:double,y:double>>")
    read = identify.read_texts(reads, index)
    got = identify.brand_records(read).collect()
    assert [(r.creative, r.name, r.score, r.ocr_text, r.instances, r.frames, r.boxes_by_frame) for r in got] == [(1, "Pepsi", 1.0, "pepsi", 3, [10, 12], None)]
    assert [(r.creative, r.text) for r in identify.unknown_texts(read).collect()] == [(2, "qqqq")]
    empty = reads.limit(0)
    assert identify.brand_records(identify.read_texts(empty, index)).count() == 0


def test_reports_as_text_and_nested(spark):
    shots = spark.createDataFrame([(1, 0.0, 61.0, 61.0, "wide", "auto", None, []), (2, 61.0, 62.0, 1.0, "close", "review", "fast", ["short"])], "shot int, t_start double, t_end double, dur_s double, kind string, route string, note string, doubts array<string>")
    text = report.shot_text("run", shots, spark.createDataFrame([(61.0, 62.0, 3)], "first double, last double, n int"))
    assert "run: 2 shots, 01:02" in text and "doubtful: 1 of 2" in text and "short" in text and "01:01 - 01:02  3 shots" in text
    brands = spark.createDataFrame([("p", "x", 1.0), ("p", "a", 2.0), ("q", "y", 3.0)], "partner string, brand string, s double")
    notes = spark.createDataFrame([("p", "n1")], "partner string, note string")
    got = {r.partner: r.report for r in report.nested({"brands": brands, "notes": notes}, "partner").collect()}
    assert got["p"] == '{"brands":[{"brand":"a","s":2.0},{"brand":"x","s":1.0}],"notes":[{"note":"n1"}]}' and got["q"].endswith('"notes":[]}')


def test_files_of_a_run(spark, tmp_path):
    import glob

    (tmp_path / "m.json").write_text('{\n "fps": 25.0,\n "frames": 10}')
    from pyspark.sql.types import DoubleType, LongType, StructField, StructType

    schema = StructType([StructField("fps", DoubleType()), StructField("frames", LongType())])
    assert files.manifest(spark, f"{tmp_path}/m.json", schema).first().frames == 10 and files.manifest(spark, f"{tmp_path}/none", schema).count() == 0
    assert files.first_config(spark, None, f"{tmp_path}/none", f"{tmp_path}/m.json") == f"{tmp_path}/m.json"
    with pytest.raises(FileNotFoundError):
        files.first_config(spark, f"{tmp_path}/none")
    files.write_csv(spark.range(3), f"{tmp_path}/c", mark=True)
    raw = open(glob.glob(f"{tmp_path}/c/*.csv")[0], "rb").read()
    assert raw.startswith("﻿id".encode()) and raw.count(b"\n") == 4
    assert files.csv(spark, f"{tmp_path}/c", StructType([StructField("id", LongType())])).agg(F.sum("id")).first()[0] == 3
    files.write_dataset(spark.range(100), f"{tmp_path}/d", {"train": 0.8, "val": 0.2}, "id", ("logo",))
    assert spark.read.parquet(f"{tmp_path}/d").count() == 100
    assert "train: split=train" in open(f"{tmp_path}/d.yaml").read()
