import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from dwellspan.functions import geometry as geo
from dwellspan.functions import text, vectors
from dwellspan.operators import clusters, exposure, joins, report, resolve, scoring, sequences


def _one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_panels_add_size_but_no_time(spark):
    """Four panels of 100 x 50 in three frames of 0.2 s; one brand without boxes falls back to its band."""
    rect = lambda x: geo.rectangle(F.lit(x), F.lit(470.0), F.lit(x + 100.0), F.lit(520.0))
    frames = spark.createDataFrame([(b, f) for b in ("REPEATED", "SINGLE", "NOBOX") for f in (0, 5, 10)], "brand string, frame int")
    polys = F.when(F.col("brand") == "REPEATED", F.array(*map(rect, (100.0, 300.0, 500.0, 700.0)))).when(F.col("brand") == "SINGLE", F.array(rect(100.0)))
    band = geo.band_outline(F.array(F.lit(0.0), F.lit(500.0)), F.array(F.lit(100), F.lit(900)), F.lit(500.0), F.array(F.lit(0.8), F.lit(1.25)), F.lit(50.0))
    picked = geo.brand_polygons(F.when(polys.isNotNull(), F.create_map(F.col("frame").cast("string"), polys)), F.lit(None).cast("array<struct<x:double,y:double>>"), band, F.col("frame"))
    d = frames.withColumn("p", picked).withColumn("s", geo.surface(F.col("p.polys"), F.lit(1000.0), F.lit(1000.0))).select(
        "brand", "frame", "s.n_panels", "s.area_px", "s.area_pct", "s.dist_center", "p.area_source", F.lit("per_frame").alias("time_basis"), F.lit("ocr").alias("identified_by"), F.lit(True).alias("paying"), (F.col("frame") / 25).alias("t"))
    got = {r.brand: r for r in exposure.by_brand(d, ["brand"], F.lit(0.2), F.lit(10.0), "frame").collect()}
    assert round(got["REPEATED"].exposure_s, 6) == round(got["SINGLE"].exposure_s, 6) == 0.6
    assert (got["REPEATED"].mean_area_px, got["SINGLE"].mean_area_px, got["REPEATED"].mean_panels) == (20000, 5000, 4)
    assert abs(got["REPEATED"].mean_dist_center - ((450 - 500) ** 2 + (495 - 500) ** 2) ** 0.5 / (2**0.5 * 1000 / 2)) < 1e-9
    assert got["NOBOX"].area_from_whole_band_pct == 100 and got["SINGLE"].area_from_whole_band_pct == 0


def test_band_areas_are_those_of_their_outlines(spark):
    """Straight and bent bands, spans of one column and of more corners than are in memory at a time, parts that are null or missing."""
    rnd = random.Random(4)
    some = lambda v: None if rnd.random() < 0.04 else v
    piece = lambda: None if rnd.random() < 0.04 else (some(rnd.uniform(-1, 1)), some(rnd.uniform(0, 50)), some(rnd.randrange(0, 60)), some(rnd.randrange(40, 1500)))
    rows = []
    for k in range(1500):
        lo = rnd.randrange(0, 40)
        rows.append((k, some([some(rnd.uniform(-1, 1)), rnd.uniform(1, 90)]), [some(lo), some(lo + rnd.choice([-1, 0, 5, 16, 90, 1030, 2500]))], some(rnd.choice([0.5, 30.0])), [some(0.5), some(2.0)], some(rnd.uniform(1, 20)), some([piece() for _ in range(rnd.randrange(4))])))
    df = spark.createDataFrame(rows, "k int, coef array<double>, span array<int>, median double, clamp array<double>, h double, segments array<struct<slope:double,intercept:double,x_lo:int,x_hi:int>>")
    c = [F.col(x) for x in ("coef", "span", "median", "clamp", "h")]
    for kw in ({}, {"segments": F.col("segments")}):
        outline = geo.band_outline(*c, **kw)
        got = df.select("k", geo.band_area(*c, **kw).alias("ours"), F.when(outline.isNotNull(), geo.area(outline)).alias("theirs")).collect()
        assert sum(r.theirs is None for r in got) > 100 and sum((r.theirs or 0) > 0 for r in got) > 500
        for r in got:
            assert (r.ours is None) == (r.theirs is None) and (r.ours is None or abs(r.ours - r.theirs) <= 1e-7 * max(1, r.theirs)), (r, kw)


@pytest.mark.parametrize("name", ["bent_boundaries", "band_outlines"])
def test_bands_are_worked_out_once(spark, sf_dir, name):
    """No place of the plan repeats a row of a strip or a piece of a boundary; a band's corners are not laid out as structs to be added up."""
    from dwellspan.plans.queries import QUERIES

    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "array_min(transform" in plan and plan.count("array_min(transform") <= 4 and "zip_with" not in plan


def test_geometry(spark):
    r = _one(spark, geo.area(geo.rectangle(F.lit(0), F.lit(0), F.lit(4), F.lit(3))).alias("a"), geo.in_polygon(geo.rectangle(F.lit(0), F.lit(0), F.lit(4), F.lit(3)), F.lit(1.0), F.lit(1.0)).alias("i"),
             geo.in_polygon(geo.rectangle(F.lit(0), F.lit(0), F.lit(4), F.lit(3)), F.lit(5.0), F.lit(1.0)).alias("o"), geo.area(F.array(geo.point(F.lit(1), F.lit(1)))).alias("z"), F.size(geo.tiles(F.lit(0), F.lit(100), F.lit(5.0))).alias("t"),
             geo.is_sane(geo.rectangle(F.lit(0), F.lit(0), F.lit(4), F.lit(3)), F.lit(10), F.lit(10), F.lit(2.0)).alias("s"))
    assert (r.a, r.i, r.o, r.z, r.t, r.s) == (12.0, True, False, 0.0, 5, False)


def test_vectors_and_texts(spark):
    a, b = F.array(F.lit(0.5), F.lit(0.5)), F.array(F.lit(1.0), F.lit(0.0))
    r = _one(spark, vectors.half_l1(a, b).alias("l"), vectors.bhattacharyya(a, b).alias("h"), vectors.euclidean(a, b).alias("e"), text.mmss(F.lit(125)).alias("m"), text.duration(F.lit(125.04)).alias("d"), text.duration(F.lit(None).cast("double")).alias("n"),
             text.norm_name(F.lit("вЕта-сom 3!")).alias("nn"), text.norm_cyrillic(F.lit("BETA. x")).alias("nc"), text.truthy(F.lit(" YES ")).alias("t"), text.truthy(F.lit(None)).alias("t0"), text.truthy(F.lit("no")).alias("t1"), text.distance_label(F.lit(0.5)).alias("dl"))
    assert (r.l, round(r.h, 6), round(r.e, 6)) == (0.5, round(1 - 0.5**0.5, 6), round(0.5**0.5, 6))
    assert (r.m, r.d, r.n, r.nn, r.nc, r.t, r.t0, r.t1, r.dl) == ("02:05", "2:05 (125.0 s)", "-", "BETACOM3", "ВЕТАХ", True, True, False, "middle")


def test_scores(spark):
    truth = spark.createDataFrame([("a", 10.0), ("b", 10.0), ("c", 0.0), ("d", 0.0), ("e", 10.0), ("f", 10.0)], "brand string, seconds double")
    run = spark.createDataFrame([("a", 12.0), ("b", 5.0), ("d", 1.0), ("f", 13.0), ("x", 3.0)], "brand string, seconds double")
    got = {r.brand: r.verdict for r in scoring.score(truth, run).collect()}
    assert got == {"a": "ok", "b": "under", "c": "ok", "d": "over", "e": "MISSED", "f": "over"}
    t = scoring.totals(scoring.score(truth, run)).first()
    assert (t.captured, t.n_ok, t.n_missed) == (25 / 40, 2, 1)
    assert [r.brand for r in scoring.extra(truth, run).collect()] == ["x"]
    assert scoring.totals(scoring.score(truth.limit(0), run)).first().captured == 0


def test_one_source_counts_once(spark):
    entitled = spark.createDataFrame([("p", "board", 1, "s"), ("p", "band", 2, "s"), ("p", "field", 3, "t")], "partner string, surface string, surface_pos int, source string")
    measured = spark.createDataFrame([("p", "s", 5.0), ("p", "z", 1.0)], "partner string, source string, seconds double")
    tally = spark.createDataFrame([("p", "field", 2.0)], "partner string, surface string, seconds double")
    rows = report.partner_rows(entitled, measured, tally)
    assert report.partner_totals(rows).first() == Row(partner="p", total_s=7.0, n_surfaces=3, n_measured=3)
    assert report.not_entitled(entitled, measured).first().source == "z"
    page = report.as_html("A & B", {"rows": rows})
    assert "A &amp; B" in page and page.count("<tr>") == 4
    assert "board" in report.as_json(rows, "partner", "j").first().j


def test_match_rules(spark):
    index = spark.createDataFrame([("HEINEKEN", "Heineken"), ("PEPSI", "Pepsi"), ("PEPSICO", "PepsiCo"), ("LAYS", "Lays")], "norm string, name string")
    tokens = ["HEINEKEN", "HEINEKE", "HE", "PEPSIC", "QQQQ", "QQQQEQ"]
    got = {r.a: (r.name, r.score) for r in resolve.best_names(spark.createDataFrame([(t,) for t in tokens], "a string"), index).collect()}
    assert got["HEINEKEN"] == ("Heineken", 1.0) and got["HEINEKE"][0] == "Heineken" and "HE" not in got
    assert got["PEPSIC"][0] is None and got["QQQQ"] == (None, 0.0)  # fits two names about as well; fits none
    assert got["QQQQEQ"] == (None, max(SequenceMatcher(None, "QQQQEQ", n).ratio() for n in ("HEINEKEN", "PEPSI", "PEPSICO", "LAYS")))  # the best score of a rejected token
    assert resolve.many_matches("THE WORLD CUP FINAL", [("WORLD CUP", "w"), ("LAYS", "l"), ("FINAX", "f")]) == [("w", 1.0), ("f", 0.8)]
    assert resolve.search_rank("pe", ["COPE", "PEPSI", "ZZ", "PE"]) == ["PE", "PEPSI", "COPE"]


def test_unknown_names_recur(spark):
    index = resolve.name_index(spark.createDataFrame([("Heineken", ["Heini"]), ("Pepsi", None)], "name string, aliases array<string>"))
    assert {(r.name, r.norm) for r in index.collect()} == {("Heineken", "HEINEKEN"), ("Heineken", "HEINI"), ("Pepsi", "PEPSI")}
    hits = [(1, "OPPO", "OPPO", 0.9, f, 0.5) for f in range(6)] + [(1, "OPP0", "OPP0", 0.7, 6, 0.5), (1, "HEIND", "HEINED", 0.9, 1, 5.0), (1, "0159", "0159", 0.9, 2, 9.0)]
    got = {r.name: r for r in resolve.unknown_clusters(spark.createDataFrame(hits, "run int, text string, norm string, conf double, frame int, seconds double"), ["run"], index).collect()}
    assert got["OPPO"].promoted and got["OPPO"].frames == 7 and got["OPPO"].seconds == 3.5
    assert "like a listed name" in got["HEIND"].rejected_for and "mostly digits" in got["0159"].rejected_for
    tokens = spark.createDataFrame([("heineken",), ("HEINEKN",), ("??",), (None,)], "token string")
    assert [r.name for r in resolve.resolve(tokens, index).orderBy("token").collect()] == [None, None, "Heineken", "Heineken"]


def test_hits_are_not_broadcast(spark, tmp_path):
    """Repeated strings make a file far below the limit for broadcasts, but as rows they would be too many for a driver."""
    spark.range(1_500_000).selectExpr("id % 2 as run", "concat('WORD', id % 3 * 1111) as norm", "concat('word', id % 3 * 1111) as text", "0.9D as conf", "id % 1000 as frame", "0.5D as seconds").write.parquet(f"{tmp_path}/hits")
    hits, index = spark.read.parquet(f"{tmp_path}/hits"), resolve.name_index(spark.createDataFrame([("Heineken", None)], "name string, aliases array<string>"))
    before = spark.conf.get("spark.sql.maxBroadcastTableSize")
    spark.conf.set("spark.sql.maxBroadcastTableSize", str(64 << 20))
    try:
        got = resolve.unknown_clusters(hits, ["run"], index, min_conf=0.3).collect()
    finally:
        spark.conf.set("spark.sql.maxBroadcastTableSize", before)
    assert sorted((r.run, r.norm, r.name, r.frames, r.seconds, round(r.mean_conf, 6)) for r in got) == [(k, f"WORD{n}", f"word{n}", 500, 250.0, 0.9) for k in (0, 1) for n in (0, 1111, 2222)]


def test_leader_clusters_move_their_representative(spark):
    rows = [(1, 0, [1.0, 0.0], 0.1), (1, 1, [0.8, 0.2], 0.9), (1, 2, [0.6, 0.4], 0.5), (1, 3, [0.0, 1.0], 0.5), (2, 0, [0.0, 1.0], 0.5)]
    got = clusters.leader_clusters(spark.createDataFrame(rows, "k int, t int, v array<double>, c double"), ["k"], "t", "v", "c", 0.3)
    assert [(r.k, r.cluster) for r in got.orderBy("k", "t").collect()] == [(1, 0), (1, 0), (1, 0), (1, 1), (2, 0)]
    assert [(r.creative, r.n_frames, r.seconds) for r in clusters.cluster_summary(got, ["k"], "t", 0.5).filter("k = 1").orderBy("creative").collect()] == [(0, 3, 1.5), (1, 1, 0.5)]


def test_suppression_keeps_the_best(spark):
    rows = [(1, 0.0, 0.0, 10.0, 10.0, 0.9), (1, 2.0, 2.0, 10.0, 10.0, 0.8), (1, 40.0, 0.0, 10.0, 10.0, 0.7)]
    got = clusters.suppress(spark.createDataFrame(rows, "f int, x double, y double, w double, h double, score double"), ["f"]).collect()
    assert sorted(r.score for r in got) == [0.7, 0.9]


def test_suppression_of_small_and_large_keys(spark):
    """Equal to taking boxes one by one, in keys of a few boxes and in one of many batches, and no key is handed to Python as a whole."""
    rnd = random.Random(2)
    some = lambda hi: None if rnd.random() < 0.02 else float(rnd.randrange(hi))
    rows = [(k, some(300), some(300), some(40), some(40), some(20)) for k in [None, *range(300), *[999] * 3000] for _ in range(rnd.randrange(1, 12) if k != 999 else 1)]
    want = []
    by_key = {}
    for r in rows:
        by_key.setdefault(r[0], []).append(r)
    for own in by_key.values():
        kept = []
        for r in sorted(own, key=lambda r: [(v is None, v or 0) for v in (None if r[5] is None else -r[5], *r[1:5])]):
            size = lambda q, i: max((v for v in (q[i], r[i]) if v is not None), default=None)  # noqa: E731, B023
            close = lambda q, i: None not in (q[i], r[i], size(q, i + 2)) and abs(q[i] - r[i]) < 0.5 * size(q, i + 2)  # noqa: E731, B023
            if not any(close(q, 1) and close(q, 2) for q in kept):
                kept.append(r)
        want += kept
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = clusters.suppress(spark.createDataFrame(rows, "f int, x double, y double, w double, h double, score double"), ["f"])
        assert "FlatMapGroups" not in got._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_cuts_keep_their_distance(spark):
    df = spark.createDataFrame([(1, t, 2.0 if t in (2, 3, 4, 5, 9) else 0.5) for t in range(12)], "k int, t int, sev double")
    got = sequences.spaced_cuts(df, ["k"], "t", "sev", 3)
    assert [r.t for r in got.filter("cut").orderBy("t").collect()] == [2, 5, 9]
    assert [(r.shot, r.first, r.last) for r in sequences.shots_from_cuts(got, ["k"], "t").orderBy("shot").collect()] == [(0, 0, 1), (1, 2, 4), (2, 5, 8), (3, 9, 11)]


def test_grouping_cap_equals_a_plain_loop(spark):
    rnd = random.Random(1)
    rows = [(k, t, rnd.random()) for k in range(5) for t in range(60)]
    got = sequences.capped_groups(spark.createDataFrame(rows, "k int, t int, d double"), ["k"], "t", "d", 0.8, 4)
    want = []
    for k in range(5):
        group, size = -1, 0
        for kk, t, d in rows:
            if kk == k:
                if t == 0 or d > 0.8 or size == 4:
                    group, size = group + 1, 0
                size += 1
                want.append((k, t, group))
    assert sorted((r.k, r.t, r.group_no) for r in got.collect()) == want


def test_valley_over_ties(spark):
    values = [1.0] * 30 + [1.1] * 30 + [5.0] * 40
    got = sequences.valley(spark.createDataFrame([(v,) for v in values], "v double"), "v").first()
    assert (round(got.threshold, 6), round(got.separation, 6), got.rank, got.n) == (3.05, 3.9, 59, 100)
    assert sequences.calibrated(spark.createDataFrame([(0.1,)] * 5, "v double"), "v").first().source == "fallback"
    assert sequences.calibrated(spark.createDataFrame([(0.1,)], "v double"), "v", 0.2).first().threshold == 0.2


def test_asof_prefers_the_last_of_ties(spark):
    left = spark.createDataFrame([(1, 5), (1, 1), (2, 9)], "k int, t int")
    right = spark.createDataFrame([(1, 3, "a"), (1, 5, "b"), (1, 5, "c"), (1, 7, "d")], "k int, u int, v string")
    got = {(r.k, r.t): (r.u, r.v) for r in joins.asof(left, right, ["k"], "t", "u", ["v"]).collect()}
    assert got == {(1, 5): (5, "c"), (1, 1): (None, None), (2, 9): (None, None)}
    got = {(r.k, r.t): (r.u, r.v) for r in joins.asof(left, right, ["k"], "t", "u", ["v"], 1, forward=True).collect()}
    assert got == {(1, 5): (5, "b"), (1, 1): (None, None), (2, 9): (None, None)}


@pytest.mark.parametrize("forward", [False, True])
def test_asof_in_buckets_equals_asof(spark, forward):
    rnd = random.Random(9)
    left = spark.createDataFrame([(rnd.randint(0, 2), rnd.randint(0, 60), i) for i in range(120)], "k int, t int, i int")
    right = spark.createDataFrame([(rnd.randint(0, 2), rnd.randint(0, 60), i) for i in range(25)], "k int, u int, v int")
    rows = lambda bucket: sorted(map(str, joins.asof(left, right, ["k"], "t", "u", ["v"], 20, forward, bucket).collect()))
    assert rows(None) == rows(7) == rows(1)


def test_logs_and_work(spark):
    log = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("a", 3, None)], "k string, seq int, v string")
    assert sorted((r.k, r.v, r.first_seq) for r in sequences.last_wins(log, ["k"], "seq").collect()) == sorted([("a", None, 1), ("b", "y", 2)])
    index = spark.createDataFrame([(i,) for i in range(10)], "gid int")
    done = spark.createDataFrame([(1,), (1,), (99,)], "gid int")
    assert sequences.pending(index, done, "gid").count() == 9
    p = sequences.progress(index, done, "gid").first()
    assert (p.n_total, p.n_done, p.n_unknown) == (10, 1, 1)


@pytest.mark.parametrize("n", [1, 3, 5, 10, 50])
def test_evenly_spread(spark, n):
    rows = [(1, i) for i in range(17)]
    got = [r.i for r in sequences.evenly_spread(spark.createDataFrame(rows, "k int, i int"), ["k"], ["i"], n).orderBy("i").collect()]
    want = sorted({int(j * 16 / (n - 1)) for j in range(n)}) if 1 < n < 17 else [0] if n == 1 else list(range(17))
    assert got == want


def test_evenly_spread_to_the_nearest(spark):
    df = spark.createDataFrame([(1, i) for i in range(10)], "k int, i int")
    pick = lambda n: [r.i for r in sequences.evenly_spread(df, ["k"], ["i"], n, nearest=True).orderBy("i").collect()]
    assert pick(1) == [5] and pick(3) == [0, 4, 9] and pick(4) == [0, 3, 6, 9]


def test_states_open_where_a_distance_is_unknown(spark):
    rows = [(1, 0, None, "a"), (1, 1, 0.1, "a"), (1, 2, None, "a"), (1, 3, 0.1, None), (1, 4, 0.1, "b"), (1, 5, 0.1, "c"), (1, 9, 0.0, "c"), (1, 10, 0.9, "c")]
    got = sequences.states(spark.createDataFrame(rows, "k int, t int, distance double, shot string"), ["k"], "t", 2, 0.5, shot="shot")
    assert [r.state for r in got.orderBy("t").collect()] == [1, 1, 2, 2, 2, 3, 4, 5]


def test_leader_clusters_and_skip_similar_leave_null_vectors_out(spark):
    a, b = [0.0, 1.0], [1.0, 0.0]
    vectors = [None, a, None, a, [None, 1.0], [float("nan"), 0.0], [1.0], b, a, []]
    rows = spark.createDataFrame([(1, t, v, None if t == 1 else 0.5 + t / 100) for t, v in enumerate(vectors)] + [(2, 0, None, 1.0)], "k int, t int, v array<double>, c double")
    got = {(r.k, r.t): r.cluster for r in clusters.leader_clusters(rows, ["k"], "t", "v", "c", 0.3).collect()}
    assert [got[1, t] for t in range(10)] == [None, 0, None, 0, None, None, None, 1, 0, None] and got[2, 0] is None
    kept = {(r.k, r.t): r.keep for r in sequences.skip_similar(rows, ["k"], "t", "v", 0.2).collect()}
    assert [t for t in range(10) if kept[1, t]] == [1, 7, 8] and not kept[2, 0]
    nothing = rows.limit(0)
    assert clusters.leader_clusters(nothing, ["k"], "t", "v", "c").count() == 0 and sequences.skip_similar(nothing, ["k"], "t", "v", 0.2).count() == 0


@pytest.mark.parametrize("conf", [[None, 0.1, 0.2], [float("nan"), 0.1, 0.2], [0.3, None, 0.1]])
def test_null_confidence_is_below_all_others(spark, conf):
    vectors = [[0.0, 1.0], [0.2, 0.8], [0.4, 0.6]]
    rows = spark.createDataFrame([(1, t, v, c) for t, (v, c) in enumerate(zip(vectors, conf))], "k int, t int, v array<double>, c double")
    got = [r.cluster for r in clusters.leader_clusters(rows, ["k"], "t", "v", "c", 0.3).orderBy("t").collect()]
    assert got == ([0, 0, 0] if conf[0] != 0.3 else [0, 0, 1])


def test_percentiles_hold_few_values_beside_an_outlier(spark):
    import numpy as np

    from dwellspan.operators import records

    rng = np.random.default_rng(5)
    for values in ([*(rng.random(30_000) * 100), 1e12], [*rng.exponential(1, 20_001)], [7.0] * 9000 + [1.0], [3.0, 1.0], list(range(3001))):
        df = spark.createDataFrame([(1, float(v)) for v in values] + [(2, None), (None, 4.0)], "k int, v double")
        got = {r.k: r for r in records.percentiles(df, ["k"], "v", [0.1, 0.5, 0.9, 0.99]).collect()}
        assert [got[1].p10, got[1].p50, got[1].p90, got[1].p99] == pytest.approx(np.quantile(values, [0.1, 0.5, 0.9, 0.99]).tolist(), rel=1e-12)
        assert got[None].p50 == 4.0 and 2 not in got
    hot = spark.createDataFrame([(1, float(v)) for v in [*(rng.random(50_000) * 100), 1e12]], "k int, v_ double")
    _, inside = records._bracketed(hot, ["k"], [0.1, 0.5, 0.9], 2000)
    assert inside.groupBy("k", "share_").agg(F.sum("c_").alias("n")).agg(F.max("n")).first()[0] < 0.01 * 50_001  # what one task ranks


def test_minibatch_kmeans_is_the_same_on_any_partitions(spark):
    rnd = random.Random(2)
    rows = [(i, [rnd.gauss(5 * (i % 6), 0.5), rnd.gauss(-3 * (i % 6), 0.5)]) for i in range(600)] + [(7, [0.5, 0.5]), (None, [1.0, 1.0]), (900, None), (901, [1.0]), (902, [None, 2.0]), (903, [float("nan"), 1.0]), (904, [])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    points = clusters.whole_integers(df, "id", "v", 1024)
    assert points.count() == 602
    centres = clusters.minibatch_centres(points.repartition(4), "id", "v", 6, 5, 3)
    assert centres == clusters.minibatch_centres(points.repartition(200), "id", "v", 6, 5, 3)
    found = clusters.minibatch_kmeans(df, "id", "v", 6, 5, 3, scale=1024).collect()
    ints = {r.id: r.v for r in points.collect() if r.id != 7}
    for r in found:
        if r.id != 7:
            assert (r.distance, r.cluster) == min((sum((a - b) ** 2 for a, b in zip(ints[r.id], c)), k) for k, c in enumerate(centres))
    far = clusters.minibatch_centres(points, "id", "v", 6, 5, 0)  # the centres before any batch
    loss = lambda held: sum(min(sum((a - b) ** 2 for a, b in zip(v, c)) for c in held) for v in ints.values())
    assert loss(centres) < 0.8 * loss(far)
    assert clusters.minibatch_kmeans(df.limit(0), "id", "v", 3).count() == 0
