"""Exposure, evaluation and reports over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import exposure, joins, report, scoring
from ..operators.intervals import HOUR
from .tables import HI_US, LO_US, events, long, rounded, table

PERIOD, DURATION_S = 0.25, 2_592_000.0
RUN_ENDS_US = LO_US + (HI_US - LO_US) // 4 * 3


def _detail(spark, d):
    """Detail rows from events: five sightings to a frame, sizes and sources from ids."""
    e = events(spark, d)
    source = F.when(F.col("event_id") % 7 == 0, "whole_band").otherwise("box")
    return e.select(
        F.col("event_type").alias("brand"), F.floor(F.col("event_id") / 5).alias("frame"), (F.col("event_id") % 4 + 1).alias("n_panels"), (F.col("value") * 100).alias("area_px"),
        (F.col("value") / 10).alias("area_pct"), ((F.col("event_id") % 10) / 10).alias("dist_center"), source.alias("area_source"), F.when(F.col("event_type") == "view", F.when(F.col("event_id") % 2 == 0, "group").otherwise("per_frame")).otherwise("per_frame").alias("time_basis"),
        F.when(F.col("user_id") % 2 == 0, "ocr").otherwise("reading").alias("identified_by"), (F.col("event_type") != "error").alias("paying"), (F.col("at_us") / 1e6).alias("t"), "event_id", "user_id", "value",
    )


_DETAIL = """WITH x AS (SELECT event_type AS brand, event_id // 5 AS frame, event_id % 4 + 1 AS n_panels, value * 100 AS area_px, value / 10 AS area_pct, (event_id % 10) / 10.0::DOUBLE AS dist_center,
CASE WHEN event_id % 7 = 0 THEN 'whole_band' ELSE 'box' END AS area_source, CASE WHEN event_type = 'view' AND event_id % 2 = 0 THEN 'group' ELSE 'per_frame' END AS time_basis,
CASE WHEN user_id % 2 = 0 THEN 'ocr' ELSE 'reading' END AS identified_by, event_type <> 'error' AS paying, epoch_us(ts) / 1e6::DOUBLE AS t, event_id, user_id, value FROM events)"""
_MEANS = ("mean_panels", "mean_area_px", "mean_area_pct", "mean_dist_center", "first_seen_s", "last_seen_s", "area_from_whole_band_pct", "pct_of_video", "exposure_s")


def exposure_by_brand(spark, d):
    out = exposure.by_brand(_detail(spark, d), ["brand"], F.lit(PERIOD), F.lit(DURATION_S), "event_id", 1.0)
    return out.select("brand", "paying", "time_basis", "time_is_upper_bound", "n_frames", "identified_by", *(rounded(c) for c in _MEANS))


_BY_BRAND = f"""{_DETAIL}, y AS (SELECT brand, count(DISTINCT frame) * {PERIOD}::DOUBLE AS exposure_s, count(DISTINCT frame) AS n_frames, arg_min(paying, event_id) AS paying,
CASE WHEN count(DISTINCT time_basis) = 1 THEN min(time_basis) ELSE 'mixed' END AS time_basis, avg(n_panels) AS mean_panels, avg(area_px) AS mean_area_px, avg(area_pct) AS mean_area_pct, avg(dist_center) AS mean_dist_center,
min(t) AS first_seen_s, max(t) AS last_seen_s, 100.0::DOUBLE * count(*) FILTER (area_source = 'whole_band') / count(*) AS area_from_whole_band_pct, string_agg(DISTINCT identified_by, ',' ORDER BY identified_by) AS identified_by FROM x GROUP BY brand),
z AS (SELECT *, time_basis <> 'per_frame' AS time_is_upper_bound, 100 * exposure_s / {DURATION_S}::DOUBLE AS pct_of_video FROM y WHERE exposure_s >= 1)"""
EXPOSURE_BY_BRAND = f"{_BY_BRAND} SELECT brand, paying, time_basis, time_is_upper_bound, n_frames, identified_by, {', '.join(f'round({c}, 6) AS {c}' for c in _MEANS)} FROM z"


def exposure_totals(spark, d):
    out = exposure.totals(exposure.by_brand(_detail(spark, d), ["brand"], F.lit(PERIOD), F.lit(DURATION_S), "event_id"))
    return out.select("n_brands", "n_paying", rounded("total_s"), rounded("paying_s"))


EXPOSURE_TOTALS = f"{_BY_BRAND} SELECT count(*) AS n_brands, count(*) FILTER (paying) AS n_paying, round(sum(exposure_s), 6) AS total_s, round(coalesce(sum(exposure_s) FILTER (paying), 0), 6) AS paying_s FROM z"


def reads_summary(spark, d):
    hits = _detail(spark, d).withColumn("confidence", F.col("value") / 100)
    out = exposure.read_summary(hits, ["user_id", "brand"], "frame", "confidence", "dist_center", F.lit(PERIOD), 10)
    return out.select("user_id", "brand", "n_frames", rounded("reads_per_frame"), rounded("mean_conf", digits=9), rounded("mean_match"), rounded("exposure_s"), "dropped")


READS_SUMMARY = f"""{_DETAIL} SELECT user_id, brand, count(DISTINCT frame) AS n_frames, round(count(*)::DOUBLE / count(DISTINCT frame), 6) AS reads_per_frame, round(avg(value / 100), 9) AS mean_conf,
round(avg(dist_center), 6) AS mean_match, round(count(DISTINCT frame) * {PERIOD}::DOUBLE, 6) AS exposure_s, count(DISTINCT frame) < 10 AS dropped FROM x GROUP BY user_id, brand"""


def visibility_stats(spark, d):
    from ..functions.geometry import visibility

    line, part = table(spark, d, "lineitem"), table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_size")
    rows = line.join(part, "l_partkey").withColumn("visibility", visibility(F.col("p_size") / 50, 1 - F.col("l_discount"), F.col("l_tax") * 5))
    out = exposure.running_stats(rows, "p_brand", "l_orderkey", PERIOD, ["visibility", "l_quantity"])
    return out.select("p_brand", rounded("exposure_s"), "n_detections", rounded("mean_visibility"), rounded("mean_l_quantity"))


VISIBILITY_STATS = f"""SELECT p_brand, round(count(DISTINCT l_orderkey) * {PERIOD}::DOUBLE, 6) AS exposure_s, count(*) AS n_detections,
round(avg(p_size / 50.0::DOUBLE * (1 - l_discount) * exp(-2.0::DOUBLE * (l_tax * 5) * (l_tax * 5))), 6) AS mean_visibility, round(avg(l_quantity), 6) AS mean_l_quantity FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_brand"""


def clutter(spark, d):
    return exposure.clutter(_detail(spark, d).select("event_id", "frame", "brand"), ["frame"], "brand").select("event_id", "n_brands_in_frame")


CLUTTER = f"{_DETAIL} SELECT event_id, n AS n_brands_in_frame FROM x JOIN (SELECT frame, count(DISTINCT brand) AS n FROM x GROUP BY frame) USING (frame)"


def mode_purity(spark, d):
    e = events(spark, d).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    out = exposure.mode_purity(e, ["user_id", "day"], "event_type", "event_id")
    return out.select("user_id", "day", "event_type", rounded("purity"), "n")


MODE_PURITY = """WITH c AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n, min(event_id) AS seen FROM events GROUP BY ALL)
SELECT user_id, day, arg_max(event_type, (n, -seen)) AS event_type, round(max(n)::DOUBLE / sum(n), 6) AS purity, sum(n)::BIGINT AS n FROM c GROUP BY user_id, day"""


def best_per_frame(spark, d):
    return exposure.best_per_frame(_detail(spark, d), ["frame"], "value", "event_id", ["brand", "event_id"]).select("frame", rounded("value"), "brand", "event_id")


BEST_PER_FRAME = f"{_DETAIL} SELECT frame, round(value, 6) AS value, brand, event_id FROM x QUALIFY row_number() OVER (PARTITION BY frame ORDER BY value DESC, event_id) = 1"


def _halves(spark, d):
    """Seconds of each user by even events (the count by hand) and odd ones (the run); some users are in one only."""
    e = events(spark, d)
    half = lambda k, test: e.filter((F.col("event_id") % 2 == k) & test).groupBy(F.col("user_id").alias("brand")).agg((F.count("*") * 4.0).alias("seconds"))
    return half(0, F.col("user_id") % 10 != 3), half(1, F.col("user_id") % 10 != 7)


_HALVES = """WITH truth AS (SELECT user_id AS brand, count(*) * 4.0::DOUBLE AS want FROM events WHERE event_id % 2 = 0 AND user_id % 10 <> 3 GROUP BY user_id),
run AS (SELECT user_id AS brand, count(*) * 4.0::DOUBLE AS got FROM events WHERE event_id % 2 = 1 AND user_id % 10 <> 7 GROUP BY user_id),
s AS (SELECT t.brand, want, coalesce(got, 0) AS got, coalesce(got, 0) - want AS error FROM truth t LEFT JOIN run r ON t.brand = r.brand),
v AS (SELECT *, CASE WHEN want = 0 AND got = 0 THEN 'ok' WHEN want = 0 THEN 'over' WHEN got = 0 THEN 'MISSED' WHEN abs(error) <= 0.2 * want THEN 'ok' WHEN error < 0 THEN 'under' ELSE 'over' END AS verdict FROM s)"""


def truth_score(spark, d):
    return scoring.score(*_halves(spark, d))


TRUTH_SCORE = f"{_HALVES} SELECT * FROM v"


def score_totals(spark, d):
    return scoring.totals(scoring.score(*_halves(spark, d))).select(rounded("captured"), rounded("mae"), "n_ok", "n_missed", "n_brands")


SCORE_TOTALS = f"{_HALVES} SELECT round(sum(least(want, got)) / sum(want), 6) AS captured, round(avg(abs(error)), 6) AS mae, count(*) FILTER (verdict = 'ok') AS n_ok, count(*) FILTER (verdict = 'MISSED') AS n_missed, count(*) AS n_brands FROM v"


def extra_brands(spark, d):
    return scoring.extra(*_halves(spark, d))


EXTRA_BRANDS = f"{_HALVES} SELECT brand, got AS seconds FROM run WHERE brand NOT IN (SELECT brand FROM truth)"


def compare_runs(spark, d):
    """Users in three runs; the second one ends when three quarters of the month are over."""
    e = events(spark, d).withColumn("run", F.concat(F.lit("r"), F.col("user_id") % 3)).filter(f"run <> 'r1' or at_us < {RUN_ENDS_US}")
    out = scoring.compare(scoring.common_window(e, "run", "at_us"), "run", "event_type", ["r0", "r1", "r2"], 5.0)
    return out


COMPARE_RUNS = f"""WITH e AS (SELECT * FROM (SELECT *, epoch_us(ts) AS at_us, 'r' || (user_id % 3) AS run FROM events) WHERE run <> 'r1' OR at_us < {RUN_ENDS_US}),
w AS (SELECT min(last) AS upto FROM (SELECT max(at_us) AS last FROM e GROUP BY run))
SELECT event_type, count(*) FILTER (run = 'r0') * 5.0::DOUBLE AS r0, count(*) FILTER (run = 'r1') * 5.0::DOUBLE AS r1, count(*) FILTER (run = 'r2') * 5.0::DOUBLE AS r2 FROM e, w WHERE at_us <= upto GROUP BY event_type"""


def _readers(spark, d):
    """Events of even and odd numbers as two readers of one item for each user and six hours."""
    e = events(spark, d).withColumn("gid", F.col("user_id") * 1_000_000 + F.floor(F.col("at_us") / (6 * HOUR)))
    return e.filter("event_id % 2 = 0").select("gid", F.col("event_type").alias("brand")), e.filter("event_id % 2 = 1").select("gid", F.col("event_type").alias("brand"))


_READERS = f"""WITH e AS (SELECT *, user_id * 1000000 + epoch_us(ts) // {6 * HOUR} AS gid FROM events), a0 AS (SELECT DISTINCT gid, event_type AS brand FROM e WHERE event_id % 2 = 0), b0 AS (SELECT DISTINCT gid, event_type AS brand FROM e WHERE event_id % 2 = 1),
a AS (SELECT * FROM a0 WHERE gid IN (SELECT gid FROM b0)), b AS (SELECT * FROM b0 WHERE gid IN (SELECT gid FROM a0)),
j AS (SELECT coalesce(a.brand, b.brand) AS brand, a.gid AS ag, b.gid AS bg FROM a FULL JOIN b ON a.gid = b.gid AND a.brand = b.brand)"""


def reader_agreement(spark, d):
    return scoring.agreement(*_readers(spark, d), "gid", "brand").select("brand", "tp", "fn", "fp", rounded("recall"), rounded("precision"))


READER_AGREEMENT = f"""{_READERS}, c AS (SELECT brand, count(*) FILTER (ag IS NOT NULL AND bg IS NOT NULL) AS tp, count(*) FILTER (bg IS NULL) AS fn, count(*) FILTER (ag IS NULL) AS fp FROM j GROUP BY brand)
SELECT *, round(tp::DOUBLE / nullif(tp + fn, 0), 6) AS recall, round(tp::DOUBLE / nullif(tp + fp, 0), 6) AS precision FROM c"""


def reader_exact(spark, d):
    return scoring.exact_matches(*_readers(spark, d), "gid", "brand")


READER_EXACT = f"""{_READERS}, x AS (SELECT gid, list_sort(list(brand)) AS l FROM a GROUP BY gid), y AS (SELECT gid, list_sort(list(brand)) AS l FROM b GROUP BY gid)
SELECT count(*) AS n_shared, count(*) FILTER (x.l = y.l) AS n_exact FROM x JOIN y USING (gid)"""


def reader_totals(spark, d):
    out = scoring.agreement_totals(scoring.agreement(*_readers(spark, d), "gid", "brand"))
    return out.select(rounded("recall"), rounded("precision"), "n_missed", "n_invented", "brands_missed", "brands_invented")


READER_TOTALS = f"""{_READERS}, c AS (SELECT brand, count(*) FILTER (ag IS NOT NULL AND bg IS NOT NULL) AS tp, count(*) FILTER (bg IS NULL) AS fn, count(*) FILTER (ag IS NULL) AS fp FROM j GROUP BY brand),
f AS (SELECT *, tp + fn >= 3 AND coalesce(tp::DOUBLE / nullif(tp + fn, 0) < 0.6, false) AS missing FROM c)
SELECT round(sum(tp)::DOUBLE / sum(tp + fn), 6) AS recall, round(sum(tp)::DOUBLE / sum(tp + fp), 6) AS precision, sum(fn)::BIGINT AS n_missed, sum(fp)::BIGINT AS n_invented, count(*) FILTER (missing) AS brands_missed,
count(*) FILTER (NOT missing AND fp >= 3 AND coalesce(tp::DOUBLE / nullif(tp + fp, 0) < 0.6, true)) AS brands_invented FROM f"""


def probe_summary(spark, d):
    probes = _detail(spark, d).withColumn("conf", F.when(F.col("event_id") % 5 > 0, F.col("value") / 100))
    out = exposure.probe_summary(probes, ["user_id"], "conf", "frame", 0.05)
    return out.select("user_id", rounded("median_conf"), rounded("bad_share"), F.concat_ws(",", F.transform("bad_frames", lambda x: x.cast("string"))).alias("bad_frames"), "n_probed")


PROBE_SUMMARY = f"""{_DETAIL}, p AS (SELECT user_id, frame, CASE WHEN event_id % 5 > 0 THEN value / 100 ELSE 0 END AS conf FROM x)
SELECT user_id, round(median(conf), 6) AS median_conf, round(count(*) FILTER (conf < 0.05)::DOUBLE / count(*), 6) AS bad_share, coalesce(string_agg(frame::VARCHAR, ',' ORDER BY frame) FILTER (conf < 0.05), '') AS bad_frames, count(*) AS n_probed FROM p GROUP BY user_id"""


def shot_doubts(spark, d):
    from ..functions.rules import doubts

    o = table(spark, d, "orders")
    k = lambda n, m: F.col("o_orderkey") * n % m
    flags = doubts(k(7, 40) / 10, k(11, 101) / 100, k(1, 9) == 0, k(13, 101) / 100, k(17, 40) / 20, k(1, 50))
    return o.select("o_orderkey", F.concat_ws(",", flags).alias("doubts"))


SHOT_DOUBTS = """SELECT o_orderkey, concat_ws(',', CASE WHEN o_orderkey * 7 % 40 / 10.0 < 1 THEN 'short' END, CASE WHEN o_orderkey * 11 % 101 / 100.0 < 0.7 THEN 'unstable' END, CASE WHEN o_orderkey % 9 = 0 THEN 'partial' END,
CASE WHEN o_orderkey * 13 % 101 / 100.0 >= 0.35 AND o_orderkey * 13 % 101 / 100.0 < 0.6 THEN 'borderline' END, CASE WHEN o_orderkey * 17 % 40 > 0 AND o_orderkey * 17 % 40 / 20.0 < 1.15 AND o_orderkey % 50 > 0 THEN 'faint cut' END) AS doubts FROM orders"""


def _partners(spark, d):
    """Nations as partners, order priorities as surfaces that share three sources, order totals as seconds."""
    nations = table(spark, d, "nation")
    surfaces = spark.createDataFrame([("board", 1, "s0"), ("band", 2, "s0"), ("field", 3, "s1"), ("screen", 4, "s2")], "surface string, surface_pos int, source string")
    entitled = nations.crossJoin(F.broadcast(surfaces)).filter("(n_nationkey + surface_pos) % 3 <> 0").select(F.col("n_name").alias("partner"), "surface", "surface_pos", "source")
    customers = table(spark, d, "customer").join(F.broadcast(nations), F.col("c_nationkey") == F.col("n_nationkey"))
    orders = table(spark, d, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    measured = orders.filter("o_orderstatus = 'F' or o_orderkey % 3 <> 2").groupBy(F.col("n_name").alias("partner"), F.concat(F.lit("s"), F.col("o_orderkey") % 3).alias("source")).agg(F.count("*").cast("double").alias("seconds"))
    tally = nations.filter("n_nationkey % 5 = 0").select(F.col("n_name").alias("partner"), F.lit("field").alias("surface"), (F.col("n_nationkey") * 2.0).alias("seconds"))
    return entitled, measured, tally


_PARTNERS = """WITH f(surface, surface_pos, source) AS (VALUES ('board', 1, 's0'), ('band', 2, 's0'), ('field', 3, 's1'), ('screen', 4, 's2')),
entitled AS (SELECT n_name AS partner, f.* FROM nation, f WHERE (n_nationkey + surface_pos) % 3 <> 0),
measured AS (SELECT n_name AS partner, 's' || (o_orderkey % 3) AS source, count(*)::DOUBLE AS seconds FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderstatus = 'F' OR o_orderkey % 3 <> 2 GROUP BY ALL),
tally AS (SELECT n_name AS partner, 'field' AS surface, n_nationkey * 2.0::DOUBLE AS seconds FROM nation WHERE n_nationkey % 5 = 0),
r AS (SELECT e.*, t.seconds AS hand, m.seconds AS auto FROM entitled e LEFT JOIN measured m USING (partner, source) LEFT JOIN tally t USING (partner, surface)),
q AS (SELECT *, coalesce(hand, auto) AS seconds, CASE WHEN hand IS NOT NULL THEN 'hand' WHEN auto IS NOT NULL THEN 'measured' ELSE 'not measured' END AS method FROM r),
rows_ AS (SELECT partner, surface, surface_pos, source, seconds, method, method = 'hand' OR (method = 'measured' AND row_number() OVER (PARTITION BY partner, source, method = 'measured' ORDER BY surface_pos) = 1) AS counts FROM q)"""


def partner_report(spark, d):
    return report.partner_rows(*_partners(spark, d)).select("partner", "surface", long("surface_pos"), "source", "seconds", "method", "counts")


PARTNER_REPORT = f"{_PARTNERS} SELECT partner, surface, surface_pos::BIGINT AS surface_pos, source, seconds, method, counts FROM rows_"


def partner_totals(spark, d):
    return report.partner_totals(report.partner_rows(*_partners(spark, d)))


PARTNER_TOTALS = f"{_PARTNERS} SELECT partner, coalesce(sum(seconds) FILTER (counts), 0) AS total_s, count(*) AS n_surfaces, count(seconds) AS n_measured FROM rows_ GROUP BY partner"


def unlisted_surfaces(spark, d):
    entitled, measured, _ = _partners(spark, d)
    return report.not_entitled(entitled, measured).select("partner", "source", "seconds")


UNLISTED_SURFACES = f"{_PARTNERS} SELECT partner, source, seconds FROM measured m WHERE NOT EXISTS (SELECT 1 FROM entitled e WHERE e.partner = m.partner AND e.source = m.source)"


def advertiser_census(spark, d):
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    out = report.census(o.withColumn("one", F.lit(1)), "c_mktsegment", "o_orderpriority", "one")
    return out.select("c_mktsegment", F.to_json("by_line").alias("by_line"), "total_s")


ADVERTISER_CENSUS = """WITH l AS (SELECT c_mktsegment, o_orderpriority AS line, count(*) AS s FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
SELECT c_mktsegment, '{' || string_agg('"' || line || '":' || s, ',' ORDER BY line) || '}' AS by_line, sum(s)::BIGINT AS total_s FROM l GROUP BY c_mktsegment"""


def rollup_totals(spark, d):
    out = report.rolled_up(table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], "l_quantity")
    return out.select("l_returnflag", "l_linestatus", rounded("total"), long("level"))


ROLLUP_TOTALS = "SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 6) AS total, grouping_id(l_returnflag, l_linestatus)::BIGINT AS level FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)"


def shot_summary(spark, d):
    o = table(spark, d, "orders").withColumn("route", F.when(F.col("o_orderstatus") == "F", "auto").otherwise("review")).withColumn("dur", F.round(F.col("o_totalprice") * 100).cast("long"))
    return report.shot_summary(o, "o_orderpriority", "dur", "route")


SHOT_SUMMARY = """WITH o AS (SELECT *, round(o_totalprice * 100)::BIGINT AS dur FROM orders)
SELECT o_orderpriority, count(*) AS n_shots, sum(dur)::BIGINT AS total_s, coalesce(sum(dur) FILTER (o_orderstatus = 'F'), 0)::BIGINT AS auto_s, coalesce(sum(dur) FILTER (o_orderstatus <> 'F'), 0)::BIGINT AS review_s FROM o GROUP BY o_orderpriority"""


def exact_then_residual(spark, d):
    """Parts by brand name, exact where the size says the spelling is clean, by prefix of the type otherwise."""
    p = table(spark, d, "part").select("p_partkey", F.col("p_brand").alias("norm"), "p_type")
    known = p.select("norm").distinct().filter("norm < 'Brand#3'").withColumn("how", F.lit("exact"))
    return joins.with_fallback(p, known, ["norm"], ["how"], lambda rest: rest.withColumn("how", F.concat(F.lit("fuzzy "), F.substring("p_type", 1, 3)))).select("p_partkey", "norm", "how")


EXACT_THEN_RESIDUAL = "SELECT p_partkey, p_brand AS norm, CASE WHEN p_brand < 'Brand#3' THEN 'exact' ELSE 'fuzzy ' || substr(p_type, 1, 3) END AS how FROM part"


QUERIES = {f.__name__: f for f in (
    exposure_by_brand, exposure_totals, reads_summary, visibility_stats, clutter, mode_purity, best_per_frame, truth_score, score_totals, extra_brands, compare_runs, reader_agreement, reader_exact, reader_totals, probe_summary, shot_doubts,
    partner_report, partner_totals, unlisted_surfaces, advertiser_census, rollup_totals, shot_summary, exact_then_residual,
)}
SQL = {name: globals()[name.upper()] for name in QUERIES}
