"""Ordered rows over events, documents and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sequences as seq
from ..operators.intervals import DAY, HOUR
from .tables import events, long, rounded, table

_EV = "WITH e AS (SELECT *, epoch_us(ts) AS at_us FROM events)"
_GAP = 12 * HOUR


def _with_distance(spark, d):
    e = events(spark, d).select("event_id", "user_id", "event_type", "at_us", "value")
    return seq.consecutive(e, ["user_id"], "at_us", lambda a, b: F.abs(b - a), "value", _GAP)


_DIST = f"""{_EV}, g AS (SELECT *, at_us - lag(at_us) OVER w AS gap, abs(value - lag(value) OVER w) AS step FROM e WINDOW w AS (PARTITION BY user_id ORDER BY at_us)),
d AS (SELECT *, CASE WHEN gap <= {_GAP} THEN step END AS distance FROM g)"""


def consecutive_distance(spark, d):
    return _with_distance(spark, d).select("event_id", rounded("distance"))


CONSECUTIVE_DISTANCE = f"{_DIST} SELECT event_id, round(distance, 6) AS distance FROM d"


def _states(spark, d):
    return seq.states(_with_distance(spark, d), ["user_id"], "at_us", _GAP, 40.0, bucket=DAY)


_STATES = f"""{_DIST}, s AS (SELECT *, sum(CASE WHEN gap IS NULL OR gap > {_GAP} OR coalesce(distance, 0) > 40 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY at_us ROWS UNBOUNDED PRECEDING) AS state FROM d)"""


def state_segmentation(spark, d):
    return _states(spark, d).groupBy("user_id", "state").agg(F.min("at_us").alias("first_us"), F.max("at_us").alias("last_us"), F.count("*").alias("n"))


STATE_SEGMENTATION = f"{_STATES} SELECT user_id, state::BIGINT AS state, min(at_us) AS first_us, max(at_us) AS last_us, count(*) AS n FROM s GROUP BY user_id, state"


def carry_within_state(spark, d):
    rows = _states(spark, d).withColumn("flag", F.col("event_type") == "purchase")
    return seq.carry(rows, ["user_id", "state"], "flag").select("event_id", "carried")


CARRY_WITHIN_STATE = f"{_STATES} SELECT event_id, bool_or(event_type = 'purchase') OVER (PARTITION BY user_id, state) AS carried FROM s"


def carry_brands(spark, d):
    rows = _states(spark, d).withColumn("state", F.concat_ws("-", "user_id", "state"))
    frames = rows.select(F.col("event_id").alias("frame"), "state")
    return seq.carry_brands(rows.select(F.col("event_type").alias("brand"), F.col("event_id").alias("frame")), frames)


CARRY_BRANDS = f"{_STATES} SELECT DISTINCT a.event_type AS brand, b.event_id AS frame FROM s a JOIN s b ON a.user_id = b.user_id AND a.state = b.state"


def grouping_capped(spark, d):
    rows = seq.capped_groups(_with_distance(spark, d), ["user_id"], "at_us", "distance", 60.0, 3)
    return rows.groupBy("user_id", "group_no").agg(F.min("at_us").alias("first_us"), F.count("*").alias("members"))


GROUPING_CAPPED = f"""{_DIST}, i AS (SELECT *, sum(CASE WHEN gap IS NULL OR coalesce(distance, 0) > 60 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY at_us ROWS UNBOUNDED PRECEDING) AS island FROM d),
r AS (SELECT *, (row_number() OVER (PARTITION BY user_id, island ORDER BY at_us) - 1) // 3 AS part FROM i),
n AS (SELECT user_id, dense_rank() OVER (PARTITION BY user_id ORDER BY island, part) - 1 AS group_no, at_us FROM r)
SELECT user_id, group_no, min(at_us) AS first_us, count(*) AS members FROM n GROUP BY user_id, group_no"""


def cut_points_min_gap(spark, d):
    rows = _with_distance(spark, d).withColumn("severity", F.col("distance") / 30)
    cuts = seq.spaced_cuts(rows.select("event_id", "user_id", "at_us", "severity"), ["user_id"], "at_us", "severity", 6 * HOUR)
    return cuts.select("event_id", "cut")


CUT_POINTS_MIN_GAP = f"""{_DIST.replace("WITH", "WITH RECURSIVE", 1)}, n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY at_us) AS rn FROM d),
r AS (SELECT user_id, rn, event_id, coalesce(distance / 30 > 1, false) AS cut, CASE WHEN distance / 30 > 1 THEN at_us END AS last FROM n WHERE rn = 1
      UNION ALL SELECT n.user_id, n.rn, n.event_id, coalesce(n.distance / 30 > 1, false) AND (r.last IS NULL OR n.at_us - r.last >= {6 * HOUR}),
      CASE WHEN coalesce(n.distance / 30 > 1, false) AND (r.last IS NULL OR n.at_us - r.last >= {6 * HOUR}) THEN n.at_us ELSE r.last END FROM r JOIN n ON n.user_id = r.user_id AND n.rn = r.rn + 1)
SELECT event_id, cut FROM r"""


def shots_from_cuts(spark, d):
    rows = _with_distance(spark, d).withColumn("severity", F.round(F.col("distance") / 30, 6)).withColumn("cut", F.coalesce(F.col("severity") > 2, F.lit(False)))
    return seq.shots_from_cuts(rows, ["user_id"], "at_us", severity="severity").select("user_id", long("shot"), "first", "last", "n_rows", "cut_severity")


SHOTS_FROM_CUTS = f"""{_DIST}, c AS (SELECT *, round(distance / 30, 6) AS severity, coalesce(round(distance / 30, 6) > 2, false) AS cut FROM d),
n AS (SELECT *, sum(cut::INT) OVER (PARTITION BY user_id ORDER BY at_us ROWS UNBOUNDED PRECEDING) AS k FROM c), z AS (SELECT *, k - min(k) OVER (PARTITION BY user_id) AS shot FROM n)
SELECT user_id, shot::BIGINT AS shot, min(at_us) AS first, max(at_us) AS last, count(*) AS n_rows, arg_min(CASE WHEN shot = 0 THEN 0.0::DOUBLE ELSE severity END, at_us) AS cut_severity FROM z GROUP BY user_id, shot"""


def valley_threshold(spark, d):
    return seq.valley(events(spark, d), "value").select(rounded("threshold"), rounded("separation"), long("rank"), "n")


_VALLEY = """WITH o AS (SELECT value AS v, row_number() OVER (ORDER BY value) - 1 AS rank, lead(value) OVER (ORDER BY value) AS nxt, count(*) OVER () AS n FROM events WHERE value IS NOT NULL),
b AS (SELECT * FROM o WHERE nxt IS NOT NULL AND rank >= floor(n * 0.1) AND rank < floor(n * 0.9) ORDER BY nxt - v DESC, rank LIMIT 1)"""
VALLEY_THRESHOLD = f"{_VALLEY} SELECT round((v + nxt) / 2, 6) AS threshold, round(nxt - v, 6) AS separation, rank, n FROM b"


def calibrated_threshold(spark, d):
    return seq.calibrated(events(spark, d), "value", min_separation=0.01).select(rounded("threshold"), "source")


CALIBRATED_THRESHOLD = f"{_VALLEY} SELECT CASE WHEN n >= 20 AND nxt - v >= 0.01 THEN round((v + nxt) / 2, 6) ELSE 0.3 END AS threshold, CASE WHEN n >= 20 AND nxt - v >= 0.01 THEN 'valley' ELSE 'fallback' END AS source FROM b"


def last_wins(spark, d):
    log = table(spark, d, "conversations").select("conv_id", "turn", "role", F.length("text").cast("long").alias("n_chars"))
    return seq.last_wins(log, ["conv_id"], "turn")


LAST_WINS = "SELECT conv_id, max(turn) AS turn, arg_max(role, turn) AS role, arg_max(length(text), turn)::BIGINT AS n_chars, min(turn) AS first_seq FROM conversations GROUP BY conv_id"


def pending_work(spark, d):
    return seq.pending(table(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels"), "doc_id")


PENDING_WORK = "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"


def work_progress(spark, d):
    return seq.progress(table(spark, d, "documents"), table(spark, d, "labels"), "doc_id")


WORK_PROGRESS = "SELECT count(DISTINCT d.doc_id) AS n_total, count(DISTINCT l.doc_id) FILTER (d.doc_id IS NOT NULL) AS n_done, count(DISTINCT l.doc_id) FILTER (d.doc_id IS NULL) AS n_unknown FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id"


def round_robin(spark, d):
    return seq.worker_slice(table(spark, d, "documents").select("doc_id", "source"), ["source"], ["doc_id"], 1, 4, bucket=100_000)


ROUND_ROBIN = "SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS k FROM documents) WHERE k % 4 = 1"


def every_nth(spark, d):
    return seq.every_nth(events(spark, d), ["user_id"], ["at_us", "event_id"], 5, bucket=DAY).select("user_id", "event_id")


EVERY_NTH = f"{_EV} SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY at_us, event_id) - 1 AS k FROM e) WHERE k % 5 = 0"


def stride_sample(spark, d):
    return events(spark, d).filter(F.pmod(F.col("event_id"), F.lit(25)) == 0).select("event_id", "user_id", rounded("value"))


STRIDE_SAMPLE = "SELECT event_id, user_id, round(value, 6) AS value FROM events WHERE event_id % 25 = 0"


def evenly_spread(spark, d):
    return seq.evenly_spread(events(spark, d), ["user_id"], ["at_us", "event_id"], 5).select("user_id", "event_id")


EVENLY_SPREAD = f"""{_EV}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY at_us, event_id) - 1 AS k, count(*) OVER (PARTITION BY user_id) AS n FROM e)
SELECT DISTINCT user_id, event_id FROM r, range(5) t(i) WHERE n <= 5 OR floor(i * (n - 1) / 4.0) = k"""


def montage_batches(spark, d):
    return seq.batches(events(spark, d), ["user_id"], ["at_us", "event_id"], 3).groupBy("user_id", "batch").agg(F.count("*").alias("n"), F.min("event_id").alias("least_id"))


MONTAGE_BATCHES = f"{_EV} SELECT user_id, k // 3 AS batch, count(*) AS n, min(event_id) AS least_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY at_us, event_id) - 1 AS k FROM e) GROUP BY ALL"


def hash_split(spark, d):
    return seq.hash_split(table(spark, d, "documents").select("doc_id"), "doc_id", {"train": 0.8, "val": 0.1, "test": 0.1})


HASH_SPLIT = """WITH u AS (SELECT doc_id, ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM documents)
SELECT doc_id, CASE WHEN u < 0.8 THEN 'train' WHEN u < 0.9 THEN 'val' ELSE 'test' END AS split FROM u"""


def rolling_median(spark, d):
    return seq.rolling_median(events(spark, d).select("event_id", "user_id", "at_us", "value"), ["user_id"], "at_us", "value", 7).select("event_id", rounded("smooth"))


ROLLING_MEDIAN = f"""{_EV}, r AS (SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY user_id) AS n, list(value) OVER (PARTITION BY user_id ORDER BY at_us ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS near,
first(value) OVER (PARTITION BY user_id ORDER BY at_us ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS f, last(value) OVER (PARTITION BY user_id ORDER BY at_us ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS l FROM e WINDOW w AS (PARTITION BY user_id ORDER BY at_us))
SELECT event_id, round(list_sort(near || list_transform(range(greatest(0, 4 - k)), lambda i: f) || list_transform(range(greatest(0, 3 - (n - k))), lambda i: l))[4], 6) AS smooth FROM r"""


def longest_run(spark, d):
    rows = events(spark, d).withColumn("flag", F.col("value") > 20)
    return seq.longest_run(rows, ["user_id"], "at_us", "flag")


_RUNS = f"""{_EV}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY at_us) AS k FROM e), f AS (SELECT *, k - row_number() OVER (PARTITION BY user_id ORDER BY at_us) AS island FROM r WHERE {{test}}),
g AS (SELECT user_id, min(at_us) AS first, max(at_us) AS last, count(*) AS n FROM f GROUP BY user_id, island)"""
LONGEST_RUN = f"{_RUNS.format(test='value > 20')} SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, first) = 1"


def fast_clusters(spark, d):
    return seq.fast_clusters(events(spark, d), ["user_id"], "at_us", "value", 20.0)


FAST_CLUSTERS = f"{_RUNS.format(test='value < 20')} SELECT * FROM g WHERE n >= 3"


def close_gaps(spark, d):
    rows = events(spark, d).withColumn("flag", F.col("value") > 40)
    return seq.close_gaps(rows, ["user_id"], "at_us", "flag", 2).groupBy("user_id").agg(F.count_if("closed").alias("n_closed"), F.count_if("flag").alias("n_flag"))


CLOSE_GAPS = f"""{_EV}, r AS (SELECT *, value > 40 AS flag, row_number() OVER (PARTITION BY user_id ORDER BY at_us) AS k FROM e),
n AS (SELECT *, max(CASE WHEN flag THEN k END) OVER (PARTITION BY user_id ORDER BY k ROWS UNBOUNDED PRECEDING) AS back, min(CASE WHEN flag THEN k END) OVER (PARTITION BY user_id ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ahead FROM r)
SELECT user_id, count(*) FILTER (flag OR coalesce(ahead - back - 1 <= 2, false)) AS n_closed, count(*) FILTER (flag) AS n_flag FROM n GROUP BY user_id"""


def skip_similar(spark, d):
    v = table(spark, d, "embeddings").select("vec_id", "label", "embedding")
    return seq.skip_similar(v, ["label"], "vec_id", "embedding", 0.13).select("vec_id", "keep")


SKIP_SIMILAR = """WITH RECURSIVE v AS (SELECT label, vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS k FROM embeddings),
r AS (SELECT label, k, vec_id, true AS keep, e AS last FROM v WHERE k = 1
UNION ALL SELECT label, k, vec_id, off >= 0.13, CASE WHEN off >= 0.13 THEN e ELSE last END FROM (SELECT v.*, r.last, list_sum(list_transform(list_zip(v.e, r.last), lambda z: abs(z[1] - z[2]))) / len(v.e) AS off FROM r JOIN v ON v.label = r.label AND v.k = r.k + 1))
SELECT vec_id, keep FROM r"""


QUERIES = {f.__name__: f for f in (
    consecutive_distance, state_segmentation, carry_within_state, carry_brands, grouping_capped, cut_points_min_gap, shots_from_cuts, valley_threshold, calibrated_threshold, last_wins, pending_work,
    work_progress, round_robin, every_nth, stride_sample, evenly_spread, montage_batches, hash_split, rolling_median, longest_run, fast_clusters, close_gaps, skip_similar,
)}
SQL = {name: globals()[name.upper()] for name in QUERIES if name.upper() in globals()}
