"""Interval algebra and the coverage ledger over events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import coverage, intervals, joins
from ..operators.intervals import HOUR, SECOND
from .tables import EVENT_PRIORITY, HI_US, LO_US, events

MINUTE = 60 * SECOND
_EV = "WITH e AS (SELECT *, epoch_us(ts) AS at_us, epoch_us(ts) AS start_us, epoch_us(ts) + 3600000000 AS end_us FROM events)"
_REACHED = "max(end_us) OVER (PARTITION BY {k} ORDER BY start_us, end_us ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


def interval_union(spark, d):
    e = events(spark, d)
    n = e.groupBy("event_type").agg(F.count("*").alias("n_events"))
    return intervals.union_measure(e, ["event_type"]).join(n, "event_type")


INTERVAL_UNION = f"""{_EV}, r AS (SELECT *, {_REACHED.format(k="event_type")} AS reached FROM e)
SELECT event_type, sum(greatest(0, end_us - greatest(start_us, coalesce(reached, start_us))))::BIGINT AS union_us, count(*) AS n_events FROM r GROUP BY event_type"""


def interval_merged(spark, d):
    return intervals.merged(events(spark, d), ["user_id"])


_MERGED = f"""r AS (SELECT *, {_REACHED.format(k="user_id")} AS reached FROM e),
i AS (SELECT *, sum(CASE WHEN reached IS NULL OR start_us > reached THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY start_us, end_us ROWS UNBOUNDED PRECEDING) AS island FROM r),
m AS (SELECT user_id, min(start_us) AS start_us, max(end_us) AS end_us FROM i GROUP BY user_id, island)"""
INTERVAL_MERGED = f"{_EV}, {_MERGED} SELECT * FROM m"


def interval_complement(spark, d):
    return intervals.complement(events(spark, d), ["user_id"], LO_US, HI_US)


INTERVAL_COMPLEMENT = f"""{_EV}, {_MERGED}, c AS (SELECT user_id, greatest(start_us, {LO_US}) AS s, least(end_us, {HI_US}) AS t FROM m),
g AS (SELECT user_id, t AS start_us, coalesce(lead(s) OVER (PARTITION BY user_id ORDER BY s), {HI_US}) AS end_us FROM c WHERE t > s
      UNION ALL SELECT user_id, {LO_US}, min(s) FROM c WHERE t > s GROUP BY user_id)
SELECT * FROM g WHERE end_us > start_us"""


def interval_clamp(spark, d):
    lo, hi = LO_US + 5 * intervals.DAY, LO_US + 6 * intervals.DAY
    return intervals.clamp(events(spark, d), lo, hi).select("event_id", "start_us", "end_us")


INTERVAL_CLAMP = f"""{_EV} SELECT event_id, greatest(start_us, {LO_US + 5 * 86400 * SECOND}) AS start_us, least(end_us, {LO_US + 6 * 86400 * SECOND}) AS end_us FROM e
WHERE least(end_us, {LO_US + 6 * 86400 * SECOND}) > greatest(start_us, {LO_US + 5 * 86400 * SECOND})"""


def merge_surfaces(spark, d):
    from ..operators.exposure import merge_surfaces as merge

    e = events(spark, d).withColumn("surface", F.concat(F.lit("s"), F.col("event_id") % 3))
    return merge(e, ["event_type"])


MERGE_SURFACES = f"""{_EV}, r AS (SELECT *, 's' || (event_id % 3) AS surface, {_REACHED.format(k="event_type")} AS reached FROM e)
SELECT event_type, count(DISTINCT surface) AS n_surfaces, string_agg(DISTINCT surface, ',' ORDER BY surface) AS surfaces, count(DISTINCT (surface, start_us)) AS n_samples,
       sum(greatest(0, end_us - greatest(start_us, coalesce(reached, start_us))))::BIGINT AS union_us FROM r GROUP BY event_type"""


def _observations(spark, d):
    """Five minutes of evidence around each event, on two lines."""
    e = events(spark, d, 0)
    lo, hi = coverage.around(F.col("at_us"), 150 * SECOND)
    return e.select((F.col("event_id") % 2).alias("line"), lo.alias("start_us"), hi.alias("end_us"), F.col("event_type").alias("status"), "event_id", "value")


def coverage_ledger(spark, d):
    return coverage.ledger(_observations(spark, d), ["line"], LO_US, HI_US, EVENT_PRIORITY)


_CLASS = " ".join(f"WHEN '{c}' THEN {len(EVENT_PRIORITY) - i}" for i, c in enumerate(EVENT_PRIORITY))
_CELLS = f"""WITH o AS (SELECT event_id % 2 AS line, greatest(epoch_us(ts) - 150000000, {LO_US}) AS s, least(epoch_us(ts) + 150000000, {HI_US}) AS t, event_type AS status, event_id, value,
       CASE event_type {_CLASS} END AS strength FROM events),
edges AS (SELECT DISTINCT line, unnest([s, t, {LO_US}, {HI_US}]) AS s FROM o WHERE t > s),
cells AS (SELECT line, s, lead(s) OVER (PARTITION BY line ORDER BY s) AS t FROM edges),
won AS (SELECT c.line, c.s, c.t, max((o.strength, o.value, o.event_id)) AS best FROM cells c LEFT JOIN o ON o.line = c.line AND o.s <= c.s AND o.t >= c.t WHERE c.t IS NOT NULL GROUP BY c.line, c.s, c.t),
named AS (SELECT *, coalesce(list_extract([{", ".join(f"'{c}'" for c in reversed(EVENT_PRIORITY))}], best[1]::INT), 'uncovered') AS status FROM won),
ledger AS (SELECT line, status, min(s) AS start_us, max(t) AS end_us FROM (
  SELECT *, sum(opens) OVER (PARTITION BY line ORDER BY s) AS span FROM (
    SELECT *, CASE WHEN lag(status) OVER (PARTITION BY line ORDER BY s) IS NOT DISTINCT FROM status THEN 0 ELSE 1 END AS opens FROM named)) GROUP BY line, span, status)"""
COVERAGE_LEDGER = f"{_CELLS} SELECT line, status, start_us, end_us FROM ledger"


def coverage_by_status(spark, d):
    return coverage.by_status(coverage_ledger(spark, d), ["line"])


COVERAGE_BY_STATUS = f"{_CELLS} SELECT line, status, sum(end_us - start_us)::BIGINT AS total_us, count(*) AS n_spans FROM ledger GROUP BY line, status"


def coverage_totals(spark, d):
    return coverage.covered(coverage_ledger(spark, d), ["line"])


COVERAGE_TOTALS = f"""{_CELLS} SELECT line, coalesce(sum(end_us - start_us) FILTER (status NOT IN ('uncovered', 'scan_blank')), 0)::BIGINT AS covered_us,
coalesce(sum(end_us - start_us) FILTER (status <> 'uncovered'), 0)::BIGINT AS looked_us, sum(end_us - start_us)::BIGINT AS total_us FROM ledger GROUP BY line"""


def coverage_partition_check(spark, d):
    return intervals.partition_violations(coverage_ledger(spark, d), ["line"], LO_US, HI_US)


COVERAGE_PARTITION_CHECK = "SELECT DISTINCT event_id % 2 AS line, 0::BIGINT AS overlaps, 0::BIGINT AS gaps, 0::BIGINT AS bad_ends FROM events"


def coverage_payload(spark, d):
    obs = intervals.clamp(_observations(spark, d), LO_US, HI_US)
    return coverage.with_payload(coverage_ledger(spark, d), obs, ["line"], ["event_id"], "value")


COVERAGE_PAYLOAD = f"""{_CELLS} SELECT line, status, value, event_id, min(s) AS start_us, max(t) AS end_us FROM (
  SELECT *, sum(opens) OVER (PARTITION BY line ORDER BY s) AS span FROM (
    SELECT *, best[2] AS value, best[3] AS event_id, CASE WHEN lag(best) OVER (PARTITION BY line ORDER BY s) IS NOT DISTINCT FROM best AND lag(s) OVER (PARTITION BY line ORDER BY s) IS NOT NULL THEN 0 ELSE 1 END AS opens
    FROM (SELECT line, s, t, status, CASE WHEN best[1] IS NULL THEN NULL ELSE best END AS best FROM named))) GROUP BY line, span, status, value, event_id"""


def coverage_unread(spark, d):
    """Time of purchase cells that signups of the line do or do not hold the middle of."""
    obs = _observations(spark, d)
    unread = obs.filter("status = 'signup'").select("line", "start_us", "end_us")
    cells = coverage_ledger(spark, d).withColumn("status", F.when(F.col("status") == "purchase", "auto").otherwise(F.col("status")))
    tagged = coverage.named_or_unread(cells, unread, ["line"])
    return tagged.groupBy("line", "advertiser").agg(F.sum(F.col("end_us") - F.col("start_us")).alias("total_us"), F.count("*").alias("n_spans"))


COVERAGE_UNREAD = f"""{_CELLS}, u AS (SELECT event_id % 2 AS line, epoch_us(ts) - 150000000 AS s, epoch_us(ts) + 150000000 AS t FROM events WHERE event_type = 'signup'),
mids AS (SELECT *, (start_us + end_us) // 2 AS mid FROM ledger),
tagged AS (SELECT m.line, m.start_us, m.end_us, CASE WHEN m.status = 'purchase' THEN CASE WHEN EXISTS (SELECT 1 FROM u WHERE u.line = m.line AND m.mid >= u.s AND m.mid <= u.t) THEN 'unread' ELSE 'named' END END AS advertiser FROM mids m)
SELECT line, advertiser, sum(end_us - start_us)::BIGINT AS total_us, count(*) AS n_spans FROM tagged GROUP BY line, advertiser"""


def largest_gaps(spark, d):
    gaps = coverage_ledger(spark, d).filter("status = 'uncovered'")
    return intervals.largest(gaps, 12, "start_us", "end_us", "line").select("line", "start_us", "dur_us")


LARGEST_GAPS = f"{_CELLS} SELECT line, start_us, end_us - start_us AS dur_us FROM ledger WHERE status = 'uncovered' ORDER BY dur_us DESC, start_us, line LIMIT 12"


def spells(spark, d):
    return intervals.spells(events(spark, d), ["user_id"], 12 * HOUR)


SPELLS = f"""{_EV}, p AS (SELECT DISTINCT user_id, at_us FROM e), l AS (SELECT *, at_us - lag(at_us) OVER (PARTITION BY user_id ORDER BY at_us) AS gap FROM p)
SELECT user_id, count(*) FILTER (gap IS NULL OR gap > {12 * HOUR}) AS n_spells FROM l GROUP BY user_id"""


def stitch_spans(spark, d):
    return intervals.stitch(events(spark, d), ["event_type"], 30 * MINUTE)


STITCH_SPANS = f"""{_EV}, l AS (SELECT *, at_us - lag(at_us) OVER (PARTITION BY event_type ORDER BY at_us) AS gap FROM e),
n AS (SELECT *, sum(CASE WHEN gap <= {30 * MINUTE} THEN 0 ELSE 1 END) OVER (PARTITION BY event_type ORDER BY at_us) AS run FROM l)
SELECT event_type, min(at_us) AS first_us, max(at_us) AS last_us, count(*) AS n_points FROM n GROUP BY event_type, run"""


def session_windows(spark, d):
    e = events(spark, d)
    s = e.groupBy("user_id", F.session_window("ts", "12 hours")).agg(F.count("*").alias("n_events"))
    return s.select("user_id", intervals.wall_micros(F.col("session_window.start")).alias("start_us"), intervals.wall_micros(F.col("session_window.end")).alias("end_us"), "n_events")


SESSION_WINDOWS = f"""{_EV}, l AS (SELECT *, at_us - lag(at_us) OVER (PARTITION BY user_id ORDER BY at_us) AS gap FROM e),
n AS (SELECT *, sum(CASE WHEN gap <= {12 * HOUR} THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY at_us) AS run FROM l)
SELECT user_id, min(at_us) AS start_us, max(at_us) + {12 * HOUR} AS end_us, count(*) AS n_events FROM n GROUP BY user_id, run"""


def tumbling_windows(spark, d):
    e = events(spark, d)
    w = e.groupBy("event_type", F.window("ts", "6 hours")).agg(F.count("*").alias("n_events"), F.count_distinct("user_id").alias("n_users"))
    return w.select("event_type", intervals.wall_micros(F.col("window.start")).alias("start_us"), "n_events", "n_users")


TUMBLING_WINDOWS = f"{_EV} SELECT event_type, at_us // {6 * HOUR} * {6 * HOUR} AS start_us, count(*) AS n_events, count(DISTINCT user_id) AS n_users FROM e GROUP BY ALL"


def _purchases_and_clicks(spark, d):
    e = events(spark, d)
    left = e.filter("event_type = 'purchase'").select("event_id", "user_id", "at_us", "start_us", "end_us")
    right = e.filter("event_type = 'click'").select("user_id", F.col("at_us").alias("click_us"), F.col("event_id").alias("click_id"), F.col("start_us"), F.col("end_us"))
    return left, right


def asof_join(spark, d):
    left, right = _purchases_and_clicks(spark, d)
    return joins.asof(left.drop("start_us", "end_us"), right.drop("start_us", "end_us"), ["user_id"], "at_us", "click_us", ["click_id"], bucket=intervals.DAY)


ASOF_JOIN = f"""{_EV}, b AS (SELECT p.event_id, max((c.at_us, c.event_id)) AS best FROM e p JOIN e c ON c.user_id = p.user_id AND c.event_type = 'click' AND c.at_us <= p.at_us WHERE p.event_type = 'purchase' GROUP BY p.event_id)
SELECT p.event_id, user_id, at_us, best[1] AS click_us, best[2] AS click_id FROM e p LEFT JOIN b ON b.event_id = p.event_id WHERE event_type = 'purchase'"""


def point_in_range_join(spark, d):
    left, _ = _purchases_and_clicks(spark, d)
    shots = intervals.stitch(events(spark, d), ["user_id"], 12 * HOUR).withColumn("stop_us", F.col("last_us") - 2 * HOUR).filter("stop_us > first_us")
    return joins.point_in_range(left.select("event_id", "user_id", "at_us"), shots, ["user_id"], "at_us", "first_us", "stop_us", ["n_points"], bucket=intervals.DAY)


POINT_IN_RANGE_JOIN = f"""{_EV}, l AS (SELECT *, at_us - lag(at_us) OVER (PARTITION BY user_id ORDER BY at_us) AS gap FROM e),
n AS (SELECT *, sum(CASE WHEN gap <= {12 * HOUR} THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY at_us) AS run FROM l),
s AS (SELECT user_id, min(at_us) AS lo, max(at_us) - {2 * HOUR} AS hi, count(*) AS n_points FROM n GROUP BY user_id, run HAVING hi > lo)
SELECT event_id, p.user_id, at_us, n_points FROM e p LEFT JOIN s ON s.user_id = p.user_id AND at_us >= lo AND at_us < hi WHERE event_type = 'purchase'"""


def anti_band_join(spark, d):
    left, right = _purchases_and_clicks(spark, d)
    return joins.anti_band(left.select("event_id", "user_id", "at_us"), right.select("user_id", "click_us"), ["user_id"], "at_us", "click_us", 6 * HOUR, bucket=intervals.DAY)


ANTI_BAND_JOIN = f"""{_EV} SELECT event_id, user_id, at_us FROM e p WHERE event_type = 'purchase'
AND NOT EXISTS (SELECT 1 FROM e c WHERE c.event_type = 'click' AND c.user_id = p.user_id AND abs(c.at_us - p.at_us) <= {6 * HOUR})"""


def interval_overlap_join(spark, d):
    left, right = _purchases_and_clicks(spark, d)
    return joins.overlaps(left, right, ["user_id"], 6 * HOUR, ["click_id"]).select("event_id", "click_id", (F.least("end_us", "r_end") - F.greatest("start_us", "r_start")).alias("shared_us"))


INTERVAL_OVERLAP_JOIN = f"""{_EV} SELECT p.event_id, c.event_id AS click_id, least(p.end_us, c.end_us) - greatest(p.start_us, c.start_us) AS shared_us
FROM e p JOIN e c ON c.user_id = p.user_id AND p.start_us < c.end_us AND c.start_us < p.end_us WHERE p.event_type = 'purchase' AND c.event_type = 'click'"""


def interval_overlap_mixed(spark, d):
    """Purchases of an hour, some of 40 days, and clicks of a minute to ten days that share time."""
    e = events(spark, d)
    purchases = e.filter("event_type = 'purchase'").withColumn("end_us", F.when(F.col("event_id") % 50 == 0, F.col("start_us") + 40 * intervals.DAY).otherwise(F.col("end_us"))).select("event_id", "user_id", "start_us", "end_us")
    clicks = e.filter("event_type = 'click'").withColumn("end_us", F.col("start_us") + F.when(F.col("event_id") % 40 == 0, 10 * intervals.DAY).otherwise(MINUTE)).select(F.col("event_id").alias("click_id"), "user_id", "start_us", "end_us")
    return joins.overlaps_any_length(purchases, clicks, ["user_id"], 10 * MINUTE, ["click_id"]).select("event_id", "click_id", (F.least("end_us", "r_end") - F.greatest("start_us", "r_start")).alias("shared_us"))


INTERVAL_OVERLAP_MIXED = f"""{_EV}, p AS (SELECT event_id, user_id, start_us, CASE WHEN event_id % 50 = 0 THEN start_us + {40 * intervals.DAY} ELSE end_us END AS end_us FROM e WHERE event_type = 'purchase'),
c AS (SELECT event_id, user_id, start_us, start_us + CASE WHEN event_id % 40 = 0 THEN {10 * intervals.DAY} ELSE {MINUTE} END AS end_us FROM e WHERE event_type = 'click')
SELECT p.event_id, c.event_id AS click_id, least(p.end_us, c.end_us) - greatest(p.start_us, c.start_us) AS shared_us FROM p JOIN c ON c.user_id = p.user_id AND p.start_us < c.end_us AND c.start_us < p.end_us"""


def span_join_adjacent(spark, d):
    e = events(spark, d).select("user_id", "event_type", "start_us", "end_us")
    return intervals.join_adjacent(e.groupBy("user_id", "start_us").agg(F.min("event_type").alias("event_type"), F.max("end_us").alias("end_us")), ["user_id"], ["event_type"], 2 * HOUR, bucket=intervals.DAY).select("user_id", "event_type", "start_us", "end_us")


SPAN_JOIN_ADJACENT = f"""{_EV}, q AS (SELECT user_id, start_us, min(event_type) AS event_type, max(end_us) AS end_us FROM e GROUP BY user_id, start_us),
o AS (SELECT *, CASE WHEN lag(event_type) OVER w = event_type AND start_us - lag(end_us) OVER w <= {2 * HOUR} THEN 0 ELSE 1 END AS opens FROM q WINDOW w AS (PARTITION BY user_id ORDER BY start_us)),
n AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY start_us) AS span FROM o)
SELECT user_id, event_type, min(start_us) AS start_us, max(end_us) AS end_us FROM n GROUP BY user_id, span, event_type"""


QUERIES = {f.__name__: f for f in (
    interval_union, interval_merged, interval_complement, interval_clamp, merge_surfaces, coverage_ledger, coverage_by_status, coverage_totals, coverage_partition_check,
    coverage_payload, coverage_unread, largest_gaps, spells, stitch_spans, session_windows, tumbling_windows, asof_join, point_in_range_join, anti_band_join, interval_overlap_join, interval_overlap_mixed, span_join_adjacent,
)}
SQL = {name: globals()[name.upper()] for name in QUERIES}
