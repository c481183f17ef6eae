"""Geometry, vectors, rules, text and grouping over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions import rules, text, vectors
from ..operators import clusters, exposure, resolve
from .tables import events, long, rounded, table

W, H = 1920.0, 1080.0


def _boxes(spark, d):
    """A box for each order line, from its numbers."""
    line = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_partkey")
    x, y = (F.col("l_partkey") % 1900).cast("double"), (F.col("l_orderkey") % 1000).cast("double")
    return line.select("l_orderkey", long("l_linenumber"), x.alias("x"), y.alias("y"), (F.col("l_quantity") * 4).alias("w"), (F.col("l_quantity") + 10).alias("h"), "l_discount")


_BOXES = "WITH b AS (SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, (l_partkey % 1900)::DOUBLE AS x, (l_orderkey % 1000)::DOUBLE AS y, l_quantity * 4 AS w, l_quantity + 10 AS h, l_discount FROM lineitem)"


def polygon_metrics(spark, d):
    poly = geo.rectangle(F.col("x"), F.col("y"), F.col("x") + F.col("w"), F.col("y") + F.col("h"))
    rows = _boxes(spark, d).withColumn("poly", poly)
    c, b = geo.centroid(F.col("poly")), geo.bbox(F.col("poly"))
    return rows.select("l_orderkey", "l_linenumber", rounded(geo.area(F.col("poly")), "area_px"), rounded(c["x"], "cx"), rounded(c["y"], "cy"), rounded(b["x2"], "x2"), rounded(geo.centrality(F.col("poly"), F.lit(W), F.lit(H)), "centrality"))


POLYGON_METRICS = f"""{_BOXES} SELECT l_orderkey, l_linenumber, round(w * h, 6) AS area_px, round(x + w / 2, 6) AS cx, round(y + h / 2, 6) AS cy, round(x + w, 6) AS x2,
round(greatest(0, 1 - sqrt((x + w / 2 - {W / 2}) ** 2 + (y + h / 2 - {H / 2}) ** 2) / (sqrt({W}::DOUBLE ** 2 + {H}::DOUBLE ** 2) / 2)), 6) AS centrality FROM b"""


def surface_metrics(spark, d):
    """Panels of one order: summed area, centre weighted by area."""
    poly = geo.rectangle(F.col("x"), F.col("y"), F.col("x") + F.col("w"), F.col("y") + F.col("h"))
    grouped = _boxes(spark, d).groupBy("l_orderkey").agg(F.collect_list(poly).alias("polys"))
    s = geo.surface(F.col("polys"), F.lit(W), F.lit(H))
    return grouped.select("l_orderkey", s.alias("s")).select("l_orderkey", long("s.n_panels", "n_panels"), rounded("s.area_px", "area_px", 3), rounded("s.x", "x", 3), rounded("s.y", "y", 3), rounded("s.dist_center", "dist_center"))


SURFACE_METRICS = f"""{_BOXES}, g AS (SELECT l_orderkey, count(*) AS n_panels, sum(w * h) AS a, sum(w * h * (x + w / 2)) / sum(w * h) AS cx, sum(w * h * (y + h / 2)) / sum(w * h) AS cy FROM b GROUP BY l_orderkey)
SELECT l_orderkey, n_panels, round(a, 3) AS area_px, round(cx, 3) AS x, round(cy, 3) AS y, round(sqrt((cx - {W / 2}) ** 2 + (cy - {H / 2}) ** 2) / (sqrt({W}::DOUBLE ** 2 + {H}::DOUBLE ** 2) / 2), 6) AS dist_center FROM g"""


def frame_types(spark, d):
    o = table(spark, d, "orders")
    share = lambda k: (F.col("o_orderkey") * k % 101) / 100
    c = rules.frame_type(share(7), share(11), share(13), share(17), share(19) / 4, share(23))
    return o.select("o_orderkey", c.alias("c")).select("o_orderkey", F.col("c.label").alias("label"), rounded("c.confidence", "confidence"))


FRAME_TYPES = """WITH o AS (SELECT o_orderkey, (o_orderkey * 7 % 101) / 100.0::DOUBLE AS g, (o_orderkey * 11 % 101) / 100.0::DOUBLE AS gl, (o_orderkey * 13 % 101) / 100.0::DOUBLE AS s, (o_orderkey * 17 % 101) / 100.0::DOUBLE AS c, (o_orderkey * 19 % 101) / 400.0::DOUBLE AS k, (o_orderkey * 23 % 101) / 100.0::DOUBLE AS d FROM orders),
l AS (SELECT *, CASE WHEN s >= 0.45 AND gl >= 0.3 AND c < 0.55 THEN 'wide_play' WHEN (c >= 0.7 OR k >= 0.12) AND g < 0.3 THEN 'close' WHEN g < 0.12 AND s < 0.2 THEN 'other' ELSE 'medium' END AS label FROM o)
SELECT o_orderkey, label, round(greatest(0, least(1, CASE label WHEN 'wide_play' THEN least((s - 0.45) / 0.35, (gl - 0.3) / 0.4, (0.55 - c) / 0.35) WHEN 'close' THEN greatest((c - 0.7) / 0.3, (k - 0.12) / 0.2) WHEN 'other' THEN (0.12 - g) / 0.12 + d ELSE 0.3 END)), 6) AS confidence FROM l"""


def route_rules(spark, d):
    o = table(spark, d, "orders")
    label = F.when(F.col("o_orderkey") % 4 == 0, "medium").otherwise("wide_play")
    conf = F.when(F.col("o_orderkey") % 9 == 0, F.lit(None)).otherwise((F.col("o_orderkey") * 7 % 101) / 100)
    r = rules.route(label, (F.col("o_orderkey") * 11 % 101) / 100, conf, (F.col("o_orderkey") * 13 % 101) / 200)
    return o.select("o_orderkey", r.alias("r")).select("o_orderkey", "r.route", "r.reason")


ROUTE_RULES = """WITH o AS (SELECT o_orderkey, o_orderkey % 4 = 0 AS medium, (o_orderkey * 11 % 101) / 100.0::DOUBLE AS purity, CASE WHEN o_orderkey % 9 <> 0 THEN (o_orderkey * 7 % 101) / 100.0::DOUBLE END AS conf, (o_orderkey * 13 % 101) / 200.0::DOUBLE AS bad FROM orders),
r AS (SELECT o_orderkey, CASE WHEN medium THEN 'other type of shot' WHEN purity < 0.6 THEN 'unstable label' WHEN conf IS NULL THEN 'not probed' WHEN bad > 0.25 THEN 'reads badly in parts' WHEN conf < 0.55 THEN 'low confidence' ELSE 'main camera' END AS reason FROM o)
SELECT o_orderkey, CASE WHEN reason = 'main camera' THEN 'auto' ELSE 'review' END AS route, reason FROM r"""


def band_confidence(spark, d):
    line = table(spark, d, "lineitem")
    m = {"span_ratio": F.col("l_quantity") / 50, "fit_resid": F.col("l_discount") * 5, "slope_deg": F.col("l_quantity") / 4, "bridged_frac": F.col("l_tax") * 3, "boundary_y": F.col("l_tax") * 4, "grass_below": 1 - F.col("l_discount") * 6, "band_grass": F.col("l_discount") * 4}
    sev = rules.change_severity(F.col("l_discount"), F.col("l_tax"), F.col("l_discount") * F.col("l_tax"))
    return line.select("l_orderkey", long("l_linenumber"), rounded(rules.band_confidence(m), "confidence"), rounded(sev, "severity"), rules.may_carry(sev).alias("carry"))


BAND_CONFIDENCE = """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, round(greatest(0, least(1, 1 - 2 * greatest(0, 0.72 - l_quantity / 50) - 2 * greatest(0, l_discount * 5 - 0.25) - 0.05 * greatest(0, l_quantity / 4 - 8) - 2 * greatest(0, l_tax * 3 - 0.15)
- 3 * greatest(0, l_tax * 4 - 0.24) - 1.5 * greatest(0, 0.5 - (1 - l_discount * 6)) - 2.5 * greatest(0, l_discount * 4 - 0.35))), 6) AS confidence,
round(greatest(l_discount / 0.25, l_tax / 0.12, l_discount * l_tax / 0.042), 6) AS severity, greatest(l_discount / 0.25, l_tax / 0.12, l_discount * l_tax / 0.042) < 2 AS carry FROM lineitem"""


def cost_plan(spark, d):
    """Texts as calls, with their tokens and price."""
    prices = {"small": (1.0, 5.0), "large": (5.0, 25.0)}
    docs = table(spark, d, "documents")
    model = F.when(F.col("doc_id") % 2 == 0, "small").otherwise("unknown")
    tokens = rules.call_tokens(F.lit(640), F.lit(360), F.col("n_chars"))
    p = rules.price(model, prices)
    return docs.select("doc_id", long(tokens, "tokens"), rounded(tokens / 1e6 * p["input"] + 150 / 1e6 * p["output"], "cost", 9))


COST_PLAN = """WITH t AS (SELECT doc_id, (floor(640 * 360 / 750.0) + floor(n_chars / 4.0))::BIGINT AS tokens FROM documents)
SELECT doc_id, tokens, round(tokens / 1e6::DOUBLE * CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 5 END + 150 / 1e6::DOUBLE * CASE WHEN doc_id % 2 = 0 THEN 5 ELSE 25 END, 9) AS cost FROM t"""


def vector_distances(spark, d):
    """Distances of neighbours, with shares of squares as histograms."""
    v = table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double") * x).alias("h"), "embedding")
    pairs = v.join(v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("h").alias("h2"), F.col("embedding").alias("e2")), "vec_id")
    h, h2, e, e2 = F.col("h"), F.col("h2"), F.col("embedding"), F.col("e2")
    return pairs.select("vec_id", rounded(vectors.bhattacharyya(h, h2), "bhattacharyya"), rounded(vectors.mean_abs_diff(e, e2), "mad"), rounded(vectors.strip_distance(h, h2, e, e2), "strip"), rounded(vectors.frame_distance(h, h2, e, e2), "frame"), rounded(vectors.dot(vectors.l2_normalised(e), vectors.l2_normalised(e2)), "cosine"))


VECTOR_DISTANCES = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings), p AS (SELECT a.vec_id, list_zip(a.e, b.e) AS z FROM v a JOIN v b ON b.vec_id = a.vec_id + 1),
m AS (SELECT vec_id, 1 - list_sum(list_transform(z, lambda x: abs(x[1] * x[2]))) AS bh, list_sum(list_transform(z, lambda x: abs(x[1] - x[2]))) / len(z) AS mad, list_sum(list_transform(z, lambda x: abs(x[1] * x[1] - x[2] * x[2]))) / 2 AS l1, list_sum(list_transform(z, lambda x: x[1] * x[2]))
/ sqrt(list_sum(list_transform(z, lambda x: x[1] * x[1]))) / sqrt(list_sum(list_transform(z, lambda x: x[2] * x[2]))) AS cos FROM p)
SELECT vec_id, round(bh, 6) AS bhattacharyya, round(mad, 6) AS mad, round(0.75 * bh + 0.25 * least(4 * mad, 1), 6) AS strip, round(0.6 * l1 + 0.4 * least(1, mad / 4), 6) AS frame, round(cos, 6) AS cosine FROM m"""


def temporal_mad(spark, d):
    return exposure.temporal_mad(table(spark, d, "embeddings"), "embedding").select(long("pos"), rounded("median"), rounded("mad"))


_MAD = """WITH f AS (SELECT vec_id, unnest(range(len(embedding))) AS pos, unnest(list_transform(embedding, lambda x: x::DOUBLE)) AS v FROM embeddings), m AS (SELECT pos, median(v) AS med FROM f GROUP BY pos),
a AS (SELECT pos, max(med) AS median, median(abs(v - med)) AS mad FROM f JOIN m USING (pos) GROUP BY pos)"""
TEMPORAL_MAD = f"{_MAD} SELECT pos, round(median, 6) AS median, round(mad, 6) AS mad FROM a"


def overlay_verdict(spark, d):
    v = table(spark, d, "embeddings")
    mad = exposure.temporal_mad(v, "embedding")
    return exposure.overlay_verdict(mad.crossJoin(v.agg(F.count("*").alias("frames"))), F.max("frames"), 0.07, min_scene=0.05).select("ok", "reason", "n_static")


OVERLAY_VERDICT = f"""{_MAD}, s AS (SELECT count(*) FILTER (mad <= 0.07) AS n, count(*) AS total, quantile_cont(mad, 0.9) AS p FROM a),
r AS (SELECT n, CASE WHEN (SELECT count(*) FROM embeddings) < 8 THEN 'too few frames' WHEN p < 0.05 THEN 'the scene does not change' WHEN n::DOUBLE / total > 0.25 THEN 'too much would be masked' END AS reason FROM s)
SELECT reason IS NULL AS ok, reason, CASE WHEN reason IS NULL THEN n ELSE 0 END AS n_static FROM r"""


def medoid_per_label(spark, d):
    return exposure.medoids(table(spark, d, "embeddings"), "label", "vec_id", "embedding").select(long("label"), "vec_id", rounded("distance"))


MEDOID_PER_LABEL = """WITH f AS (SELECT label, vec_id, unnest(range(len(embedding))) AS pos, unnest(list_transform(embedding, lambda x: x::DOUBLE)) AS v FROM embeddings), m AS (SELECT label, pos, avg(v) AS a FROM f GROUP BY ALL),
s AS (SELECT label, vec_id, round(sqrt(sum((v - a) ** 2)), 9) AS dist FROM f JOIN m USING (label, pos) GROUP BY label, vec_id)
SELECT label::BIGINT AS label, arg_min(vec_id, (dist, vec_id)) AS vec_id, round(min(dist), 6) AS distance FROM s GROUP BY label"""


def cluster_sizes(spark, d):
    sizes = table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("size"))
    return exposure.upper_median(sizes, "size")


CLUSTER_SIZES = "WITH s AS (SELECT count(*) AS size FROM orders GROUP BY o_custkey) SELECT count(*) AS n, max(size) AS largest, list_sort(list(size))[count(*) // 2 + 1] AS median, count(*) FILTER (size = 1) AS singletons FROM s"


def drift_bands(spark, d):
    rows = table(spark, d, "lineitem").select((F.col("l_extendedprice") / 1000).alias("drift"), (F.col("l_quantity") / 50).alias("conf"))
    out = exposure.drift_bands(rows, "drift", "conf")
    return out.select(long("band"), "n", rounded("median_drift"), rounded("p90_drift"), rounded("max_drift"))


DRIFT_BANDS = """WITH r AS (SELECT l_extendedprice / 1000 AS drift, l_quantity / 50 AS conf FROM lineitem)
SELECT CASE WHEN conf < 0.35 THEN 0 WHEN conf < 0.6 THEN 1 WHEN conf < 0.8 THEN 2 ELSE 3 END::BIGINT AS band, count(*) AS n, round(median(drift), 6) AS median_drift, round(quantile_cont(drift, 0.9), 6) AS p90_drift, round(max(drift), 6) AS max_drift FROM r GROUP BY ALL"""


def normalised_names(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", text.norm_alnum(F.col("p_name")).alias("alnum"), text.norm_spaced(F.concat_ws(" - ", "p_name", "p_type")).alias("spaced"), rounded(text.digit_share(text.norm_alnum(F.concat("p_brand", F.col("p_partkey").cast("string")))), "digits"))


NORMALISED_NAMES = r"""SELECT p_partkey, regexp_replace(upper(p_name), '[^\p{L}\p{N}]', '', 'g') AS alnum, trim(regexp_replace(upper(p_name || ' - ' || p_type), '[^\p{L}\p{N}]+', ' ', 'g')) AS spaced,
round(length(regexp_replace(p_brand || p_partkey, '[^0-9]', '', 'g'))::DOUBLE / length(regexp_replace(upper(p_brand || p_partkey), '[^\p{L}\p{N}]', '', 'g')), 6) AS digits FROM part"""


def normalised_documents(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(text.norm_alnum(F.col("text"))).alias("norm_md5"))


NORMALISED_DOCUMENTS = r"SELECT doc_id, md5(regexp_replace(upper(replace(text, 'ß', 'SS')), '[^\p{L}\p{N}]', '', 'g')) AS norm_md5 FROM documents"


def report_texts(spark, d):
    s = F.col("o_totalprice") / 1000
    o = table(spark, d, "orders")
    return o.select("o_orderkey", text.mmss(F.floor(s)).alias("mmss"), text.distance_label(F.col("o_orderkey") % 10 / 10).alias("label"), text.plural(F.col("o_orderkey"), "one", "few", "many").alias("form"), text.truthy(F.when(F.col("o_orderkey") % 5 == 0, "Yes").when(F.col("o_orderkey") % 5 == 1, " ").when(F.col("o_orderkey") % 5 == 2, "no").when(F.col("o_orderkey") % 5 == 3, "0")).alias("flag"))


REPORT_TEXTS = """SELECT o_orderkey, printf('%02d:%02d', floor(o_totalprice / 1000)::BIGINT // 60, floor(o_totalprice / 1000)::BIGINT % 60) AS mmss, CASE WHEN o_orderkey % 10 / 10.0 < 0.35 THEN 'centre' WHEN o_orderkey % 10 / 10.0 < 0.6 THEN 'middle' ELSE 'edge' END AS label,
CASE WHEN o_orderkey % 10 = 1 AND o_orderkey % 100 <> 11 THEN 'one' WHEN o_orderkey % 10 BETWEEN 2 AND 4 AND o_orderkey % 100 NOT BETWEEN 12 AND 14 THEN 'few' ELSE 'many' END AS form, o_orderkey % 5 NOT IN (2, 3) AS flag FROM orders"""


def leader_clusters(spark, d):
    v = table(spark, d, "embeddings").select("label", "vec_id", F.transform("embedding", lambda x: x.cast("double") * x).alias("hist"), (F.col("vec_id") % 17 / 17).alias("conf"))
    out = clusters.leader_clusters(v, ["label"], "vec_id", "hist", "conf", 0.55)
    return clusters.cluster_summary(out, ["label"], "vec_id", 0.25)


LEADER_CLUSTERS = """WITH RECURSIVE v AS (SELECT label, vec_id, list_transform(embedding, lambda x: x::DOUBLE * x) AS h, vec_id % 17 / 17.0::DOUBLE AS conf, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS k FROM embeddings),
r AS (SELECT label, k, vec_id, 1 AS cluster, [h] AS reps, [conf] AS confs FROM v WHERE k = 1
UNION ALL SELECT label, k, vec_id, CASE WHEN near THEN spot ELSE len(reps) + 1 END, CASE WHEN NOT near THEN list_append(reps, h) WHEN conf > confs[spot] THEN list_concat(list_append(reps[:spot - 1], h), reps[spot + 1:]) ELSE reps END,
CASE WHEN NOT near THEN list_append(confs, conf) WHEN conf > confs[spot] THEN list_concat(list_append(confs[:spot - 1], conf), confs[spot + 1:]) ELSE confs END
FROM (SELECT *, list_min(ds) < 0.55 AS near, list_position(ds, list_min(ds)) AS spot FROM (SELECT v.*, r.reps, r.confs, list_transform(r.reps, lambda q: list_sum(list_transform(list_zip(q, v.h), lambda z: abs(z[1] - z[2]))) / 2) AS ds FROM r JOIN v ON v.label = r.label AND v.k = r.k + 1))),
c AS (SELECT label, cluster, count(*) AS n_frames, min(vec_id) AS t_first, max(vec_id) AS t_last FROM r GROUP BY label, cluster)
SELECT label, n_frames, t_first, t_last, row_number() OVER (PARTITION BY label ORDER BY n_frames DESC, cluster) - 1 AS creative, round(n_frames * 0.25::DOUBLE, 2) AS seconds FROM c"""


def nms(spark, d):
    """Boxes of sixteen orders as a picture each."""
    boxes = _boxes(spark, d).withColumn("score", F.col("l_discount"))
    return clusters.suppress(boxes.select(F.floor(F.col("l_orderkey") / 16).alias("frame"), "x", "y", "w", "h", "score"), ["frame"])


NMS = f"""WITH RECURSIVE {_BOXES.removeprefix("WITH ")}, o AS (SELECT l_orderkey // 16 AS frame, x, y, w, h, l_discount AS score, row_number() OVER (PARTITION BY l_orderkey // 16 ORDER BY l_discount DESC, x, y, w, h) AS k FROM b),
r AS (SELECT *, true AS kept, [{{'x': x, 'y': y, 'w': w, 'h': h}}] AS held FROM o WHERE k = 1
UNION ALL SELECT frame, x, y, w, h, score, k, free, CASE WHEN free THEN list_append(held, {{'x': x, 'y': y, 'w': w, 'h': h}}) ELSE held END
FROM (SELECT o.*, r.held, len(list_filter(r.held, lambda q: abs(q.x - o.x) < 0.5 * greatest(q.w, o.w) AND abs(q.y - o.y) < 0.5 * greatest(q.h, o.h))) = 0 AS free FROM r JOIN o ON o.frame = r.frame AND o.k = r.k + 1))
SELECT frame, x, y, w, h, score FROM r WHERE kept"""


def _names(spark, d):
    return resolve.name_index(table(spark, d, "nation").select(F.col("n_name").alias("name"), F.array(F.concat(F.lit("REPUBLIC OF "), F.col("n_name"))).alias("aliases")))


def name_resolution(spark, d):
    """Nation names with a letter lost or doubled, resolved to the list."""
    c = table(spark, d, "customer").join(F.broadcast(table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    spoilt = F.when(F.col("c_custkey") % 3 == 0, F.col("n_name")).otherwise(F.concat(F.expr("left(n_name, cast(c_custkey % 7 + 1 as int))"), F.substring("n_name", 1, 1), F.expr("substr(n_name, cast(c_custkey % 7 + 3 as int))")))
    return resolve.resolve(c.select("c_custkey", spoilt.alias("token")), _names(spark, d)).select("c_custkey", "token", "name", rounded("match"))


#: Similarity of all pairs (t, n): the longest common block, the earliest of equal ones, and the same to both sides of it.
_RATIOS = """steps AS (SELECT t, n, t AS a, n AS b, 0::BIGINT AS got FROM pairs
UNION ALL SELECT t, n, part.a, part.b, part.got FROM (SELECT t, n, unnest([{'a': substr(a, 1, i - 1), 'b': substr(b, 1, j - 1), 'got': l}, {'a': substr(a, i + l), 'b': substr(b, j + l), 'got': 0}]) AS part
FROM (SELECT *, instr(b, substr(a, i, l)) AS j FROM (SELECT *, list_position(longest, l) AS i FROM (SELECT *, list_max(longest) AS l
FROM (SELECT *, list_transform(range(1, length(a) + 1), lambda i: coalesce(list_max(list_filter(range(1, length(a) - i + 2), lambda l: contains(b, substr(a, i, l)))), 0)) AS longest FROM steps WHERE a <> '' AND b <> '')) WHERE l > 0)))),
ratios AS (SELECT t, n, 2 * sum(got)::DOUBLE / (length(t) + length(n)) AS ratio FROM steps GROUP BY t, n)"""
_SPELLED = "spelled AS (SELECT n_name AS name, regexp_replace(upper(unnest([n_name, 'REPUBLIC OF ' || n_name])), '[^\\p{L}\\p{N}]', '', 'g') AS n FROM nation)"
NAME_RESOLUTION = f"""WITH RECURSIVE c AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN n_name ELSE left(n_name, (c_custkey % 7 + 1)::INT) || substr(n_name, 1, 1) || substr(n_name, (c_custkey % 7 + 3)::INT) END AS token FROM customer JOIN nation ON c_nationkey = n_nationkey),
k AS (SELECT *, regexp_replace(upper(token), '[^\\p{{L}}\\p{{N}}]', '', 'g') AS t FROM c), {_SPELLED}, pairs AS (SELECT DISTINCT t, n FROM k, spelled WHERE t NOT IN (SELECT n FROM spelled) AND length(t) >= 3), {_RATIOS},
fits AS (SELECT t, name, max(CASE WHEN (contains(n, t) OR contains(t, n)) AND length(t) >= 6 AND length(t) >= 0.6 * length(n) THEN greatest(ratio, 0.86) ELSE ratio END) AS fit FROM ratios JOIN spelled USING (n) GROUP BY t, name),
best AS (SELECT t, max(fit) AS fit, arg_max(name, fit) AS name, list_sort(list(fit), 'DESC')[2] AS second FROM fits GROUP BY t)
SELECT c_custkey, token, CASE WHEN e.name IS NOT NULL THEN e.name WHEN fit >= 0.62 AND fit - second >= 0.03 THEN best.name END AS name, CASE WHEN e.name IS NOT NULL THEN 1 ELSE round(coalesce(fit, 0), 6) END AS match
FROM k LEFT JOIN spelled e ON e.n = k.t LEFT JOIN best ON best.t = k.t"""


def unknown_names(spark, d):
    """Recurring words of part names that no nation fits."""
    p = table(spark, d, "part")
    hits = p.select((F.col("p_size") % 4).alias("run"), F.explode(F.split("p_name", " ")).alias("text"), (F.col("p_retailprice") % 100 / 100).alias("conf"), F.col("p_partkey").alias("frame"), F.lit(0.5).alias("seconds"))
    hits = hits.withColumn("norm", text.norm_name(F.col("text"))).filter("norm <> ''")
    return resolve.unknown_clusters(hits, ["run"], _names(spark, d), min_conf=0.3).select(long("run"), "name", "norm", rounded("seconds"), "frames", rounded("mean_conf"), rounded("sim_to_listed"), "promoted", F.concat_ws(",", "rejected_for").alias("rejected_for"))


UNKNOWN_NAMES = f"""WITH RECURSIVE hits AS (SELECT run, text, regexp_replace(upper(text), '[^\\p{{L}}\\p{{N}}]', '', 'g') AS norm, conf, frame FROM (SELECT (p_size % 4)::BIGINT AS run, unnest(string_split(p_name, ' ')) AS text, p_retailprice % 100 / 100 AS conf, p_partkey AS frame FROM part)),
words AS (SELECT DISTINCT norm AS t FROM hits WHERE norm <> ''), {_SPELLED}, pairs AS (SELECT t, n FROM words, (SELECT n FROM spelled UNION SELECT t FROM words)), {_RATIOS},
near AS (SELECT t, n, greatest(ratio, CASE WHEN contains(n, t) OR contains(t, n) THEN 0.88 ELSE 0 END) AS fit FROM ratios),
fits AS (SELECT t, map(list(n), list(fit)) AS fit FROM near WHERE n IN (SELECT t FROM words) GROUP BY t), listed AS (SELECT t, max(fit) AS sim FROM near WHERE n IN (SELECT n FROM spelled) GROUP BY t),
turn AS (SELECT run, norm, fit, row_number() OVER (PARTITION BY run ORDER BY c DESC, norm) AS k FROM (SELECT run, norm, max(conf) AS c FROM hits WHERE norm <> '' GROUP BY run, norm) JOIN fits ON t = norm),
led AS (SELECT run, k, norm, norm AS lead, [norm] AS heads FROM turn WHERE k = 1
UNION ALL SELECT run, k, norm, CASE WHEN list_max(ds) >= 0.75 THEN heads[list_position(ds, list_max(ds))] ELSE norm END, CASE WHEN list_max(ds) >= 0.75 THEN heads ELSE list_append(heads, norm) END
FROM (SELECT turn.run, turn.k, turn.norm, led.heads, list_transform(led.heads, lambda q: turn.fit[q]) AS ds FROM led JOIN turn ON turn.run = led.run AND turn.k = led.k + 1)),
h AS (SELECT hits.*, lead FROM hits JOIN led USING (run, norm)), f AS (SELECT run, lead, count(DISTINCT frame) AS frames, avg(conf) AS mean_conf FROM h GROUP BY run, lead),
s AS (SELECT run, lead, arg_max(text, (n, c, text)) AS name FROM (SELECT run, lead, text, count(*) AS n, max(conf) AS c FROM h GROUP BY ALL) GROUP BY run, lead),
j AS (SELECT run, name, lead AS norm, frames * 0.5::DOUBLE AS seconds, frames, mean_conf, sim FROM f JOIN s USING (run, lead) JOIN listed ON t = regexp_replace(upper(name), '[^\\p{{L}}\\p{{N}}]', '', 'g')),
w AS (SELECT *, concat_ws(',', CASE WHEN seconds < 1 OR frames < 4 THEN 'too brief' END, CASE WHEN length(norm) < 4 THEN 'too short' END, CASE WHEN mean_conf < 0.3 THEN 'low confidence' END, CASE WHEN sim >= 0.45 THEN 'like a listed name' END) AS rejected_for FROM j)
SELECT run, name, norm, round(seconds, 6) AS seconds, frames, round(mean_conf, 6) AS mean_conf, round(sim, 6) AS sim_to_listed, rejected_for = '' AS promoted, rejected_for FROM w"""


_K, _BATCHES, _EPOCHS, _SCALE = 10, 4, 2, 65536


def kmeans_clusters(spark, d):
    """Mini-batch clusters of vectors."""
    out = clusters.minibatch_kmeans(table(spark, d, "embeddings"), "vec_id", "embedding", _K, _BATCHES, _EPOCHS, scale=_SCALE)
    return out.select("vec_id", long("cluster"), "distance")


def _batches_sql() -> str:
    """Each batch reads the centres that the one before left, with how many rows each has had."""
    near = "SELECT k.vec_id, k.v, min({{'d': list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT, 'c': c.c}}) AS near FROM kept k CROSS JOIN c{n} c {where} GROUP BY ALL"
    out = [f"c0 AS (SELECT row_number() OVER (ORDER BY md5('0:' || vec_id), v) - 1 AS c, v, 0::HUGEINT AS seen FROM kept ORDER BY md5('0:' || vec_id), v LIMIT {_K})"]
    for n in range(_BATCHES * _EPOCHS):
        out.append(f"""c{n + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.v, c.v) AS v, c.seen + coalesce(m.m, 0) AS seen FROM c{n} c LEFT JOIN (
  SELECT c, any_value(m) AS m, list((x + (s - m * x - (((s - m * x) % seen + seen) % seen)) // seen)::BIGINT ORDER BY i) AS v FROM (
    SELECT a.near.c AS c, i, any_value(c.v[i])::HUGEINT AS x, sum(a.v[i])::HUGEINT AS s, count(*)::HUGEINT AS m, any_value(c.seen) + count(*) AS seen
    FROM ({near.format(n=n, where=f"WHERE k.batch = {n % _BATCHES}")}) a JOIN c{n} c ON c.c = a.near.c, range(1, 65) r(i) GROUP BY a.near.c, i) GROUP BY c) m ON m.c = c.c)""")
    return ",\n".join([*out, f"a AS ({near.format(n=_BATCHES * _EPOCHS, where='')})"])


KMEANS_CLUSTERS = f"""WITH kept AS MATERIALIZED (SELECT vec_id, ('0x' || substr(md5('0:' || vec_id), 1, 8))::BIGINT % {_BATCHES} AS batch, list_transform(embedding, lambda x: floor(x::DOUBLE * {_SCALE})::BIGINT) AS v FROM embeddings),
{_batches_sql()}
SELECT vec_id, near.c AS cluster, near.d AS distance FROM a"""


def qa_sample(spark, d):
    """A twentieth of shots, drawn by digest."""
    u = F.conv(F.substring(F.md5(F.col("event_id").cast("string")), 1, 8), 16, 10).cast("double") / float(2**32)
    return events(spark, d).filter(u < 0.05).select("event_id")


QA_SAMPLE = "SELECT event_id FROM events WHERE ('0x' || substr(md5(event_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0::DOUBLE < 0.05"


QUERIES = {f.__name__: f for f in (
    polygon_metrics, surface_metrics, frame_types, route_rules, band_confidence, cost_plan, vector_distances, temporal_mad, overlay_verdict, medoid_per_label, cluster_sizes, drift_bands, normalised_names,
    normalised_documents, report_texts, leader_clusters, nms, name_resolution, unknown_names, kmeans_clusters, qa_sample,
)}
SQL = {name: globals()[name.upper()] for name in QUERIES if name.upper() in globals()}
