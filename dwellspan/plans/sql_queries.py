"""Queries written in SQL text, over temporary views and table functions."""

from __future__ import annotations

from .. import sql
from .feature_queries import _RATIOS
from .tables import table

#: A name with a letter changed, and a whole one, for each customer.
_TEXTS = """SELECT c_custkey % 4 AS part, true AS is_text, c_custkey AS id, concat(left(a.n_name, cast(c_custkey % 7 + 1 as int)), '#', substr(a.n_name, cast(c_custkey % 7 + 3 as int)), ' and ', b.n_name) AS text
FROM {customer} JOIN {nation} a ON c_nationkey = a.n_nationkey JOIN {nation} b ON c_custkey % 25 = b.n_nationkey"""
_LISTED = "SELECT part, false AS is_text, n_nationkey AS id, n_name AS text FROM {nation}, VALUES (0), (1), (2), (3) AS p(part)"


def sql_name_matches(spark, d):
    """All nations that a text of two may hold."""
    sql.register(spark)
    frames = {n: table(spark, d, n) for n in ("customer", "nation")}
    both = sql.query(spark, f"{_LISTED} UNION ALL {_TEXTS}", **frames)
    return sql.query(spark, "SELECT part, id, name, round(score, 6) AS score FROM name_matches(TABLE(SELECT part, is_text, id, text FROM {both}))", both=both)


_SPACED = "trim(regexp_replace(upper({}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
SQL_NAME_MATCHES = f"""WITH RECURSIVE texts AS (SELECT c_custkey % 4 AS part, c_custkey AS id, {_SPACED.format("left(a.n_name, (c_custkey % 7 + 1)::INT) || '#' || substr(a.n_name, (c_custkey % 7 + 3)::INT) || ' and ' || b.n_name")} AS x
FROM customer JOIN nation a ON c_nationkey = a.n_nationkey JOIN nation b ON c_custkey % 25 = b.n_nationkey),
listed AS (SELECT n_name AS name, {_SPACED.format("n_name")} AS norm, len(string_split({_SPACED.format("n_name")}, ' ')) AS words FROM nation),
held AS (SELECT DISTINCT x, string_split(x, ' ') AS w FROM texts),
parts AS (SELECT DISTINCT x, name, norm, unnest(list_concat([x], w, CASE WHEN words > 1 THEN list_transform(range(1, len(w) - words + 2), lambda i: array_to_string(w[i : i + words - 1], ' ')) ELSE [] END)) AS p FROM held, listed WHERE NOT contains(x, norm)),
pairs AS (SELECT DISTINCT norm AS t, p AS n FROM parts), {_RATIOS},
fits AS (SELECT x, name, norm, max(ratio) AS fit FROM parts JOIN ratios ON t = norm AND n = p GROUP BY ALL UNION ALL SELECT x, name, norm, 1.0 FROM held, listed WHERE contains(x, norm))
SELECT part, id, name, round(fit, 6) AS score FROM texts JOIN fits USING (x) WHERE fit >= CASE WHEN length(replace(norm, ' ', '')) <= 4 THEN 0.85 ELSE 0.65 END"""


def sql_name_search(spark, d):
    """Nations for what a customer may have typed."""
    sql.register(spark)
    frames = {n: table(spark, d, n) for n in ("customer", "nation")}
    typed = "SELECT c_custkey % 3 AS part, true AS is_text, c_custkey AS id, concat(' ', lower(substr(n_name, cast(c_custkey % 3 + 1 as int), cast(c_custkey % 4 + 2 as int)))) AS text FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey"
    listed = "SELECT part, false AS is_text, n_nationkey AS id, n_name AS text FROM {nation}, VALUES (0), (1), (2) AS p(part)"
    both = sql.query(spark, f"{listed} UNION ALL {typed}", **frames)
    return sql.query(spark, "SELECT part, id, cast(place as bigint) AS place, name FROM name_search(TABLE(SELECT part, is_text, id, text FROM {both}))", both=both)


SQL_NAME_SEARCH = f"""WITH RECURSIVE typed AS (SELECT c_custkey % 3 AS part, c_custkey AS id, trim(substr(n_name, (c_custkey % 3 + 1)::INT, (c_custkey % 4 + 2)::INT)) AS q FROM customer JOIN nation ON c_nationkey = n_nationkey),
pairs AS (SELECT DISTINCT q AS t, n_name AS n FROM typed, nation), {_RATIOS},
ranks AS (SELECT t, n, CASE WHEN starts_with(n, t) THEN 3 + length(t)::DOUBLE / length(n) WHEN contains(n, t) THEN 2 + length(t)::DOUBLE / length(n) ELSE ratio END AS r FROM ratios)
SELECT part, id, row_number() OVER (PARTITION BY part, id ORDER BY r DESC, n) AS place, n AS name FROM typed JOIN ranks ON t = q WHERE r >= 0.45"""


QUERIES = {f.__name__: f for f in (sql_name_matches, sql_name_search)}
SQL = {name: globals()[name.upper()] for name in QUERIES}
