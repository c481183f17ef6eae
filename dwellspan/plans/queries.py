"""All queries of the exposure engine and the SQL that says the same."""

from . import exposure_queries, feature_queries, interval_queries, record_queries, sequence_queries, sketch_queries, sql_queries

_PARTS = (interval_queries, sequence_queries, exposure_queries, feature_queries, record_queries, sql_queries, sketch_queries)
QUERIES = {name: f for part in _PARTS for name, f in part.QUERIES.items()}
SQL = {name: sql for part in _PARTS for name, sql in part.SQL.items()}
