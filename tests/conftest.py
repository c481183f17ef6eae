import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g").config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", "file://" + str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return DATA


@pytest.fixture(scope="session")
def duck(sf_dir):
    import duckdb

    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        c.execute(f"CREATE VIEW {t} AS FROM '{sf_dir}/{t}.parquet'")
    return c


def _plain(v):
    import numpy as np
    import pandas as pd

    if v is None or v is pd.NA or (isinstance(v, float) and np.isnan(v)):
        return "<null>"
    if isinstance(v, (bool, np.bool_)):
        return str(bool(v))
    if isinstance(v, (float, np.floating)):
        return repr(round(float(v), 6) + 0.0)
    return str(v)


def rows_of(df):
    """Rows of a pandas table as sorted text, columns by name."""
    df = df[sorted(df.columns)]
    for c in df:
        if str(df[c].dtype) in ("Int64", "Int32"):
            df = df.assign(**{c: df[c].astype("float64")})
        elif df[c].dtype.kind in "iu":
            df = df.assign(**{c: df[c].astype("float64")})
    return sorted(tuple(_plain(v) for v in r) for r in df.itertuples(index=False))


@pytest.fixture(scope="session")
def same(spark, sf_dir, duck):
    """Asserts that a query and its SQL give the same columns and rows."""

    def check(query, sql):
        ours, theirs = query(spark, sf_dir).toPandas(), duck.execute(sql).df()
        assert sorted(ours.columns) == sorted(theirs.columns)
        assert rows_of(ours) == rows_of(theirs)

    return check
