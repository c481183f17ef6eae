import random
import shutil

import pytest
from pyspark.sql import functions as F

from dwellspan.operators import clusters, intervals, sequences
from dwellspan.streaming import stateful

HOUR = 3_600_000_000
SCHEMA = "k long, id long, ts timestamp, sev double, v array<double>, conf double"
BASE = 1_700_000_000_000_000


@pytest.fixture(scope="module", autouse=True)
def rocksdb(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    stateful.use_rocksdb(spark)
    yield
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def _rows():
    rnd = random.Random(3)
    rows, at = [], 0
    for i in range(240):
        at += rnd.choice([60, 600, 4000, 9000]) * 1_000_000
        v = [rnd.random() for _ in range(3)]
        rows.append((i % 3, i, BASE + at, rnd.choice([0.2, 1.5, 3.0, None]), rnd.choice([v, v, [x / sum(v) for x in v], None]), rnd.choice([None, rnd.random()])))
    return rows


def _files(spark, rows, path, parts):
    """Files of rows by time, each shuffled with its neighbours within the watermark."""
    rnd = random.Random(5)
    size = -(-len(rows) // parts)
    dealt = [[] for _ in range(parts)]
    for n, r in enumerate(rows):
        dealt[min(parts - 1, max(0, n // size + rnd.choice([0, 0, 1])))].append(r)
    for n, part in enumerate(dealt):
        rnd.shuffle(part)
        _write(spark, part, f"{path}/{n:03d}")


def _write(spark, rows, path):
    df = spark.createDataFrame(rows, SCHEMA.replace("ts timestamp", "ts long")).withColumn("ts", F.timestamp_micros("ts"))
    df.coalesce(1).write.parquet(path)


def _run(spark, path, tmp_path, name, make):
    """All files that are there now, from the last checkpoint on."""
    live = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(path).withWatermark("ts", "30 days")
    out = f"{tmp_path}/{name}-out"
    query = make(live).writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{tmp_path}/{name}-state").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination(300)
    assert query.exception() is None
    return spark.read.parquet(out), query


CASES = {
    "cuts": (lambda s: stateful.spaced_cuts(s, ["k"], "ts", "id", "sev", 2 * HOUR), lambda d: sequences.spaced_cuts(d, ["k"], "at_us", "sev", 2 * HOUR), "cut"),
    "kept": (lambda s: stateful.skip_similar(s, ["k"], "ts", "id", "v", 0.2), lambda d: sequences.skip_similar(d, ["k"], "at_us", "v", 0.2), "keep"),
    "clusters": (lambda s: stateful.leader_clusters(s, ["k"], "ts", "id", "v", "conf", 0.25), lambda d: clusters.leader_clusters(d, ["k"], "at_us", "v", "conf", 0.25), "cluster"),
}


@pytest.mark.parametrize("case", sorted(CASES))
def test_streams_equal_batches_over_a_restart(spark, tmp_path, case):
    make, batch, name = CASES[case]
    rows = _rows()
    path = f"{tmp_path}/in"
    _files(spark, rows[:120], path, 3)
    early, _ = _run(spark, path, tmp_path, case, make)
    seen = early.count()
    _files(spark, rows[120:], f"{path}/later", 2)
    _write(spark, [(0, -1, BASE + 10**15, None, None, None)], f"{path}/zlast")  # lets the watermark pass all rows
    got, _ = _run(spark, path, tmp_path, case, make)
    df = spark.createDataFrame(rows, SCHEMA.replace("ts timestamp", "at_us long"))
    expected = {r.id: r[name] for r in batch(df).collect()}
    assert {r.id: r[name] for r in got.collect() if r.id >= 0} == expected
    assert got.where("id >= 0").count() == len(expected) and seen <= len(expected)


def test_spells_end_with_the_watermark_and_state_goes(spark, tmp_path):
    rows = _rows()
    path = f"{tmp_path}/in"
    _files(spark, rows, path, 3)
    make = lambda s: stateful.spells(s, ["k"], "ts", 2 * HOUR)
    _write(spark, [(9, -1, BASE + 10**15, None, None, None)], f"{path}/zlast")
    got, query = _run(spark, path, tmp_path, "spells", make)
    df = spark.createDataFrame(rows, SCHEMA.replace("ts timestamp", "at_us long"))
    expected = {tuple(r) for r in intervals.stitch(df.select("k", "at_us"), ["k"], 2 * HOUR).collect()}
    assert {(r.k, r.first_us, r.last_us, r.n_points) for r in got.collect()} == expected
    # the spells and waiting rows of all keys but the last one's are gone
    state = spark.read.format("statestore").option("path", f"{tmp_path}/spells-state").option("stateVarName", "spell").load()
    assert state.count() == 0
    waiting = spark.read.format("statestore").option("path", f"{tmp_path}/spells-state").option("stateVarName", "waiting").load()
    assert {r[0] for r in waiting.select("key.k").distinct().collect()} == {9}


def test_what_was_kept_is_forgotten(spark, tmp_path):
    v = [0.5, 0.5]
    rows = [(1, n, BASE + n * HOUR, None, v, None) for n in range(6)] + [(1, 6, BASE + 100 * HOUR, None, v, None)]
    path = f"{tmp_path}/in"
    _write(spark, rows, f"{path}/0")
    _write(spark, [(2, -1, BASE + 10**15, None, v, None)], f"{path}/1")
    got, _ = _run(spark, path, tmp_path, "kept", lambda s: stateful.skip_similar(s, ["k"], "ts", "id", "v", 0.2, 10 * HOUR))
    assert [r.id for r in got.where("keep and k = 1").orderBy("id").collect()] == [0, 6]
    shutil.rmtree(f"{tmp_path}/kept-state")
