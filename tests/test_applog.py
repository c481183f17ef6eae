import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dwellspan.sources import applog
from dwellspan.sources.schemas import DDL

READINGS = DDL["readings"]


def _rows(spark, lo, hi):
    return spark.range(lo, hi).select(F.col("id").cast("int").alias("gid"), F.array(F.concat(F.lit("Ä\n"), F.col("id"))).alias("brands"), F.lit("me").alias("by"), F.lit("2024-01-01").cast("timestamp_ntz").alias("at"), F.lit(None).cast("string").alias("note"))


def test_round_trip_and_empty_writes(spark, tmp_path):
    path = f"{tmp_path}/log"
    assert applog.read(spark, path, READINGS).count() == 0
    applog.append(_rows(spark, 0, 50).repartition(3), path)
    applog.append(_rows(spark, 0, 0), path)
    applog.append(_rows(spark, 50, 60), f"file://{path}")
    got = applog.read(spark, path, READINGS)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, _rows(spark, 0, 60).collect()))
    assert len(os.listdir(f"{path}/commits")) == 3


def test_a_failing_task_leaves_no_row(spark, tmp_path):
    path = f"{tmp_path}/log"
    applog.append(_rows(spark, 0, 10), path)
    broken = _rows(spark, 10, 400).repartition(4).withColumn("note", F.when(F.col("gid") == 399, F.raise_error(F.lit("no"))).otherwise(F.lit("x")))
    with pytest.raises(Exception, match="no"):
        applog.append(broken, path)
    assert applog.read(spark, path, READINGS).count() == 10
    applog.vacuum(path, 0)
    assert sorted(os.listdir(f"{path}/data")) == sorted(f.rsplit("/", 1)[1] for f in applog.committed(path))


def _batch(*lines):
    return iter([pa.RecordBatch.from_arrays([pa.array(lines)], ["value"])])


def test_a_task_that_runs_twice_counts_once(spark, tmp_path):
    path = f"{tmp_path}/log"
    writer = applog.LogSource({"path": path}).writer(None, False)
    first, again, other = writer.write(_batch('{"gid": 1}')), writer.write(_batch('{"gid": 1}')), writer.write(_batch('{"gid": 2}', None))
    assert applog.read(spark, path, READINGS).count() == 0  # nothing is visible before the commit
    writer.commit([again, other, None])
    assert sorted(r.gid for r in applog.read(spark, path, READINGS).collect()) == [1, 2]
    assert applog.vacuum(path) == 0 and applog.vacuum(path, 0) == 1 and not os.path.exists(f"{path}/data/{first.file}")
    lost = writer.write(_batch('{"gid": 3}'))
    writer.abort([lost, None])
    assert not os.path.exists(f"{path}/data/{lost.file}")


def test_writers_that_commit_at_once_keep_all_rows(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    path = f"{tmp_path}/log"

    def one(n):
        writer = applog.LogSource({"path": path}).writer(None, False)
        writer.commit([writer.write(_batch(f'{{"gid": {n}}}'))])

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(one, range(40)))
    assert sorted(r.gid for r in applog.read(spark, path, READINGS).collect()) == list(range(40))


def test_a_replayed_batch_adds_nothing(spark, tmp_path):
    path = f"{tmp_path}/log"
    writer = applog.LogSource({"path": path, "query": "q"}).streamWriter(None, False)
    writer.commit([writer.write(_batch('{"gid": 1}'))], 7)
    writer.commit([writer.write(_batch('{"gid": 1}'))], 7)
    writer.commit([writer.write(_batch('{"gid": 2}'))], 8)
    assert sorted(r.gid for r in applog.read(spark, path, READINGS).collect()) == [1, 2]
    assert len(os.listdir(f"{path}/data")) == 2


@pytest.mark.parametrize("span", [7, 1000])
def test_every_line_is_read_once_wherever_it_is_cut(spark, tmp_path, span):
    folder, out = tmp_path / "in", f"{tmp_path}/out"
    folder.mkdir()
    text = "".join(f'{{"gid": {n}, "note": "{"é" * (n % 9)}"}}\n' for n in range(60)).encode()
    rnd, at = random.Random(span), 0
    live = applog.tail(spark, str(folder), READINGS, span=span).select("gid", "note")
    for turn in range(5):
        cut = len(text) if turn == 4 else min(len(text), at + rnd.randrange(0, 700))
        with open(folder / "a.jsonl", "ab") as f:
            f.write(text[at:cut])
        at = cut
        (folder / f"other{turn}.jsonl").write_text(f'{{"gid": {1000 + turn}}}\r\n\n{{"gid": {2000 + turn}}}')  # its last line never ends
        (folder / "ignored.txt").write_text("x\n")
        query = applog.append_stream(live, out, "follow", f"{tmp_path}/state").trigger(availableNow=True).start()
        query.awaitTermination(200)
        assert query.exception() is None
        whole = text[:cut].count(b"\n")
        got = sorted((r.gid, r.note) for r in applog.read(spark, out, READINGS).collect())
        assert got == [(n, "é" * (n % 9)) for n in range(whole)] + [(1000 + k, None) for k in range(turn + 1)]


def test_a_file_that_shrinks_is_an_error(tmp_path):
    (tmp_path / "a.jsonl").write_text('{"gid": 1}\n')
    reader = applog.TailSource({"path": str(tmp_path)}).streamReader(None)
    assert reader.latestOffset() == {"a.jsonl": 11}
    with pytest.raises(ValueError, match="shorter"):
        reader.partitions({"a.jsonl": 12}, reader.latestOffset())
    with pytest.raises(ValueError, match="shared file system"):
        applog.committed("s3://x/y")


def test_upserts_replace_all_or_nothing(spark, tmp_path):
    path, schema = f"{tmp_path}/log", "run string, stage string, created int, v string"
    rows = lambda *r: spark.createDataFrame(list(r), schema)
    applog.upsert(rows(("r", "a", 1, "x"), ("r", "b", 1, "y")), path, ("run", "stage"), schema)
    applog.append(rows(("s", "a", 5, "w")), path)
    applog.upsert(rows(("r", "b", 9, "z"), ("r", "c", 9, "q")), path, ("run", "stage"), schema)
    now = lambda: sorted(map(tuple, applog.read(spark, path, schema).collect()))
    held = [("r", "a", 1, "x"), ("r", "b", 1, "z"), ("r", "c", 9, "q"), ("s", "a", 5, "w")]
    assert now() == held
    with pytest.raises(Exception, match="no"):
        applog.upsert(rows(("r", "b", 9, "t")).withColumn("v", F.raise_error(F.lit("no"))), path, ("run", "stage"), schema)
    assert now() == held
    late = applog.LogSource({"path": path, "seen": '["000000000000.json"]'}).writer(None, True)
    with pytest.raises(ValueError, match="changed meanwhile"):
        late.commit([late.write(_batch('{"run": "t"}'))])
    assert now() == held and applog.vacuum(path, 0) >= 2 and now() == held
