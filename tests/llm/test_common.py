import os

from pyspark.sql import functions as F

from dwellspan.llm.common import ascii_lower, drop_written, map_batches, n_words, shared_dir, written


def test_tables_go_to_the_shared_folder_and_can_be_dropped(spark):
    df = written(spark.range(5), "t")
    path = df.inputFiles()[0].removeprefix("file://")
    assert path.startswith(shared_dir(spark).removeprefix("file://")) and df.count() == 5
    drop_written(spark)
    assert not os.path.exists(os.path.dirname(path))


def test_words_and_case(spark):
    df = spark.createDataFrame([(None,), ("",), (" \t\n\x0b\x0c\r",), ("a  b\x1cc\xa0d É",)], "t string")
    assert [r.n for r in df.select(n_words(F.col("t")).alias("n")).collect()] == [0, 0, 0, 3]
    assert spark.range(1).select(ascii_lower(F.lit("AZÉß")).alias("l")).first().l == "azÉß"


def test_batches_are_small(spark):
    def sizes(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"])

    got = [r.n for r in map_batches(spark.range(0, 10_000, 1, 1), sizes, "n long").collect()]
    assert sum(got) == 10_000 and max(got) <= 2048


def test_key_filters_miss_nothing(spark):
    import numpy as np

    from dwellspan.llm.common import key_filter, may_hold

    held = key_filter(spark.range(0, 20_000, 2).select(F.xxhash64("id").alias("key")))
    hashes = np.array([r.key for r in spark.range(20_000).select(F.xxhash64("id").alias("key")).collect()])
    got = may_hold(held, hashes)
    assert got[::2].all() and got[1::2].mean() < 0.1
    assert not may_hold(key_filter(spark.range(0).select(F.xxhash64("id").alias("key"))), hashes).any()
