import hashlib
import math
import re

import pytest
from pyspark.sql import functions as F

from dwellspan.llm.common import n_words
from dwellspan.llm.mixing import OP8_SQL, mix, op8_source_mixing, quality_weight, targets


def test_op8_equals_sql(same):
    same(op8_source_mixing, OP8_SQL)


def _water(sizes, weights=(1, 2, 3), epochs=3):
    """Targets by rounds of resharing."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(epochs * sizes[s] for s in capped)
        wsum = sum(w[s] for s in names if s not in capped)
        t = {s: epochs * sizes[s] if s in capped else rest * w[s] / wsum for s in names}
        over = {s for s in names if s not in capped and t[s] > epochs * sizes[s] + 1e-9}
        if not over:
            return t
        capped |= over


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 1000, "b": 10, "c": 5, "é": 1, None: 3}, {"a": 0, "b": 7}, {"x": 5}, {"B": 1, "a": 900, "b": 2, "c": 3000}])
def test_targets(spark, sizes):
    got = {r.source: r.target for r in targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    want = _water(sizes)
    assert got.keys() == want.keys() and all(math.isclose(got[s], want[s], abs_tol=1e-5) for s in want)


def _brute(rows):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    by = {}
    for doc_id, source, text in rows:
        by.setdefault(source, []).append((doc_id, size(text)))
    t = _water({s: sum(x[1] for x in v) for s, v in by.items()})
    out = {}
    for s, docs in by.items():
        total = sum(x[1] for x in docs)
        epochs = int(t[s] // total) if total else 0
        budget, here = t[s] - epochs * total, 0
        key = lambda d: -math.log((int(hashlib.md5(str(d).encode()).hexdigest()[:13], 16) + 0.5) / 2**52)
        for d, n in sorted(docs, key=lambda x: (key(x[0]), x[0])):
            before, here = here, here + n
            out[d] = n * (epochs + (before < budget and here - n / 2 <= budget))
    return out, t


def test_mix_against_brute_force(spark):
    rows = [(i, ["a", "b", "c", None][min(3, i % 7 // 2)], " ".join(["w"] * (i * 37 % 90))) for i in range(900)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, source string, text string, target string")
    out = mix(df, n_words(F.col("text")), F.lit(1.0)).withColumn("taken", F.col("mix_size") * F.col("mix_copies"))
    assert {"doc_id", "source", "text", "target"} <= set(out.columns)
    got = {r.doc_id: r.taken for r in out.collect()}
    want, targets_ = _brute(rows)
    assert got == want
    for s, t in targets_.items():
        taken = sum(got[i] for i, src, _ in rows if src == s)
        assert abs(taken - t) <= 90


def test_edges(spark):
    schema = "doc_id long, source string, text string"
    assert mix(spark.createDataFrame([], schema), n_words(F.col("text")), F.lit(1.0)).count() == 0
    rows = [(None, None, None), (1, "", ""), (1, "", ""), (2, "a", "x " * 50_000), (3, "a", "x"), (3, "a", "x")]
    got = mix(spark.createDataFrame(rows, schema), n_words(F.col("text")), F.lit(None).cast("double")).collect()
    assert len(got) == 6 and all(0 <= r.mix_copies <= 3 for r in got)


def test_weights_pull_documents_in(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "a").otherwise("c").alias("source"), F.lit("one two").alias("text"))
    w = F.when(F.col("doc_id") % 4 < 2, 4.0).otherwise(1.0)
    got = mix(df, n_words(F.col("text")), w, weights=(1.0, 3.0)).filter("source = 'a'").groupBy((F.col("doc_id") % 4 < 2).alias("good")).agg(F.avg("mix_copies").alias("x")).collect()
    share = {r.good: r.x for r in got}
    assert share[True] > 1.5 * share[False]


@pytest.mark.parametrize("parts", [1, 7])
def test_repeated_rows_are_decided_one_by_one(spark, duck, parts):
    rows = [(5, "a", "w " * 10)] * 200 + [(i, "b", "w " * 10) for i in range(10, 60)] + [(7, "b", "")] * 9 + [(None, None, "w w w")] * 40 + [(8, None, "w w # w")] * 11 + [(8, None, "w w w w")] * 11
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, source string, text string, mix_target int").repartition(parts)
    got = mix(df, n_words(F.col("text")), quality_weight(F.col("text"), n_words(F.col("text")))).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.source, []).append(r)
    for own in by.values():
        largest = max(r.mix_size for r in own)
        assert abs(sum(r.mix_size * r.mix_copies for r in own) - own[0].mix_target) <= largest / 2
    assert {r.mix_copies for r in by["a"]} == {0, 1}  # the budget ends among equal rows
    import pandas as pd

    cursor = duck.cursor()
    cursor.register("documents", pd.DataFrame(rows, columns=["doc_id", "source", "text"]).astype({"doc_id": "Int64"}))
    said = cursor.execute(OP8_SQL).fetchall()
    ours = sorted(((r.doc_id, r.mix_size, r.mix_source_size, round(r.mix_target, 4), r.mix_size * r.mix_copies) for r in got), key=str)
    assert ours == sorted(((i, n, m, round(t, 4), k) for i, n, m, t, k in said), key=str)
