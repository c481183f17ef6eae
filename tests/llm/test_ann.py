import numpy as np
import pytest
from pyspark.sql import functions as F

from dwellspan.llm import ann
from dwellspan.llm.ann import neighbours, op1_multi_index_search, walk


def _brute(ids, m, queries, k=20):
    out = {}
    for q in queries:
        v = m[ids == q][0]
        score = np.zeros(len(m))
        for c in range(m.shape[1]):
            score = score + m[:, c] * v[c]
        ok = ids != q
        order = np.lexsort((ids[ok], -score[ok]))[:k]
        out[q] = (ids[ok][order].tolist(), score[ok][order].tolist())
    return out


def test_recall_of_the_whole_table(spark, sf_dir):
    got = op1_multi_index_search(spark, sf_dir).toPandas()
    t = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    want = _brute(t.vec_id.to_numpy(), np.stack(t.embedding).astype(float), [i for i in t.vec_id if i % 20 == 0])
    assert set(got.query_id) == set(want) and (got.groupby("query_id").size() == 20).all()
    found = {q: set(g.vec_id) for q, g in got.groupby("query_id")}
    assert np.mean([len(found[q] & set(w[0])) / 20 for q, w in want.items()]) >= 0.9
    for q, g in got.groupby("query_id"):
        g = g.sort_values("rank")
        assert g["rank"].tolist() == list(range(1, 21))
        assert list(zip(-g.score, g.vec_id, strict=True)) == sorted(zip(-g.score, g.vec_id, strict=True))


@pytest.mark.parametrize("unit", [5, 20_000])
def test_visiting_all_cells_is_exact(spark, monkeypatch, unit):
    monkeypatch.setattr(ann, "UNIT_ROWS", unit)
    monkeypatch.setattr(ann, "CENTROIDS", 16)
    rng = np.random.default_rng(1)
    m = rng.normal(size=(300, 6)) * rng.uniform(0.1, 5, (300, 1))
    m[50:120] = m[50]  # ties
    ids = rng.permutation(1000)[:300]
    df = spark.createDataFrame([(int(i), v.tolist(), "x") for i, v in zip(ids, m, strict=True)], "vec_id long, embedding array<double>, rank string")
    got = neighbours(df, F.col("vec_id") % 7 == 0, visit=1.0).toPandas()
    want = _brute(ids, m, [int(i) for i in ids if i % 7 == 0])
    for q, (w_ids, w_scores) in want.items():
        g = got[got.query_id == q].sort_values("rank")
        assert g.vec_id.tolist() == w_ids and g.score.tolist() == w_scores


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, []), (7, [1.0, 2.0, 3.0]), (8, [2.0, 0.0]), (9, [-1.0, 0.5]), (None, [5.0, 5.0]), (8, [2.0, 0.0])]
    got = neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 4 == 0).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got if r.query_id == 0] == [(0, 1, 8, 2.0), (0, 2, 9, -1.0)]
    assert [(r["rank"], r.vec_id, r.score) for r in got if r.query_id == 8] == [(1, 0, 2.0), (2, 9, -2.0)]
    assert {r.query_id for r in got} == {0, 8}


@pytest.mark.parametrize("unit", [5, 20_000])
def test_repeated_ids_stand_for_one(spark, monkeypatch, unit):
    monkeypatch.setattr(ann, "UNIT_ROWS", unit)
    monkeypatch.setattr(ann, "CENTROIDS", 8)
    rng = np.random.default_rng(3)
    ids = np.concatenate([rng.integers(0, 60, 200), np.full(100, 7), np.full(50, 14)])
    m = rng.normal(size=(350, 4))
    m[10:40] = m[10]
    got = neighbours(spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, m, strict=True)] * 2, "vec_id long, embedding array<double>"), F.col("vec_id") % 7 == 0, k=5, visit=1.0).toPandas()
    s = sum(m[:, [c]] * m[:, c] for c in range(4))
    for q in sorted({int(i) for i in ids if i % 7 == 0}):
        best = {int(i): s[ids == q][:, ids == i].max() for i in set(ids.tolist()) - {q}}
        want = sorted(best, key=lambda i: (-best[i], i))[:5]
        g = got[got.query_id == q].sort_values("rank")
        assert g.vec_id.tolist() == want and np.allclose(g.score, [best[i] for i in want], atol=1e-12)


def test_products_are_of_seen_cells_only():
    rng = np.random.default_rng(4)
    cells = np.sort(rng.integers(0, 30, 500))
    unit, seen = ann.Unit(np.arange(500), cells, rng.normal(size=(500, 8))), rng.random((40, 30)) < 0.3
    unit.best(np.arange(40), unit.rows[:40], seen, 20)
    assert unit.products == seen[:, cells].sum()


def test_empty_and_single(spark):
    assert neighbours(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)).count() == 0
    assert neighbours(spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>"), F.lit(True)).count() == 0


def test_walk_takes_cells_in_order():
    rng = np.random.default_rng(2)
    a, b, counts = rng.normal(size=9), rng.normal(size=7), rng.integers(0, 5, (9, 7))
    for target in (0.5, 10, 40, 1e9):
        seen = walk(a, b, counts, target)
        sums = a[:, None] + b[None, :]
        order = np.argsort(-sums, axis=None, kind="stable")
        reached = np.cumsum(counts.ravel()[order])
        n = int(np.searchsorted(reached, target)) + 1
        assert seen.sum() == min(n, seen.size) and seen.ravel()[order[: min(n, seen.size)]].all()
