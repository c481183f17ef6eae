import math
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dwellspan.llm.sortmeans import OP13_SQL, SCALE, most_component, nearest, op13_sort_means, sort_means, squared

SCHEMA = "vec_id long, embedding array<float>, cluster int, ids string"


def _plain(rows, clusters, rounds, dimensions, seed=3, scale=SCALE):
    """Every vector against every centroid, in Python's integers."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:clusters]]
    for n in range(rounds + 1):
        found = [min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids)) for _, v in kept]
        if n < rounds:
            for k in range(len(centroids)):
                own = [v for (_, v), (_, c) in zip(kept, found) if c == k]
                if own:
                    centroids[k] = [sum(x) // len(own) for x in zip(*own)]
    return [(i, k, d) for (i, _), (d, k) in zip(kept, found)], centroids


@settings(deadline=None, max_examples=300)
@given(st.data())
def test_nearest_is_exact_from_any_start(data):
    d, k, n = data.draw(st.integers(1, 4)), data.draw(st.integers(1, 7)), data.draw(st.integers(0, 25))
    most = data.draw(st.sampled_from([2, 50, most_component(4)]))
    numbers = st.integers(-most, most)
    x = np.array(data.draw(st.lists(st.lists(numbers, min_size=d, max_size=d), min_size=n, max_size=n)), np.int64).reshape(n, d)
    c = np.array(data.draw(st.lists(st.lists(numbers, min_size=d, max_size=d), min_size=k, max_size=k)), np.int64)
    before = np.array(data.draw(st.lists(st.integers(0, k - 1), min_size=n, max_size=n)), np.int32)
    cluster, distance, looked_at = nearest(x, before, c)
    best = [min((sum((int(a) - int(b)) ** 2 for a, b in zip(v, w)), j) for j, w in enumerate(c)) for v in x]
    assert [*zip(distance.tolist(), cluster.tolist())] == best and n <= looked_at <= n * k


def test_a_centroid_at_exactly_twice_the_distance_is_looked_at():
    # 4 lies halfway between 0 and 8 in cluster 1: the smaller number has it, though cluster 1 was the last
    cluster, distance, _ = nearest(np.array([[4]]), np.array([1], np.int32), np.array([[0], [8]]))
    assert cluster.tolist() == [0] and distance.tolist() == [16]


def test_squares_are_exact_in_both_ways():
    rnd = np.random.default_rng(1)
    for most in (10, 2**21, 2**23, most_component(64)):
        x, c = rnd.integers(-most, most, (50, 64)), rnd.integers(-most, most, 64)
        assert squared(x, c).tolist() == [sum((int(a) - int(b)) ** 2 for a, b in zip(v, c)) for v in x]


def _frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)


@pytest.mark.parametrize("rows", [
    [], [(1, [0.5, 0.5])], [(1, [0.5, 0.5])] * 9, [(i, [0.0, 0.0]) for i in range(20)],
    [(None, [1.0, 2.0]), (1, None), (2, []), (3, [1.0]), (4, [1.0, None]), (5, [1.0, math.inf]), (6, [math.nan, 0.0]), (7, [-0.3, 0.7]), (8, [1.0, 2.0, 3.0])],
    [(i, [math.sin(i) * (i % 7), -math.cos(i * i)]) for i in range(300)] + [(5, [1.5, -2.5])] * 3,
])
def test_small_tables_against_plain_rounds(spark, rows):
    rows = [(i, v if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    expected, centroids = _plain(rows, 4, 5, 2)
    got, model = sort_means(_frame(spark, rows).repartition(3), 4, 5, 2)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)
    assert model.centroids == centroids and sum(model.inertia) == sum(d for _, _, d in expected)


def test_partitions_make_no_difference_and_distances_are_saved(spark):
    rnd = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rnd.normal(8 * (i % 12), 0.3, 3)]) for i in range(3000)]
    one, model = sort_means(_frame(spark, rows).repartition(1), 12, 6, 3)
    many, again = sort_means(_frame(spark, rows).repartition(40), 12, 6, 3)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect())) and model == again
    assert model.looked_at < 0.5 * 12 * 7 * len(rows)


def test_components_too_large_for_64_bits_take_no_part(spark):
    rows = [(1, [1e30, 0.0]), (2, [3.0, 1.0]), (3, [-1e6, 0.0])]
    got, model = sort_means(_frame(spark, rows), 2, 1, 2)
    assert {r.vec_id for r in got.collect()} == {2, 3} and len(model.centroids) == 2


def test_only_two_copies_of_the_blocks_stand_at_a_time(spark):
    from pathlib import Path

    from dwellspan.llm.common import own_dir

    folder = Path(own_dir(spark).removeprefix("file:"))
    before = {*folder.glob("blocks-*")} if folder.exists() else set()
    sort_means(_frame(spark, [(i, [float(i), 0.0]) for i in range(50)]), 2, 3, 2)
    assert len({*folder.glob("blocks-*")} - before) == 1


def test_op13_equals_sql_and_plain_rounds(spark, sf_dir, same):
    same(op13_sort_means, OP13_SQL)
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    expected, centroids = _plain(rows, 8, 10, 64)
    got = op13_sort_means(spark, sf_dir)
    assert dict(got.dtypes) == {"vec_id": "bigint", "cluster": "int", "distance": "bigint", "cluster_inertia": "bigint", "inertia": "bigint", "centroid_sha256": "string"}
    held = got.collect()
    assert sorted((r.vec_id, r.cluster, r.distance) for r in held) == sorted(expected)
    for r in held:
        assert r.inertia == sum(d for *_, d in expected) and r.cluster_inertia == sum(d for _, k, d in expected if k == r.cluster)
        assert r.centroid_sha256 == sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()
    assert got.where(F.col("distance") < 0).count() == 0
