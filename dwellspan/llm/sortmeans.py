"""Centroid clustering by sort-means: exact rounds that skip the centroids which can't be nearer.

Vectors become integers and stand in blocks, a row of the table each. A round orders, for each centroid, the others by distance from it;
a vector looks at them from its last centroid on and stops at the first that lies strictly beyond twice its distance
from that centroid, as by the triangle inequality neither this nor a later one can be nearer or as near. All sums are of integers, so results don't depend
on partitions. A task hands on its sums in one row, and the driver gets their totals, a row for each centroid and component.
Each round writes the blocks with their assignments anew and then drops those of the round before: two copies of the integers stand at a time at most, and a lost
executor costs tasks of one round.

Vectors take part that have the stated number of components, none null or non-finite, of a size whose squared distances fit 64 bits (for
64 components up to 189,812,531, which is 1024 times 185,363). A null id takes part, but isn't drawn as a first centroid before others.
Repeated rows count each. Equal distances go to the smaller number, as do equal centroids. With fewer vectors than clusters each starts one; an
empty table gives an empty result. Other columns are left out, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_path, map_batches, table, written_at

CLUSTERS, ROUNDS, DIMENSIONS, SCALE, SEED = 8, 10, 64, 1024, 3
#: vectors: integers of so many bytes; clusters, distances: one a vector; the last row of a task holds its sums only.
BLOCKS = "ids array<bigint>, width int, vectors binary, clusters binary, distances binary, sums array<bigint>, looked_at bigint"


class Model(NamedTuple):
    """centroids: a list of integers each; inertia: summed squared distances of each one's vectors; looked_at: distances computed, over all rounds."""

    centroids: list[list[int]]
    inertia: list[int]
    looked_at: int


def most_component(dimensions: int) -> int:
    """The largest absolute component with which squared distances fit 64 bits."""
    return math.isqrt((2**63 - 1) // dimensions) // 2


def taking_part(df: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id and embedding of rows whose vector takes part."""
    most = float(most_component(dimensions) // scale)
    fits = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < most))
    return df.where(F.size("embedding") == dimensions).where(fits).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))


def first_centroids(vectors: DataFrame, clusters: int, seed: int, scale: int) -> list[list[int]]:
    """The integers of the vectors whose ids have the least digests."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = vectors.select(digest.alias("digest"), "embedding").orderBy(F.col("digest").asc_nulls_last(), "embedding").limit(clusters).collect()
    return [[math.floor(scale * x) for x in r.embedding] for r in rows]


def squared(x, c):
    """Exact squared distances of the rows of x from c, both int64; in floating point where that is exact too."""
    import numpy as np

    most = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    if x.shape[1] * most * most < 2**50:
        x, c = x.astype(np.float64), c.astype(np.float64)
        return (np.einsum("ij,ij->i", x, x) - 2 * (x @ c) + c @ c).astype(np.int64)
    apart = x - c
    return np.einsum("ij,ij->i", apart, apart)


def nearest(x, before, centroids):
    """Cluster and squared distance of each row of x (int64), from its last cluster on, and how many distances were computed."""
    import numpy as np

    cluster, distance, looked_at = before.astype(np.int32), np.zeros(len(x), np.int64), 0
    for i in np.unique(before).tolist():
        rows = np.flatnonzero(before == i)
        own = x[rows]
        here = squared(own, centroids[i])
        best, found = here.copy(), np.full(len(rows), i, np.int32)
        between = squared(centroids, centroids[i])
        left = np.arange(len(rows))
        looked_at += len(rows)
        for j in np.argsort(between, kind="stable").tolist():
            if j == i:
                continue
            # the last one to look at: between = 4 * here, twice the distance
            left = left[here[left] >= -(-int(between[j]) // 4)]
            if not len(left):
                break
            there = squared(own[left], centroids[j])
            looked_at += len(left)
            nearer = (there < best[left]) | ((there == best[left]) & (j < found[left]))
            best[left[nearer]], found[left[nearer]] = there[nearer], j
        cluster[rows], distance[rows] = found, best
    return cluster, distance, looked_at


def _round(blocks: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Blocks assigned to their nearest centroids; the sums are components by cluster, then counts, then distances."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        names = [c.split(" ")[0] for c in BLOCKS.split(", ")]
        types = [pa.list_(pa.int64()), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.int64()]
        c = np.array(centroids, np.int64)
        k, d = c.shape
        sums, counts, inertia, looked_at = np.zeros((k, d), np.int64), np.zeros(k, np.int64), np.zeros(k, np.int64), 0
        for batch in batches:
            for at in range(batch.num_rows):
                ids, width, raw, held = (batch.column(n).slice(at, 1) for n in range(4))
                w = width[0].as_py()
                x = np.frombuffer(raw[0].as_buffer(), f"<i{w}").reshape(-1, d).astype(np.int64)
                cluster, distance, looked = nearest(x, np.frombuffer(held[0].as_buffer(), "<i4"), c)
                looked_at += looked
                for i in np.unique(cluster).tolist():
                    own = cluster == i
                    sums[i] += x[own].sum(axis=0)
                    counts[i] += own.sum()
                    inertia[i] += distance[own].sum()
                new = [ids, width, raw, pa.array([cluster.astype("<i4").tobytes()], pa.binary()), pa.array([distance.astype("<i8").tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays([*(a.cast(t) for a, t in zip(new, types)), pa.nulls(1, types[5]), pa.nulls(1, types[6])], names)
        if looked_at:
            total = pa.array([[*sums.ravel().tolist(), *counts.tolist(), *inertia.tolist()]], types[5])
            yield pa.RecordBatch.from_arrays([*(pa.nulls(1, t) for t in types[:5]), total, pa.array([looked_at], types[6])], names)

    return map_batches(blocks.where("sums is null"), run, BLOCKS)


def _totals(blocks: DataFrame) -> tuple[list[int], int]:
    own = blocks.where("sums is not null")
    rows = own.select(F.posexplode("sums").alias("at", "n")).groupBy("at").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n")).collect()
    held = {r["at"]: int(r["n"]) for r in rows}
    return [held[k] for k in range(len(held))], int(own.agg(F.sum("looked_at")).first()[0] or 0)


def _blocks(vectors: DataFrame, scale: int) -> DataFrame:
    """Vectors as blocks of integers, all of them in cluster 0."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = np.floor(scale * batch.column(1).flatten().to_numpy(zero_copy_only=False)).astype(np.int64)
            width = next(w for w in (2, 4, 8) if np.abs(x).max() < 2 ** (8 * w - 1))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), batch.column(0)), pa.array([width], pa.int32()), pa.array([x.astype(f"<i{width}").tobytes()], pa.binary()),
                    pa.array([bytes(4 * n)], pa.binary()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.list_(pa.int64())), pa.nulls(1, pa.int64()),
                ],
                [c.split(" ")[0] for c in BLOCKS.split(", ")],
            )

    return map_batches(vectors, run, BLOCKS)


def sort_means(df: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED) -> tuple[DataFrame, Model]:
    """vec_id, cluster and distance (squared) of each vector that takes part, and the model."""
    spark = df.sparkSession
    vectors = taking_part(df, dimensions, scale)
    centroids = first_centroids(vectors, clusters, seed, scale)
    if not centroids:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), Model([], [], 0)
    k, looked_at = len(centroids), 0
    blocks, path = written_at(_blocks(vectors, scale), "blocks")
    for n in range(rounds + 1):
        assigned, new = written_at(_round(blocks, centroids), "blocks")
        drop_path(spark, path)
        blocks, path = assigned, new
        totals, looked = _totals(blocks)
        looked_at += looked
        counts, inertia = totals[k * dimensions : k * dimensions + k], totals[k * dimensions + k :]
        if n < rounds:
            centroids = [[s // counts[i] for s in totals[i * dimensions : (i + 1) * dimensions]] if counts[i] else old for i, old in enumerate(centroids)]

    def rows(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for at in range(batch.num_rows):
                cluster, distance = (np.frombuffer(batch.column(n)[at].as_buffer(), kind) for n, kind in ((1, "<i4"), (2, "<i8")))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 1).flatten(), pa.array(cluster), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return map_batches(blocks.where("sums is null").select("ids", "clusters", "distances"), rows, "vec_id long, cluster int, distance long"), Model(centroids, inertia, looked_at)


def op13_sort_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model = sort_means(table(spark, sf_dir, "embeddings"))
    stats = [(i, inertia, sum(model.inertia), ",".join(map(str, c))) for i, (c, inertia) in enumerate(zip(model.centroids, model.inertia))]
    held = spark.createDataFrame(stats, "cluster int, cluster_inertia long, inertia long, centroid string").withColumn("centroid_sha256", F.sha2(F.col("centroid").cast("binary"), 256))
    return rows.join(F.broadcast(held.drop("centroid")), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # a row for each centroid


def _rounds_sql() -> str:
    """A round reads the centroids of the one before."""
    out = [f"c0 AS (SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id), v) - 1 AS cluster, v FROM kept ORDER BY sha256('{SEED}:' || vec_id), v LIMIT {CLUSTERS})"]
    for n in range(ROUNDS + 1):
        out.append(f"""a{n} AS MATERIALIZED (
  SELECT rid, any_value(vec_id) AS vec_id, any_value(x) AS x, arg_min(cluster, distance * {CLUSTERS} + cluster) AS cluster, min(distance) AS distance FROM (
    SELECT k.rid, k.vec_id, k.v AS x, c.cluster, list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::HUGEINT AS distance FROM kept k CROSS JOIN c{n} c) GROUP BY rid)""")
        if n < ROUNDS:
            out.append(f"""c{n + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{n} c LEFT JOIN (
    SELECT cluster, list((s - ((s % n + n) % n)) // n ORDER BY i) AS v FROM (
      SELECT cluster, i, sum(x[i])::HUGEINT AS s, count(*) AS n FROM a{n}, range(1, {DIMENSIONS + 1}) r(i) GROUP BY cluster, i) GROUP BY cluster) m ON m.cluster = c.cluster)""")
    return ",\n".join(out)


OP13_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda e: floor({SCALE} * e::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {DIMENSIONS}),
{_rounds_sql()}
SELECT a.vec_id, a.cluster::INTEGER AS cluster, a.distance::BIGINT AS distance, (sum(a.distance) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia, (sum(a.distance) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} c ON c.cluster = a.cluster
"""
