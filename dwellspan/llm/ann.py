"""Approximate nearest neighbours by inner product with an inverted multi-index.

The two halves of the vectors are quantised separately to CENTROIDS each, by k-means on a bounded
sample, so each vector lies in one of CENTROIDS^2 cells. A query walks the pairs of centroids by
the sum of its two inner products with a heap until the cells seen hold the share ``visit`` of all
vectors, k at least. Vectors and queries meet by blocks of cells, of bounded size: a block is split by salt
when it holds more than UNIT_ROWS vectors, and each query goes once to each part that it walks
through. There the entries stand in the order of their cells, and a query is multiplied with those of
the cells that it walks through only; the best are ranked again by the exact inner product in double precision.

``visit`` is a share of the index, as the true neighbours of isotropic vectors are spread over a large
part of it; less will do where vectors form clusters. It holds at every size of the table.

Vectors that are null, all zero, of another length than most, or hold a null or non-finite component,
and rows without an id, take no part. Rows that repeat an id stand for one entry and one query: the score of
two ids is the largest over their rows, an id is found once at most and never by itself. Ties go to the
smaller id. Other columns are left out; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_batches, table, written

CENTROIDS, BLOCK = 64, 8  # centroids of a half; first-half centroids in a block
SAMPLE_ROWS, KMEANS_ROUNDS = 20_000, 10
VISIT = 0.55
UNIT_ROWS = 20_000
QUERY_ROWS = 256
FOUND = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding of the rows that take part."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter("vec_id is not null and size(embedding) > 0")
    v = v.filter("forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(embedding, x -> x != 0)")
    dim = v.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return v.filter(F.size("embedding") == (dim.d if dim else 0))


def kmeans(rows, k: int, rounds: int = KMEANS_ROUNDS):
    """Centroids of rows; fewer if there are fewer distinct rows."""
    import numpy as np

    distinct = np.unique(rows, axis=0)
    rng = np.random.default_rng(0)
    centroids = distinct[rng.choice(len(distinct), min(k, len(distinct)), replace=False)]
    for _ in range(rounds):
        nearest = (rows @ centroids.T - (centroids**2).sum(1) / 2).argmax(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, rows)
        n = np.bincount(nearest, minlength=len(centroids))
        centroids = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centroids)
    return centroids


def walk(first, second, counts, target: float):
    """Cells in the order of falling first[i] + second[j], until they hold target vectors: a boolean matrix."""
    import numpy as np

    order1, order2 = np.argsort(-first, kind="stable").tolist(), np.argsort(-second, kind="stable").tolist()
    first, second, held = first.tolist(), second.tolist(), counts.tolist()
    seen = np.zeros(counts.shape, bool)
    heap, reached, total = [(-first[order1[0]] - second[order2[0]], 0, 0)], [0] * len(order1), 0
    while heap and total < target:
        _, a, b = heapq.heappop(heap)
        i, j = order1[a], order2[b]
        seen[i, j] = True
        total += held[i][j]
        if b + 1 < len(order2):
            heapq.heappush(heap, (-first[i] - second[order2[b + 1]], a, b + 1))
        if b == 0 and a + 1 < len(order1):
            heapq.heappush(heap, (-first[order1[a + 1]] - second[j], a + 1, 0))
    return seen


def _matrix(column):
    """The rows of an Arrow list column, in double precision."""
    import numpy as np

    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(column), -1)


def _sums(products):
    """Row sums from the first component to the last, the same wherever a row stands."""
    import numpy as np

    total = np.zeros(products.shape[0])
    for k in range(products.shape[1]):
        total = total + products[:, k]
    return total


class Unit:
    """Entries of a part of the index in the order of their cells."""

    def __init__(self, ids, cells, rows) -> None:
        import numpy as np

        self.ids, self.rows = ids, rows
        edges = np.flatnonzero(np.diff(cells, prepend=-1, append=-1))
        self.slices = [(int(cells[lo]), int(lo), int(hi)) for lo, hi in zip(edges, edges[1:], strict=False)]
        self.longest = np.sqrt((rows**2).sum(1).max())
        order = np.argsort(ids, kind="stable")
        first = np.flatnonzero(np.append(True, ids[order][1:] != ids[order][:-1]))
        self.one_of_each = None if len(first) == len(ids) else (order, first)
        self.products = 0

    def best(self, q_ids, q, seen, k: int):
        """query_id, vec_id, score of the k best ids in the cells that each query sees."""
        import numpy as np

        near = np.full((len(q), len(self.ids)), -np.inf)
        for cell, lo, hi in self.slices:
            who = np.flatnonzero(seen[:, cell])
            if len(who):
                near[who, lo:hi] = q[who] @ self.rows[lo:hi].T
                self.products += len(who) * (hi - lo)
        near[self.ids[None, :] == q_ids[:, None]] = -np.inf
        each = near if self.one_of_each is None else np.maximum.reduceat(near[:, self.one_of_each[0]], self.one_of_each[1], axis=1)
        n = each.shape[1]
        least = np.partition(each, n - k, axis=1)[:, n - k] if n > k else np.full(len(q), -np.inf)
        slack = 1e-12 * self.longest * np.sqrt((q**2).sum(1))
        out: list[list] = [[], [], []]
        for r in range(len(q)):
            keep = np.flatnonzero((near[r] >= least[r] - slack[r]) & (near[r] > -np.inf))
            ids, score = self.ids[keep], _sums(self.rows[keep] * q[r])
            order = np.lexsort((ids, -score))
            if self.one_of_each is not None:
                order = order[np.sort(np.unique(ids[order], return_index=True)[1])]
            order = order[:k]
            out[0].append(np.full(len(order), q_ids[r]))
            out[1].append(ids[order])
            out[2].append(score[order])
        return [np.concatenate(c) for c in out]


def neighbours(vectors: DataFrame, is_query, k: int = 20, visit: float = VISIT) -> DataFrame:
    """query_id, rank, vec_id, score: up to k neighbours of each row that is_query (a Column) holds for."""
    spark = vectors.sparkSession
    clean = usable(vectors)
    kind = clean.schema["embedding"].dataType.simpleString()
    sample = clean.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("embedding").toArrow().column(0).combine_chunks()
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = _matrix(sample)
    half = max(1, sample.shape[1] // 2)
    first, second = kmeans(sample[:, :half], CENTROIDS), kmeans(sample[:, half:], CENTROIDS)
    books = spark.sparkContext.broadcast((first, second))

    def code(batches: Iterator) -> Iterator:
        import pyarrow as pa

        one, two = books.value
        for batch in batches:
            x = _matrix(batch.column(1)) if batch.num_rows else None
            if x is not None:
                i = (x[:, :half] @ one.T - (one**2).sum(1) / 2).argmax(1)
                j = (x[:, half:] @ two.T - (two**2).sum(1) / 2).argmax(1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(i, pa.int32()), pa.array(j, pa.int32())], ["vec_id", "embedding", "i", "j"])

    coded = written(map_batches(clean, code, f"vec_id long, embedding {kind}, i int, j int"), "vectors")
    import numpy as np

    counts = np.zeros((len(first), len(second)), np.int64)
    for r in coded.groupBy("i", "j").agg(F.count("*").alias("n")).collect():  # CENTROIDS^2 rows at most
        counts[r.i, r.j] = r.n
    target = max(visit * counts.sum(), k + 1)  # the query itself may be among them
    salts = [max(1, -(-int(counts[b * BLOCK : (b + 1) * BLOCK].sum()) // UNIT_ROWS)) for b in range(-(-len(first) // BLOCK))]
    starts = np.cumsum([0, *salts]).tolist()

    def plan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        one, two = books.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                x = _matrix(part.column(1))
                a, b = x[:, :half] @ one.T, x[:, half:] @ two.T
                rows, units, masks = [], [], []
                for r in range(len(x)):
                    seen = np.zeros((len(salts) * BLOCK, CENTROIDS), bool)
                    seen[: len(one), : len(two)] = walk(a[r], b[r], counts, target)
                    bits = np.packbits(seen.reshape(len(salts), -1), axis=1)
                    for block in np.flatnonzero(bits.any(1)).tolist():
                        for salt in range(salts[block]):
                            rows.append(r)
                            units.append(starts[block] + salt)
                            masks.append(bits[block].tobytes())
                take = pa.array(rows, pa.int64())
                fixed = [pa.array([x] * len(rows), pa.int32()) for x in (1, 0)]
                yield pa.RecordBatch.from_arrays([pa.array(units, pa.int32()), *fixed, part.column(0).take(take), pa.array(masks, pa.binary()), part.column(1).take(take)], ["unit", "side", "cell", "id", "cells", "embedding"])

    sides = f"unit int, side int, cell int, id long, cells binary, embedding {kind}"
    # dealt by id first, or the few rows would be walked in one task
    asked = coded.filter(is_query).select("vec_id", "embedding").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "vec_id").distinct()
    queries = map_batches(asked, plan, sides)
    block, split = F.floor(F.col("i") / BLOCK).cast("int"), F.array(*map(F.lit, salts))
    unit = F.element_at(F.array(*map(F.lit, starts)), block + 1) + F.expr("pmod(xxhash64(vec_id), parts)").cast("int")
    cell = ((F.col("i") % BLOCK) * CENTROIDS + F.col("j")).cast("int")
    entries = coded.withColumn("parts", F.element_at(split, block + 1)).select(unit.alias("unit"), F.lit(0).alias("side"), cell.alias("cell"), F.col("vec_id").alias("id"), F.lit(None).cast("binary").alias("cells"), "embedding")

    def search(batches: Iterator) -> Iterator:
        import pyarrow as pa

        at, ids, cells, rows, unit_ = None, [], [], [], None
        for batch in batches:
            units, sides_ = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edges = [0, *(np.flatnonzero((np.diff(units) != 0) | (np.diff(sides_) != 0)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(edges, edges[1:], strict=False):
                if lo == hi:
                    continue
                if units[lo] != at:
                    at, ids, cells, rows, unit_ = units[lo], [], [], [], None
                run = batch.slice(lo, hi - lo)
                if sides_[lo] == 0:
                    ids.append(run.column(3).to_numpy())
                    cells.append(run.column(2).to_numpy())
                    rows.append(_matrix(run.column(5)))
                    continue
                if not ids:
                    continue
                if unit_ is None:
                    unit_ = Unit(np.concatenate(ids), np.concatenate(cells), np.concatenate(rows))
                for k0 in range(0, run.num_rows, QUERY_ROWS):
                    some = run.slice(k0, QUERY_ROWS)
                    seen = np.unpackbits(np.frombuffer(b"".join(some.column(4).to_pylist()), np.uint8).reshape(some.num_rows, -1), axis=1).astype(bool)
                    found = unit_.best(some.column(3).to_numpy(), _matrix(some.column(5)), seen, k)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["query_id", "vec_id", "score"])

    parts = max(starts[-1], int(spark.conf.get("spark.sql.shuffle.partitions")))
    met = entries.union(queries).repartition(parts, "unit").sortWithinPartitions("unit", "side", "cell")
    # one shuffle by query serves both the rows that an id repeats and the ranks
    found = map_batches(met, search, FOUND).repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1_multi_index_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
