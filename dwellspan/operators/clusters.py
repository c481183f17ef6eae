"""Order-dependent grouping: leader clusters with moving representatives, and non-max suppression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lineage import cut


def whole_vectors(column):
    """Rows of an Arrow list column as a matrix of doubles, and which of them hold a vector: not null, as long as most of the batch's first one, no component null or NaN."""
    import numpy as np
    import pyarrow.compute as pc

    length = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    some = np.flatnonzero(length > 0)
    width = int(length[some[0]]) if len(some) else 0
    held = (length == width) & (width > 0)
    out = np.zeros((len(column), width))
    rows = np.flatnonzero(held)
    if len(rows):
        flat = column.take(rows).flatten().to_numpy(zero_copy_only=False).astype(float)
        out[rows] = flat.reshape(len(rows), width)
        held[rows] = ~np.isnan(out[rows]).any(axis=1)
    return out, held


def leader_clusters(rows: DataFrame, keys: Sequence[str], at: str, vector: str, conf: str, threshold: float = 0.30, name: str = "cluster") -> DataFrame:
    """rows with the number of their cluster in each key.

    In order of time a row joins the nearest representative closer than threshold (half the L1 distance),
    else opens a cluster; a member of higher confidence becomes the representative. One pass over the
    sorted rows of each key; what is held is one vector a cluster. Rows whose vector is null, holds a null or NaN or has another
    length than the first one of the key get a null cluster and change nothing; a null or NaN confidence is below all others.
    """
    key_at = [rows.columns.index(k) for k in keys]
    v_at, c_at = rows.columns.index(vector), rows.columns.index(conf)
    schema = rows.select("*", F.lit(0).cast("int").alias(name)).schema
    schema[name].nullable = True

    def run(batches):
        import numpy as np
        import pyarrow as pa

        key, n, reps, confs = None, 0, None, np.empty(8)
        for batch in batches:
            names = list(zip(*(["nan" if x != x else x for x in batch.column(k).to_pylist()] for k in key_at), strict=True)) if key_at else [()] * batch.num_rows
            vectors, held = whole_vectors(batch.column(v_at))
            sure = batch.column(c_at).to_numpy(zero_copy_only=False).astype(float)
            sure = np.where(np.isnan(sure), -np.inf, sure)
            marks = np.empty(batch.num_rows, np.int32)
            for i in np.flatnonzero(held).tolist():
                if key is None or names[i] != key:
                    key, n, reps = names[i], 0, np.empty((8, vectors.shape[1]))
                if reps.shape[1] != vectors.shape[1]:
                    held[i] = False
                    continue
                v = vectors[i]
                d = np.abs(reps[:n] - v).sum(1) / 2
                k = int(d.argmin()) if n else 0
                if n and d[k] < threshold:
                    if sure[i] > confs[k]:
                        reps[k], confs[k] = v, sure[i]
                else:
                    if n == len(reps):
                        reps = np.concatenate([reps, np.empty_like(reps)])  # twice the room
                    if n == len(confs):
                        confs = np.concatenate([confs, np.empty_like(confs)])
                    k, reps[n], confs[n] = n, v, sure[i]
                    n += 1
                marks[i] = k
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(marks, mask=~held)], names=[*batch.schema.names, name])

    return rows.repartition(*keys).sortWithinPartitions(*keys, at).mapInArrow(run, schema)


def _digest(seed: int, key: str):
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"))


def with_nearest(points: DataFrame, vector: str, centres: Sequence[Sequence[int]], name: str = "near_") -> DataFrame:
    """points with a struct of the squared distance and the number of the nearest of some centres, the first of equally near ones; all are integers.

    The centres come as one row of a table, so that rounds share their compiled code.
    """
    held = points.sparkSession.createDataFrame([([list(c) for c in centres],)], "centres_ array<array<bigint>>")
    off = lambda c: F.aggregate(F.zip_with(vector, c, lambda a, b: (a - b) * (a - b)), F.lit(0).cast("long"), lambda acc, x: acc + x)
    near = F.array_min(F.transform("centres_", lambda c, i: F.struct(off(c).alias("distance"), i.alias("cluster"))))
    return points.crossJoin(F.broadcast(held)).withColumn(name, near).drop("centres_")  # one row


def minibatch_centres(points: DataFrame, key: str, vector: str, k: int, batches: int = 4, epochs: int = 2, seed: int = 0) -> list[list[int]]:
    """Centres of mini-batch k-means over integer vectors.

    Rows fall into batches by a digest of their key, and the k least digests start. A batch's rows go to their nearest centres, and each centre moves to
    them by what part they are of all rows that it ever had: the more it has seen, the less a batch moves it. Sums are of integers, so partitions make
    no difference. A batch reads its own part of the table only; the driver gets k rows of sums for each.
    """
    size = points.select(F.max(F.size(vector))).first()[0]
    if size is None:
        return []
    drawn = points.select(_digest(seed, key).alias("digest"), vector).orderBy(F.col("digest").asc_nulls_last(), vector).limit(k).collect()
    centres, seen = [[int(x) for x in r[vector]] for r in drawn], [0] * k
    number = F.coalesce(F.conv(F.substring(_digest(seed, key), 1, 8), 16, 10).cast("long") % batches, F.lit(0))
    dealt = cut(points.select(number.cast("int").alias("batch_"), vector), "batch_")
    for turn in range(epochs * batches):
        own = with_nearest(dealt.filter(F.col("batch_") == turn % batches), vector, centres).withColumn("cluster_", F.col("near_.cluster"))
        sums = own.groupBy("cluster_").agg(F.count("*").alias("n"), *(F.sum(F.col(vector)[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(size)))
        for r in sums.collect():
            c = r["cluster_"]
            seen[c] += r.n
            centres[c] = [x + (int(r[f"s{i}"]) - r.n * x) // seen[c] for i, x in enumerate(centres[c])]
    return centres


def whole_integers(df: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """key and vector of rows whose vector has no null, NaN or infinite component and the length that most have; components become floor(scale * x)."""
    sound = df.filter(F.size(vector) > 0).filter(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))))
    usual = sound.agg(F.mode(F.size(vector))).first()[0]
    ints = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return sound.filter(F.size(vector) == F.lit(usual)).select(key, ints.alias(vector))


def minibatch_kmeans(df: DataFrame, key: str, vector: str, k: int, batches: int = 4, epochs: int = 2, seed: int = 0, scale: int = 65536) -> DataFrame:
    """key, cluster, distance (squared, in squares of 1 / scale) of the rows whose vector is whole."""
    points = whole_integers(df, key, vector, scale)
    centres = minibatch_centres(points, key, vector, k, batches, epochs, seed)
    if not centres:
        return points.select(key, F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
    return with_nearest(points, vector, centres).select(key, "near_.cluster", "near_.distance")


def cluster_summary(clustered: DataFrame, keys: Sequence[str], at: str, period: float, name: str = "cluster") -> DataFrame:
    """keys, creative (from 0 by falling size), n_frames, seconds, t_first, t_last."""
    from pyspark.sql import Window

    out = clustered.groupBy(*keys, name).agg(F.count("*").alias("n_frames"), F.min(at).alias("t_first"), F.max(at).alias("t_last"))
    order = Window.partitionBy(*keys).orderBy(F.desc("n_frames"), name)
    return out.withColumn("creative", F.row_number().over(order) - 1).withColumn("seconds", F.round(F.col("n_frames") * period, 2)).drop(name)


def suppress(boxes: DataFrame, keys: Sequence[str], score: str = "score", share: float = 0.5) -> DataFrame:
    """The boxes (x, y, w, h) of each key that no better kept box is near: within share of the larger width and height.

    Equal scores go by x, y, w and h, nulls last. A box of null place is near none; of a null size the other box's counts. Small keys are looked at
    together, a batch at a time: in each round every key keeps its best open box. What a task holds beside a batch is the kept boxes of one key.
    """
    from pyspark.sql import Window

    names = list(keys)
    columns = boxes.columns
    order = [F.desc_nulls_last(score), *(F.asc_nulls_last(c) for c in ("x", "y", "w", "h"))]
    ranked = boxes.repartition(*names).withColumn("rank_", F.row_number().over(Window.partitionBy(*names).orderBy(*order))).sortWithinPartitions(*names, "rank_")

    def near(a, b):
        """Whether boxes (x, y, w, h in columns) are near, pair by pair."""
        import numpy as np

        apart = np.abs(a[..., :2] - b[..., :2])
        return (apart < share * np.fmax(a[..., 2:], b[..., 2:])).all(axis=-1)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        held = np.empty((0, 4))  # kept boxes of the key that the batch before ended in
        for batch in batches:
            if not batch.num_rows:
                continue
            first = batch.column("rank_").to_numpy() == 1
            spots = [batch.column(c).cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False) for c in ("x", "y", "w", "h")]
            spots = np.stack([*spots[:2], *(np.where(np.isnan(v) & ~batch.column(c).is_null().to_numpy(zero_copy_only=False), np.inf, v) for c, v in zip("wh", spots[2:], strict=True))], axis=1)
            group, kept = np.cumsum(first), np.zeros(batch.num_rows, bool)
            own = np.flatnonzero(group == 0)  # rows of the key before
            for start in range(0, len(held), 256):
                own = own[~near(spots[own][:, None], held[None, start : start + 256]).any(axis=1)]
            rest = np.concatenate([own, np.flatnonzero(group > 0)])
            while len(rest):
                lead = np.ones(len(rest), bool)
                lead[1:] = group[rest[1:]] != group[rest[:-1]]
                best = rest[lead]
                kept[best] = True
                to = best[np.cumsum(lead) - 1]
                rest = rest[~lead & ~near(spots[rest], spots[to])]
            last = spots[kept & (group == group[-1])]
            held = last if group[-1] else np.concatenate([held, last])
            yield batch.filter(pa.array(kept)).select(columns)

    return ranked.mapInArrow(run, boxes.schema)
