"""Language-model scores from unigram counts and a hashed maximum-entropy model.

The counts of all training tokens are exact (tokens stand as 64-bit digests). The model gives a probability to
every token of the vocabulary from its context. Its softmax is factored into nested classes of WAY
members each, a tree whose leaves lie the deeper the rarer they are, so that a token costs about as many
steps as its entropy needs. The KNOWN_WORDS most frequent tokens are leaves of their own; the others, and
unseen ones, fall by their digest into buckets, which are leaves too, and share a bucket by their smoothed
counts. Each choice within a class is log-linear in hashed features of the token before, the token
two before (skip) and both, and starts from the unigram shares.

Training takes all training texts in ROUNDS turns, by a digest of their ids. In a turn each task sums the
gradients of its texts, sums over all tasks are formed by rows of weights, and one damped step is taken; so
the model does not depend on how rows fall into tasks, but for rounding. The vocabulary, its buckets and the
rows of weights (by the square root of the number of tokens, up to MAX_ROWS) grow with the input.
Scoring runs in batches of sparse rows; counts of the known tokens travel with it, rarer tokens are
joined to their counts.

A null text is empty and consists of its end token. Ids count as text for the held-out digest, a null id
as empty. Each row counts, repeated ids too. Columns other than doc_id and text are left out; an
empty table gives an empty result; without training rows all counts are 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, table, written

END = b"\n"  # no word holds it
#: Members of a class in the tree of the vocabulary.
WAY = 16
#: Tokens that are leaves of their own, and whose counts every scoring task holds.
KNOWN_WORDS = 2**18
#: About so many rarer tokens share a bucket, with MAX_BUCKETS at most.
BUCKET_TOKENS, MAX_BUCKETS = 32, 2**16
#: Rows of weights: ROWS_FACTOR times the square root of the training tokens, as a power of two within these bounds.
ROWS_FACTOR, MIN_ROWS, MAX_ROWS = 32, 2**10, 2**20
ROUNDS = 4
#: A row with n events so far moves by RATE * gradient sum / (n + DAMPING), each weight by MAX_STEP at most and within MAX_WEIGHT.
RATE, DAMPING, MAX_STEP, MAX_WEIGHT = 5.0, 30.0, 1.5, 8.0
#: Known tokens are found by so many top bits of their digests.
TOP_BITS = 18
#: Tokens whose events are handled at once; so few that the rows of sums they meet stay in a core's cache.
BATCH = 2**10
#: A counting task hands on its counts when it holds so many tokens.
FLUSH_TOKENS = 2**21
#: Training tokens of a turn for a task, unless that gives fewer tasks than cores.
TASK_TOKENS = 2**24
SLICE_ROWS = 512
BLOCK_ROWS = 256  # a byte tells a row's place in its block
PRIMES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
START = 0x51ED270B6A1F93C5  # stands before the first token


def held_out(doc_id) -> F.Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 1


def _mixed(x):
    """64-bit integers mixed in place, one to one."""
    import numpy as np

    for prime in PRIMES[:2]:
        x ^= x >> np.uint64(32)
        x *= np.uint64(prime)
    x ^= x >> np.uint64(29)
    return x


def _digests(texts: list[bytes | None]):
    """Digests of the tokens of texts, one after the other, and the number of each text.

    Words of up to 16 bytes are digested all at once from their length, first and last 8 bytes; those of
    up to 7 bytes can't collide with each other.
    """
    import numpy as np
    from xxhash import xxh3_64_intdigest

    joined = b" ".join([b"", *(text or b"" for text in texts), b" " * 8]).lower()
    data = np.frombuffer(joined, np.uint8)
    space = (data == 32) | (data - np.uint8(9) <= 4)
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1  # the first and the last byte are spaces
    start, end = edges[::2], edges[1::2]
    size = end - start
    eight = np.ndarray(len(data) - 7, "V8", joined, strides=(1,))  # the 8 bytes from each place on
    kept = np.array([2 ** (8 * min(k, 8)) - 1 for k in range(9)], np.uint64)
    words = eight[start].view("<u8") & kept[np.minimum(size, 8)]
    words += size.astype(np.uint64) * np.uint64(PRIMES[0])
    _mixed(words)
    longer = np.flatnonzero(size >= 8)
    words[longer] += eight[end[longer] - 8].view("<u8")
    _mixed(words)
    for k in np.flatnonzero(size > 16).tolist():
        words[k] = xxh3_64_intdigest(joined[start[k] : end[k]])
    own = np.diff(np.searchsorted(start, np.cumsum([1 + len(text or b"") for text in texts])), prepend=0)
    out = np.full(len(words) + len(texts), xxh3_64_intdigest(END), np.uint64)
    out[np.arange(len(words)) + np.repeat(np.arange(len(texts)), own)] = words
    return out, own + 1


def _slices(batch, column: int) -> Iterator[tuple[int, list[bytes | None]]]:
    import pyarrow as pa

    texts = batch.column(column).cast(pa.binary())
    for at in range(0, batch.num_rows, SLICE_ROWS):
        yield at, texts.slice(at, SLICE_ROWS).to_pylist()


def token_counts(docs: DataFrame) -> DataFrame:
    """token (digest), c: exact counts over all texts."""

    def count(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        held: list[tuple] = []
        size = 0

        def merged():
            tokens, where = np.unique(np.concatenate([t for t, _ in held]), return_inverse=True)
            return tokens, np.bincount(where, np.concatenate([c for _, c in held]), len(tokens)).astype(np.int64)

        out = lambda tokens, c: pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(c)], ["token", "c"])
        for batch in batches:
            for _, texts in _slices(batch, 0):
                held.append(np.unique(_digests(texts)[0], return_counts=True))
                size += len(held[-1][0])
                if size > FLUSH_TOKENS:
                    held = [merged()]
                    size = len(held[0][0])
                    if size > FLUSH_TOKENS // 2:
                        yield out(*held[0])
                        held, size = [], 0
        if held:
            yield out(*merged())

    return map_batches(docs.select("text"), count, "token long, c long").groupBy("token").agg(F.sum("c").alias("c"))


def class_tree(weights):
    """The WAY-ary tree of least mean depth over leaves of these weights.

    Returns for each leaf the slice of its steps (ptr), the class and member of each step, and the log shares of members by class.
    """
    import numpy as np

    n = len(weights)
    padding = -(n - 1) % (WAY - 1) if n > 1 else WAY - 1
    order = np.concatenate([np.arange(n, n + padding), np.argsort(weights, kind="stable")])
    mass = np.concatenate([np.asarray(weights, float), np.zeros(padding)])
    n_leaves = n + padding
    n_classes = (n_leaves - 1) // (WAY - 1)
    parent = np.full(n_leaves + n_classes, -1, np.int64)
    member = np.zeros(n_leaves + n_classes, np.uint8)
    bias = np.full((n_classes, WAY), -1e4, np.float32)
    leaves, sorted_mass, made = order.tolist(), mass[order].tolist(), []
    at = tail = 0
    for c in range(n_classes):
        own = []
        for _ in range(WAY):  # the lightest of the leaves left and the classes not yet placed
            if tail >= len(made) or (at < n_leaves and sorted_mass[at] <= made[tail]):
                own.append((leaves[at], sorted_mass[at]))
                at += 1
            else:
                own.append((n_leaves + tail, made[tail]))
                tail += 1
        total = sum(m for _, m in own)
        made.append(total)
        for k, (child, m) in enumerate(own):
            parent[child], member[child] = n_leaves + c, k
            if m > 0:
                bias[c, k] = math.log(m / total)
    steps, here = [], np.arange(n)
    alive = np.ones(n, bool)
    depth = np.zeros(n, np.int64)
    while alive.any():
        up = parent[here]
        alive = up >= 0
        steps.append((np.flatnonzero(alive), up[alive] - n_leaves, member[here[alive]]))
        depth[alive] += 1
        here = np.where(alive, up, here)
    ptr = np.concatenate([[0], np.cumsum(depth)])
    classes, members = np.empty(ptr[-1], np.int32), np.empty(ptr[-1], np.uint8)
    for d, (leaf, c, m) in enumerate(steps):
        classes[ptr[leaf] + d], members[ptr[leaf] + d] = c, m
    return ptr, classes, members, bias


def in_lines(shape: tuple, dtype):
    """Zeros that begin at a multiple of 128 bytes, so that no row of WAY numbers lies in more cache lines than it fills."""
    import numpy as np

    size = math.prod(shape) * np.dtype(dtype).itemsize
    raw = np.zeros(size + 128, np.uint8)
    at = -raw.ctypes.data % 128
    return raw[at : at + size].view(dtype).reshape(shape)


class Model:
    """The tree of the vocabulary, the counts of known tokens, and the weights; plain arrays, so that it can be broadcast.

    ``rest`` has for each bucket the sum of counts and the number of the tokens in it that are not known.
    """

    def __init__(self, tokens, counts, rest, total: int, distinct: int) -> None:
        import numpy as np

        self.total, self.distinct = total, distinct
        order = np.argsort(tokens)
        self.tokens, self.counts = tokens[order], counts[order]
        self.first = np.searchsorted(self.tokens >> np.uint64(64 - TOP_BITS), np.arange(2**TOP_BITS + 1, dtype=np.uint64))
        shares = rest[0] + 0.5 * (rest[1] + 1)  # unseen tokens count as one in each bucket
        self.bucket_logs = np.log10(shares)
        self.ptr, self.classes, self.members, self.bias = class_tree(np.concatenate([np.maximum(self.counts, 1), shares]))
        rows = 2 ** round(math.log2(max(1.0, ROWS_FACTOR * math.sqrt(total))))
        self.weights = np.zeros((min(MAX_ROWS, max(MIN_ROWS, rows)), WAY), np.float32)
        self.seen = np.zeros(len(self.weights))

    @classmethod
    def of(cls, parts: dict) -> Model:
        """The model of these attributes; they are what is broadcast, as executors need not have this module.

        Weights that don't begin at a cache line give way to a copy that does, in parts too, so that a worker holds them once.
        """
        if parts["weights"].ctypes.data % 128:
            own = in_lines(parts["weights"].shape, "f4")
            own[:] = parts["weights"]
            parts["weights"] = own
        model = cls.__new__(cls)
        model.__dict__.update(parts)
        return model

    def look_up(self, digests):
        """Leaf and count of each token; the count is -1 where only the full table may know it."""
        import numpy as np

        leaves = (digests & np.uint64(len(self.bucket_logs) - 1)).astype(np.int64) + len(self.tokens)
        counts = np.full(len(digests), -1, np.int64)
        # tokens stand by their top bits, so a token is a few places from the first of its kind
        top = (digests >> np.uint64(64 - TOP_BITS)).astype(np.int64)
        at, end = self.first[top], self.first[top + 1]
        open_ = np.flatnonzero(at < end)
        while len(open_):
            here = at[open_]
            hit = self.tokens[here] == digests[open_]
            found, place = open_[hit], here[hit]
            leaves[found], counts[found] = place, self.counts[place]
            at[open_] += 1
            open_ = open_[~hit & (here + 1 < end[open_])]
        return leaves, counts

    @staticmethod
    def contexts(digests, sizes):
        """Hashes of the token before, the one before that, and both, for each token."""
        import numpy as np

        p = [np.uint64(x) for x in PRIMES]
        before = np.concatenate([[np.uint64(START)], digests[:-1]])
        skip = np.concatenate([[np.uint64(START), np.uint64(START)], digests[:-2]])[: len(digests)]
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        before[first] = skip[first] = START
        second = first + 1
        skip[second[sizes > 1]] = START
        return [before * p[0], skip * p[2] + p[3], before * p[2] + skip * p[3]]

    def events(self, leaves, contexts):
        """The steps to the leaves of some tokens: owner (place of the token), member taken, class, rows of weights by feature."""
        import numpy as np

        start, n = self.ptr[leaves], self.ptr[leaves + 1] - self.ptr[leaves]
        owner = np.repeat(np.arange(len(leaves)), n)
        at = np.arange(len(owner)) + np.repeat(start - np.cumsum(n) + n, n)
        classes = self.classes[at]
        salt, p = classes.astype(np.uint64) * np.uint64(PRIMES[4]), [np.uint64(x) for x in PRIMES]
        shift, rows = np.uint64(65 - len(self.weights).bit_length()), []
        for context in contexts:
            x = context[owner]
            x += salt
            x ^= x >> np.uint64(31)
            x *= p[1]
            x ^= x >> np.uint64(29)
            x *= p[0]
            x >>= shift
            rows.append(x.view(np.int64))
        return owner, self.members[at], classes, rows

    def odds(self, classes, rows):
        """Logits of all members of each event's class, their exponentials and sums of these; weights are bounded, so none overflows."""
        import numpy as np

        logits = np.take(self.bias, classes, 0)
        own = np.empty_like(logits)
        for f in rows:
            logits += np.take(self.weights, f, 0, own, "clip")  # rows are in range; to raise it would take into a copy
        exp = np.exp(logits)
        return logits, exp, exp @ np.ones(WAY, np.float32)

    def gradient(self, digests, sizes, sums, seen) -> None:
        """Add the gradients of texts to sums (rows of weights by member, 64-bit floats), and the events of each row to seen."""
        import numpy as np

        leaves, contexts = self.look_up(digests)[0], self.contexts(digests, sizes)
        pairs = sums.view(np.complex128)  # two members are added at once
        for at in range(0, len(digests), BATCH):
            cut = slice(at, at + BATCH)
            _, taken, classes, rows = self.events(leaves[cut], [c[cut] for c in contexts])
            _, exp, total = self.odds(classes, rows)
            exp /= total[:, None]
            exp[np.arange(len(taken)), taken] -= 1
            parts = exp.view(np.complex64).T.astype(np.complex128, order="C")
            for row in rows:
                np.add.at(seen, row, 1.0)
                for k, part in enumerate(parts):
                    np.add.at(pairs[:, k], row, part)

    def step(self, sums, seen) -> None:
        import numpy as np

        self.seen += seen
        for at in range(0, len(self.weights), BLOCK_ROWS):  # in blocks, as the driver is small
            own = slice(at, at + BLOCK_ROWS)
            move = np.clip(RATE * sums[own] / (self.seen[own] + DAMPING)[:, None], -MAX_STEP, MAX_STEP)
            self.weights[own] = np.clip(self.weights[own] - move, -MAX_WEIGHT, MAX_WEIGHT)

    def score(self, digests, sizes):
        """For each token: modelled log10 probability, without its smoothed count where it shares a bucket, and its count as look_up says."""
        import numpy as np

        leaves, counts = self.look_up(digests)
        contexts = self.contexts(digests, sizes)
        out = np.empty(len(digests))
        for at in range(0, len(digests), BATCH):
            cut = slice(at, at + BATCH)
            owner, taken, classes, rows = self.events(leaves[cut], [c[cut] for c in contexts])
            logits, _, total = self.odds(classes, rows)
            logs = logits[np.arange(len(taken)), taken].astype(np.float64) - np.log(total)
            out[cut] = np.bincount(owner, logs, len(out[cut]))
        out /= math.log(10)
        rare = leaves >= len(self.tokens)
        out[rare] -= self.bucket_logs[leaves[rare] - len(self.tokens)]
        return out, counts


def most_frequent(counts: DataFrame):
    """Up to KNOWN_WORDS tokens and their counts.

    A histogram of count classes, a few thousand rows at most, says from which class on tokens fit;
    so no task gathers candidates of all others. Tokens of classes that don't fit whole are not known.
    """
    import numpy as np

    classed = counts.withColumn("class_", F.floor(F.log2("c") * 64))
    sizes = classed.groupBy("class_").agg(F.count("*").alias("n")).orderBy(F.desc("class_")).collect()
    least, n = None, 0
    for r in sizes:
        n += r.n
        if n > KNOWN_WORDS:
            break
        least = r.class_
    if least is None:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    found = classed.filter(F.col("class_") >= least).select("token", "c").toArrow()  # bounded
    return found.column(0).to_numpy().view(np.uint64), found.column(1).to_numpy()


def untrained(counts: DataFrame) -> Model:
    """The model of the counts alone."""
    import numpy as np

    said = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("total"), F.count("*").alias("n")).first()
    tokens, c = most_frequent(counts)
    buckets = min(MAX_BUCKETS, 2 ** max(0, math.ceil(math.log2(max(1, (said.n - len(tokens)) / BUCKET_TOKENS)))))
    rest = np.zeros((2, buckets))
    for r in counts.groupBy(F.col("token").bitwiseAND(F.lit(buckets - 1)).alias("b")).agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect():  # MAX_BUCKETS rows at most
        rest[:, r.b] = r.c, r.n
    own = (tokens & np.uint64(buckets - 1)).astype(np.int64)
    rest -= np.bincount(own, c, buckets), np.bincount(own, minlength=buckets)
    return Model(tokens, c, rest, said.total, said.n)


def gradient_sums(docs: DataFrame, model: Model):
    """Sums of gradients over the texts of docs, and events, by row of weights."""
    import numpy as np

    spark = docs.sparkSession
    shared, n_rows = spark.sparkContext.broadcast(model.__dict__), len(model.weights)

    def local(batches: Iterator) -> Iterator:
        import pyarrow as pa

        model, sums, seen = Model.of(shared.value), in_lines((n_rows, WAY), "f8"), np.zeros(n_rows)
        for batch in batches:
            for _, texts in _slices(batch, 0):
                model.gradient(*_digests(texts), sums, seen)
        for at in range(0, n_rows, BLOCK_ROWS):
            row = np.flatnonzero(seen[at : at + BLOCK_ROWS])
            if len(row):
                n = seen[at + row]
                mean = (sums[at + row] / n[:, None]).astype("<f2")
                yield pa.RecordBatch.from_arrays([pa.array([at])] + [pa.array([x], pa.binary()) for x in (row.astype("u1").tobytes(), n.astype("<f4").tobytes(), mean.tobytes())], ["block", "rows", "n", "mean"])

    def added(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held: dict[int, tuple] = {}
        for batch in batches:
            for block, row, n, mean in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sums, seen = held.setdefault(block, (np.zeros((BLOCK_ROWS, WAY)), np.zeros(BLOCK_ROWS)))
                row, n = np.frombuffer(row, "u1"), np.frombuffer(n, "<f4").astype(np.float64)
                sums[row] += np.frombuffer(mean, "<f2").reshape(-1, WAY) * n[:, None]
                seen[row] += n
        for block, (sums, seen) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([block]), *(pa.array([x.astype("<f4").tobytes()], pa.binary()) for x in (seen, sums))], ["block", "n", "sums"])

    # a task hands on its sums once, so it should have many tokens
    tasks = max(spark.sparkContext.defaultParallelism, -(-model.total // (ROUNDS * TASK_TOKENS)))
    parts = map_batches(docs.select("text").coalesce(tasks), local, "block long, rows binary, n binary, mean binary").repartition(max(1, min(32, n_rows // BLOCK_ROWS)), "block")
    sums, seen = np.zeros((n_rows, WAY), np.float32), np.zeros(n_rows, np.float32)
    for r in map_batches(parts, added, "block long, n binary, sums binary").collect():  # the rows of weights once
        seen[r.block : r.block + BLOCK_ROWS] = np.frombuffer(bytes(r.n), "<f4")
        sums[r.block : r.block + BLOCK_ROWS] = np.frombuffer(bytes(r.sums), "<f4").reshape(-1, WAY)
    shared.unpersist()
    return sums, seen


def train(docs: DataFrame, counts: DataFrame) -> Model:
    """The model of all texts of docs (doc_id, text); counts are their token_counts."""
    model = untrained(counts)
    for turn in range(ROUNDS):
        model.step(*gradient_sums(docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(ROUNDS)) == turn), model))
    return model


SCORED = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_sum double, model_sum double, rare array<long>"


def score_texts(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of rows (doc_id, text, held_out)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model.__dict__)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        model, row = Model.of(shared.value), TaskContext.get().partitionId() << 33
        for batch in batches:
            for at, texts in _slices(batch, 1):
                digests, sizes = _digests(texts)
                logs, counts = model.score(digests, sizes)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                total = lambda x: np.bincount(owner, x, len(sizes))  # noqa: E731, B023
                known = counts >= 0
                rare = digests[~known].view(np.int64)
                ends = np.concatenate([[0], np.cumsum(total(~known))]).astype(np.int32)
                columns = [
                    pa.array(row + np.arange(len(sizes))), batch.column(0).slice(at, len(sizes)), batch.column(2).slice(at, len(sizes)), pa.array(sizes.astype(np.int64)),
                    pa.array(total(counts > 0).astype(np.int64)), pa.array(total(np.where(known, np.log10(np.maximum(counts, 0) + 0.5), 0.0))), pa.array(total(logs)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(rare)),
                ]
                row += len(sizes)
                yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in SCORED.split(", ")])

    scored = written(map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "held_out"), run, SCORED), "lm-scored")
    rare = scored.select("row", F.explode("rare").alias("token")).groupBy("row", "token").agg(F.count("*").alias("n"))
    found = rare.join(counts, "token", "left").groupBy(F.col("row").alias("rare_row")).agg(F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more_known"), F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("more_sum"))
    joined = scored.drop("rare").join(found, scored.row == found.rare_row, "left")
    more = F.coalesce("more_sum", F.lit(0.0))
    whole = math.log10(model.total + 0.5 * (model.distinct + 1))
    return joined.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base_sum") + more - F.col("n_tokens") * whole).alias("base_score"), (F.col("model_sum") + more).alias("score"),
    )


def op7_maxent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    training = docs.filter("not held_out")
    counts = written(token_counts(training), "token-counts")
    return score_texts(docs, train(training, counts), counts)
