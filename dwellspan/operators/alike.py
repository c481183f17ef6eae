"""Which strings of two tables are alike by the Ratcliff-Obershelp ratio, without comparing all of them.

Strings are dealt in chunks and blocks of bounded size, by key; chunk and block meet by an equi-join, so neither side is collected and
one key may hold any share of the rows. A block is an inverted index of its strings' 1-grams, each numbered by
its occurrence: the grams that two strings share, counted for a whole chunk by one matrix product, and their lengths bound
the ratio from above, as its blocks hold shared letters only. Pairs that pass are held against the longest common subsequence, which bounds it too (the
blocks stand in one order in both) and takes a few machine words a pair. Only what passes both is compared in full, so no pair is lost.

Longer grams would lose pairs: strings of ratio 0.6 need not share two letters in a row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from difflib import SequenceMatcher
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Strings in a chunk of the left side and in a block of the right one, about.
CHUNK, BLOCK = 2048, 16384
#: Left strings whose bounds stand in memory at a time, and right ones that are looked at first for a good score.
SLICE, FIRST = 128, 24
#: The longest strings that the bound by subsequences takes; longer ones are held against the letters only.
WORD = 64


class Held(NamedTuple):
    """A string that holds the other counts as at least ``fit``, if the left one has some letters and some share of the right one's."""

    fit: float
    chars: int = 1
    share: float = 0.0


def ratio(a: str, b: str) -> float:
    """The similarity of a to b; that of two empty strings is 1."""
    return SequenceMatcher(None, a, b).ratio() if a or b else 1.0


def similarity(a: str, b: str, held: Held | None = None) -> float:
    fit = ratio(a, b)
    if held and len(a) >= max(held.chars, held.share * len(b)) and (a in b or b in a):
        fit = max(fit, held.fit)
    return fit


def _coded(strings: Sequence[str], code: dict[str, int], most: int):
    """Codes of letters of each string, 0 behind its end and for letters that the other side has not."""
    import numpy as np

    out = np.zeros((len(strings), most), np.int32)
    for row, s in zip(out, strings, strict=True):
        own = [code.get(c, 0) for c in s[:most]]
        row[: len(own)] = own
    return out


def _grams(strings: Sequence[str], at: dict[tuple[str, int], int]):
    import numpy as np

    out = np.zeros((len(strings), len(at)), np.float32)
    for row, s in zip(out, strings, strict=True):
        seen: dict[str, int] = {}
        for c in s:
            n = seen[c] = seen.get(c, -1) + 1
            k = at.get((c, n))
            if k is not None:
                row[k] = 1
    return out


class Index:
    """An inverted index of strings by their letters."""

    def __init__(self, strings: Sequence[str]) -> None:
        import numpy as np

        self.strings = list(strings)
        self.length = np.array([len(s) for s in strings], np.int64)
        most: dict[str, int] = {}
        for s in self.strings:
            for c in set(s):
                most[c] = max(most.get(c, 0), s.count(c))
        self.at = {g: k for k, g in enumerate((c, n) for c in sorted(most) for n in range(most[c]))}
        self.grams = np.ascontiguousarray(_grams(self.strings, self.at).T)
        self.code = {c: k for k, c in enumerate(sorted(most), 1)}
        self.codes = _coded(self.strings, self.code, min(WORD, int(self.length.max(initial=0))))
        #: Pairs whose similarity was computed in full, and all pairs.
        self.compared = self.pairs = 0

    def _subsequence(self, masks, left, right):
        """Lengths of the longest common subsequences of pairs of left and right strings of WORD letters at most."""
        import numpy as np

        held, codes, lengths = np.full(len(left), ~np.uint64(0)), self.codes[right], self.length[right]
        for at in range(int(lengths.max(initial=0))):
            same = masks[left, codes[:, at]]
            shared = held & same
            held = (held + shared) | (held - shared)
        return np.bitwise_count(~held).astype(np.int64)

    def alike(self, strings: Sequence[str], least: float, margin: float | None, held: Held | None) -> Iterator[tuple[int, int, float]]:
        """(left, right, similarity) of pairs: all of at least ``least``, or with a margin those that lie that close to the left one's best here."""
        import numpy as np

        if not self.strings:
            return
        for start in range(0, len(strings), SLICE):
            part = list(strings[start : start + SLICE])
            length = np.array([len(s) for s in part], np.int64)
            masks = np.zeros((len(part), len(self.code) + 1), np.uint64)
            for k, s in enumerate(part):
                for n, c in enumerate(s[:WORD]):
                    masks[k, self.code.get(c, 0)] |= np.uint64(1 << n)
            masks[:, 0] = 0
            shared = _grams(part, self.at) @ self.grams
            total = length[:, None] + self.length[None, :]
            self.pairs += shared.size
            may_hold = np.zeros(shared.shape, bool)
            if held:
                may_hold = (shared == np.minimum(length[:, None], self.length[None, :])) & (length[:, None] >= np.maximum(held.chars, held.share * self.length[None, :]))
            bound = np.where(total == 0, 1.0, 2 * shared / np.maximum(total, 1)).astype(np.float64)
            bound[may_hold] = np.maximum(bound[may_hold], held.fit if held else 0)

            def closer(left, right, masks=masks, length=length, bound=bound, may_hold=may_hold, total=total):
                """The tighter bound of pairs."""
                out = bound[left, right]
                short = np.flatnonzero((length[left] <= WORD) & (self.length[right] <= WORD) & (total[left, right] > 0))
                own_left, own_right = left[short], right[short]
                most = self._subsequence(masks, own_left, own_right)
                tight = 2 * most / total[own_left, own_right]
                whole = may_hold[own_left, own_right] & (most == np.minimum(length[own_left], self.length[own_right]))
                out[short] = np.where(whole, np.maximum(tight, held.fit if held else 0), tight)
                return out

            known: dict[tuple[int, int], float] = {}

            def fit(i: int, j: int, part=part, known=known) -> float:
                if (i, j) not in known:
                    self.compared += 1
                    known[i, j] = similarity(part[i], self.strings[j], held)
                return known[i, j]

            best = np.full(len(part), float(least))
            if margin is not None:
                few = min(FIRST, len(self.strings))
                first = np.argpartition(-bound, few - 1, axis=1)[:, :few]
                left = np.repeat(np.arange(len(part)), few)
                near = closer(left, first.ravel()).reshape(len(part), few)
                for i, k in enumerate(near.argmax(axis=1).tolist()):
                    best[i] = max(fit(i, int(first[i, k])) - margin - 1e-9, best[i])
            left, right = np.nonzero(bound >= best[:, None])
            near = closer(left, right)
            kept = np.flatnonzero(near >= best[left])
            kept = kept[np.lexsort((-near[kept], left[kept]))]
            found: list[tuple[int, int, float]] = []
            for i, j, top in zip(left[kept].tolist(), right[kept].tolist(), near[kept].tolist(), strict=True):
                if top >= best[i]:  # the best one so far may have risen
                    own = fit(i, j)
                    found.append((i, j, own))
                    if margin is not None:
                        best[i] = max(best[i], own - margin - 1e-9)
            yield from ((start + i, j, own) for i, j, own in found if own >= best[i])


def _dealt(rows: DataFrame, keys: Sequence[str], text: str, size: int, part: str, many: str) -> DataFrame:
    """Strings of each key in lists of about this many: keys, the list's number, how many the key has, the list."""
    counts = rows.groupBy(*keys).agg(F.ceil(F.count("*") / size).cast("int").alias(many)) if keys else rows.agg(F.ceil(F.count("*") / size).cast("int").alias(many))
    held = rows.join(counts, list(keys)) if keys else rows.crossJoin(F.broadcast(counts))  # one row
    number = F.pmod(F.xxhash64(text), F.col(many)).cast("int")
    return held.groupBy(*keys, number.alias(part), many).agg(F.collect_list(text).alias(text))


def alike(left: DataFrame, right: DataFrame, keys: Sequence[str] = (), least: float = 0.0, margin: float | None = None, held: Held | None = None, chunk: int = CHUNK, block: int = BLOCK, counts: bool = False) -> DataFrame:
    """keys, a, b and fit of pairs of strings a of left and b of right in each key, each distinct and not null; keys are not null.

    All pairs of a similarity of at least ``least``; with a margin, of these at least those that are within it of the best one of a, and
    maybe others. With counts, the last row of each task has how many pairs it met (fit) and compared (b, as text) in place of strings.
    """
    keys = list(keys)
    chunks = _dealt(left.select(*keys, "a").where("a is not null").distinct(), keys, "a", chunk, "chunk_", "chunks_")
    blocks = _dealt(right.select(*keys, "b").where("b is not null").distinct(), keys, "b", block, "block_", "blocks_")
    many = blocks.select(*keys, "blocks_").distinct()
    wide = chunks.join(many, keys) if keys else chunks.crossJoin(F.broadcast(many))  # one row
    met = wide.select(*keys, "chunk_", "a", F.explode(F.sequence(F.lit(0), F.col("blocks_") - 1)).alias("block_")).join(blocks.drop("blocks_"), [*keys, "block_"]).select(*keys, "a", "b")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in left.select(*keys).schema), "a string", "b string", "fit double"])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        pairs = compared = 0
        last: tuple[int, Index] | None = None
        for batch in batches:
            names = [*batch.schema.names[: len(keys)], "a", "b", "fit"]
            for at in range(batch.num_rows):
                own = batch.slice(at, 1)
                a, b = own.column(len(keys))[0].as_py(), own.column(len(keys) + 1)[0].as_py()
                if last is None or last[0] != hash(tuple(b)):
                    last = hash(tuple(b)), Index(b)
                index = last[1]
                before = index.pairs, index.compared
                found = list(index.alike(a, least, margin, held))
                pairs, compared = pairs + index.pairs - before[0], compared + index.compared - before[1]
                if found:
                    key = [own.column(k).take(pa.array([0] * len(found))) for k in range(len(keys))]
                    yield pa.RecordBatch.from_arrays([*key, pa.array([a[i] for i, _, _ in found]), pa.array([b[j] for _, j, _ in found]), pa.array([f for *_, f in found], pa.float64())], names)
        if counts:
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.string()), pa.array([str(compared)]), pa.array([float(pairs)])], ["a", "b", "fit"])

    return met.repartition(*keys, F.xxhash64("a"), F.xxhash64("b")).mapInArrow(run, schema)


def closest(left: DataFrame, right: DataFrame, held: Held | None = None) -> DataFrame:
    """a and fit: how alike the nearest string of right is, for each distinct string of left; 0 where right is empty."""
    own = left.select("a").where("a is not null").distinct()
    best = alike(own, right, margin=0.0, held=held).groupBy("a").agg(F.max("fit").alias("fit"))
    return own.join(best, "a", "left").select("a", F.coalesce("fit", F.lit(0.0)).alias("fit"))
