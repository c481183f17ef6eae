"""Best-fit packing of tokenised documents, planned on the histogram of piece lengths.

The plan never sees documents: it places counts of equal lengths, largest first, into the
tightest bins that hold them, and bins with one history stay one group. A plan row says
"pieces of this length with ranks r0 .. r0+count-1 go to the bins from seq0 on, per_bin to a
bin, from this offset on". Pieces then find their slot by a join on length and rank.

Null texts count as empty and give one piece, the end id. Repeated rows are packed each. Words of any
length are coded; only those of CACHE_BYTES at most are remembered, so memory is bounded in bytes. An empty table gives an empty result. Other columns of the input are left out.
"""

from __future__ import annotations

import os
import re
import string
import zlib
from bisect import bisect_left, insort
from collections.abc import Collection, Iterator
from itertools import chain

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_batches, table, written

CAPACITY = 4096
END_ID = 1
#: Words whose ids a worker remembers in each of two generations; the older one is dropped when the newer is full.
CACHE_WORDS = 500_000
#: Longer words, in bytes, are forgotten with the slice that holds them.
CACHE_BYTES = 64
#: Between Latin letters and marks after them the tokenizer always splits; the last id of each part, and no other, ends a word.
PLAIN = r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+"
MARKS = string.punctuation
#: Ranks are counted in shards of about so many pieces of one length.
SHARD_PIECES = 50_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLAN = "length long, rank0 long, count long, seq0 long, per_bin long, offset0 long"


def plan_best_fit(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit decreasing over counts: rows of PLAN."""
    rows: list[tuple[int, int, int, int, int, int]] = []
    groups: dict[int, list[tuple[int, int]]] = {}  # room left -> (first bin, bins)
    rooms: list[int] = []
    bins = 0

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in groups:
                insort(rooms, room)
                groups[room] = []
            groups[room].append((first, n))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = groups[room].pop()
                if not groups[room]:
                    del groups[room]
                    rooms.pop(at)
            else:
                room, first, n = capacity, bins, -(-left // (capacity // length))
                bins += n
            per_bin = room // length
            full = min(n, left // per_bin)
            placed = full * per_bin if full else left
            rows.append((length, rank, placed, first, per_bin, capacity - room))
            if full:
                put(room - per_bin * length, first, full)
                put(room, first + full, n - full)
            else:
                put(room - placed * length, first, 1)
                put(room, first + 1, n - 1)
            left -= placed
            rank += placed
    return rows


def byte_letters() -> str:
    """The character that stands for each of the 256 bytes in vocabularies of byte-level tokenizers."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return "".join(chr(b if b in shown else next(others)) for b in range(256))


def split_words(texts):
    """Words of each text (an Arrow array of strings; null: none); in lower case, as the tokenizer has them, unless a special token may be meant.

    White space at an end of a text gives an empty word, which has no ids.
    """
    import pyarrow.compute as pc

    texts = pc.fill_null(texts, "")
    return pc.ascii_split_whitespace(pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts)))


class WordIds:
    """Ids of a tokenizer's words as bytes, little-endian and 32 bits each, remembered for a while.

    The tokenizer's ids of a text are those of its space-separated words one after the other. New
    plain words go to it many to a string and are told apart by its word-end ids. In these the own tokenizer's
    normaliser and splitting pattern find nothing to do but lower case and bytes, so its merges get them bare.
    """

    def __init__(self, tokenizer_path: str | None, cache_words: int | None = None) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import numpy as np
        import public_tokenizers
        from tokenizers import Tokenizer, pre_tokenizers

        self.model = Tokenizer.from_file(tokenizer_path or public_tokenizers.path("word_bpe_49k.json"))
        self.merges = None
        if tokenizer_path is None:
            self.merges = Tokenizer(self.model.model)
            self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        letters = byte_letters()
        self.letters = letters[:32] + " " + letters[33:]
        self.ends = np.zeros(self.model.get_vocab_size(), bool)
        self.ends[[i for token, i in self.model.get_vocab().items() if token.endswith("</w>")]] = True
        self.plain = re.compile(PLAIN).fullmatch
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.marks: dict[str, bytes] = {}
        self.long: list[bytes] = []
        self.cache_words = cache_words or CACHE_WORDS

    def _coded(self, texts: list[str]) -> list[bytes]:
        import numpy as np

        return [np.array(e.ids, "<u4").tobytes() for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _coded_plain(self, words: list[str]) -> list[bytes]:
        import codecs

        import numpy as np

        if not words:
            return []
        lines = [" ".join(words[k : k + 256]) for k in range(0, len(words), 256)]
        if self.merges:
            lines = [codecs.charmap_decode(line.lower().encode(), "strict", self.letters)[0] for line in lines]
        ids = np.fromiter(chain.from_iterable(e.ids for e in (self.merges or self.model).encode_batch_fast(lines, add_special_tokens=False)), "<u4")
        stops = (np.flatnonzero(self.ends[ids]) + 1) * 4
        if len(stops) != len(words):
            return self._coded(words)
        flat = ids.tobytes()
        return [flat[i:k] for i, k in zip([0, *stops[:-1].tolist()], stops.tolist(), strict=True)]

    def learn(self, words: Collection[bytes]) -> list[bytes]:
        """The ids of distinct words, in their order; ``known`` holds them until the next call, and those of words that are not long for a while."""
        for word in self.long:
            self.known.pop(word, None)
        found = list(map(self.known.get, words))
        new = [w for w, ids in zip(words, found, strict=True) if ids is None]
        if len(self.known) + len(new) > self.cache_words:
            self.older, self.known, new = self.known, {}, [*words]  # no long words are left here
        self.long = [w for w in new if len(w) > CACHE_BYTES]
        fresh: list[bytes] = []
        for word, ids in zip(new, map(self.older.get, new), strict=True):
            if ids is None:
                fresh.append(word)
            else:
                self.known[word] = ids
        texts = b"\n".join(fresh).decode("utf-8", "replace").split("\n") if fresh else []
        marked: list[tuple[bytes, bytes, str]] = []
        others: list[tuple[bytes, str]] = []
        wanted: dict[bytes, str] = {}
        for word, text in zip(fresh, texts, strict=True):
            if text.isascii() and text.isalpha():
                wanted[word] = text
                continue
            core = text.rstrip(MARKS)
            if not (core.isalpha() if core.isascii() else self.plain(core)):
                others.append((word, text))
            elif len(core) == len(text):
                wanted[word] = text
            else:
                key = word[: len(core) - len(text)]
                marked.append((word, key, text[len(core) :]))
                if key not in self.known:
                    wanted[key] = core
                    if len(key) > CACHE_BYTES:
                        self.long.append(key)
        self.known.update(zip(wanted, self._coded_plain([*wanted.values()]), strict=True))
        for k in range(0, len(others), 4096):
            part = others[k : k + 4096]
            self.known.update(zip([w for w, _ in part], self._coded([t for _, t in part]), strict=True))
        for word, key, mark in marked:
            if len(mark) <= CACHE_BYTES and mark not in self.marks and len(self.marks) < self.cache_words:
                self.marks[mark] = self._coded([mark])[0]
            self.known[word] = self.known[key] + (self.marks[mark] if mark in self.marks else self._coded([mark])[0])
        return [self.known[w] if ids is None else ids for w, ids in zip(words, found, strict=True)]

    def split(self, text: bytes) -> list[bytes]:
        """split_words of one text, in UTF-8."""
        import pyarrow as pa

        return split_words(pa.array([text], pa.binary()).view(pa.string())).flatten().view(pa.binary()).to_pylist()

    def code(self, texts):
        """The ids of some texts (an Arrow array of strings), all in one buffer, and where in it each one's begin and the last one's end, in bytes."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        split = split_words(texts)
        found = split.flatten().dictionary_encode()
        n = len(found.dictionary)
        words = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), found.dictionary.cast(pa.binary())), b"\n")[0].as_py().split(b"\n") if n else []
        ids = pa.array(self.learn(words), pa.large_binary()).take(found.indices)
        _, ends, held = ids.buffers()
        starts = np.frombuffer(ends, np.int64)[split.offsets.to_numpy()] if len(ids) else np.zeros(len(texts) + 1, np.int64)
        return memoryview(held or b""), starts.tolist()


def _worker_words(tokenizer_path: str | None, cache_words: int) -> WordIds:
    """The WordIds of this Python process, which later tasks of a worker find filled; functions travel by value, so it lives in a module of its own."""
    import sys
    import types

    held = sys.modules.setdefault("_dwellspan_words", types.ModuleType("_dwellspan_words")).__dict__
    key = (tokenizer_path, cache_words)
    if held.get("key") != key:
        held.update(key=key, words=WordIds(tokenizer_path, cache_words))
    return held["words"]


def pieces(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, cache_words: int = CACHE_WORDS, keep_words: bool = True) -> DataFrame:
    """Tokenise doc_id and text, add the end id and cut what is longer than capacity.

    A task remembers twice cache_words words; with keep_words they stay in the worker for its later tasks.
    """

    def cut(batches: Iterator) -> Iterator:
        import gc

        import numpy as np
        import pyarrow as pa

        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        gc.disable()  # no cycles arise here, and the collector would walk the remembered words again and again
        model = _worker_words(tokenizer_path, cache_words) if keep_words else WordIds(tokenizer_path, cache_words)
        end, step = np.array([end_id], "<u4").tobytes(), 4 * capacity
        for batch in batches:
            if not batch.num_rows:
                continue
            held, starts = model.code(batch.column(1))
            out: list[tuple] = []
            for doc_id, at, upto in zip(batch.column(0).to_pylist(), starts, starts[1:]):
                coded = b"".join((held[at:upto], end))
                for n, start in enumerate(range(0, len(coded), step)):
                    one = coded[start : start + step]
                    out.append((doc_id, n, start // 4, len(one) // 4, zlib.crc32(one)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return map_batches(docs.select("doc_id", "text"), cut, PIECES)


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to rows of PIECES.

    Only the histogram, of at most ``capacity`` rows, reaches the driver. The plan has a few rows
    for each length and is broadcast.
    """
    spark = cut.sparkSession
    cut = written(cut, "pieces")
    histogram = {r.length: r.n for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = spark.createDataFrame(plan_best_fit(histogram, capacity), PLAN)
    shards = spark.createDataFrame([(k, -(-n // SHARD_PIECES)) for k, n in histogram.items()], "length long, shards long")
    dealt = cut.join(F.broadcast(shards), "length").withColumn("shard", F.expr("pmod(xxhash64(doc_id, piece), shards)"))
    before = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("length", "shard").agg(F.count("*").alias("n")).select("length", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "shard").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = dealt.withColumn("inside", F.row_number().over(inside)).join(starts, ["length", "shard"]).withColumn("rank", F.expr("first + inside - 1"))
    return (
        ranked.join(F.broadcast(plan), (ranked.length == plan.length) & (F.col("rank") >= F.col("rank0")) & (F.col("rank") < F.col("rank0") + F.col("count")))
        .select(
            "doc_id", "piece", "start", ranked.length.alias("length"), "ids_crc32",
            F.expr("seq0 + (rank - rank0) div per_bin").alias("sequence_id"),
            (F.col("offset0") + F.expr("(rank - rank0) % per_bin") * ranked.length).alias("offset"),
        )
    )


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(pieces(table(spark, sf_dir, "documents")))
