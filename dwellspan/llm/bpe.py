"""BPE encoding of distinct words over a trie, and decoding.

The encoding of a word's prefix ends in one token only, the state of that prefix in a trie of words:
the token t for which the state of the prefix without t and t lie side by side unmerged. A depth-first
walk hands the states down, so what two words begin with is coded once. Whether two tokens stay apart
is told from their own merges: some pair of tokens that once stood at the border would have merged
while both were there, or none would.

A batch's new distinct words are sorted, which is the order in which the walk meets the leaves of their trie;
the stack holds the states of the present path, so memory is that of the longest word.

Null and empty texts have no ids and decode to an empty text. Repeated rows are coded each. Words of any length are coded; those of
CACHE_BYTES at most are remembered for later batches of the task, CACHE_WORDS twice at most. An empty table
gives an empty result. Other columns of the input are left out, whatever their names.
"""

from __future__ import annotations

import json
import re
from collections.abc import Collection, Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, table
from .packing import CACHE_BYTES, CACHE_WORDS, WordIds, byte_letters

#: The pieces into which the own tokenizer splits an ASCII word in lower case.
ASCII_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ a-z0-9]+"
#: Pairs of tokens that are remembered as staying apart or not.
MOST_PAIRS = 1_000_000
#: Stands behind a word whose last letter is a symbol of its own.
END = "\n"
NEVER = 1 << 60


class Merges:
    """A BPE vocabulary, and the ids of a set of pieces (strings of byte letters) by a walk over their trie."""

    def __init__(self, model: dict) -> None:
        if model.get("type") != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "fuse_unk", "ignore_merges")):
            raise ValueError("only plain BPE vocabularies are supported")
        suffix = model.get("end_of_word_suffix") or ""
        self.ends = bool(suffix)
        merges = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model["merges"]]

        def inner(token: str) -> str:
            return token[: -len(suffix)] + END if suffix and token.endswith(suffix) else token

        self.ids = {inner(t): i for t, i in model["vocab"].items()}
        self.rank = {(inner(a), inner(b)): n for n, (a, b) in enumerate(merges)}
        self.parts: dict[str, tuple[str, str]] = {}
        made_of = {a + b for a, b in self.rank}
        for pair in self.rank:
            joined = pair[0] + pair[1]
            if joined in self.parts or any(p in made_of and p not in self.parts for p in pair):
                raise ValueError(f"the merges aren't in order: {pair}")  # the walk rests on merges of parts made before
            self.parts[joined] = pair
        self.right: dict[str, list] = {}
        self.left: dict[str, list] = {}
        self.apart: dict[tuple[str, str], bool] = {}
        #: Tokens that stand for themselves; no text is coded with others.
        self.usable = {t for t in self.ids if t not in self.parts}
        self.usable |= {t for t, (a, b) in self.parts.items() if t in self.ids and self._border(a, b) == self.rank[a, b]}
        lengths: dict[str, set[int]] = {}
        for t in self.usable:
            lengths.setdefault(t[-2:] if not t.endswith(END) else t[-3:], set()).add(len(t) - t.endswith(END))
        #: How long tokens with these last two symbols may be, longest first; one symbol is a token of its own.
        self.lengths = {tail: sorted(n | {1}, reverse=True) for tail, n in lengths.items()}

    def _edge(self, token: str, side: int) -> list[tuple[str, int]]:
        """Tokens at a side of this one from the first symbol on, each with the rank of the merge that ends it."""
        held = (self.left, self.right)[side]
        if token not in held:
            chain, ends, at = [], NEVER, token
            while True:
                chain.append((at, ends))
                if at not in self.parts:
                    break
                ends = self.rank[self.parts[at]]
                at = self.parts[at][side]
            held[token] = chain[::-1]
        return held[token]

    def _border(self, a: str, b: str) -> int | None:
        """The rank of the first merge across the border of a and b, each merged by itself."""
        left, right, i, j = self._edge(a, 1), self._edge(b, 0), 0, 0
        while True:
            (x, x_ends), (y, y_ends) = left[i], right[j]
            n = self.rank.get((x, y))
            # of equal pairs the leftmost merges first: the one within a before the border, the border before the one within b
            if n is not None and n < x_ends and n <= y_ends:
                return n
            if x_ends == NEVER and y_ends == NEVER:
                return None
            i, j = i + (x_ends <= y_ends), j + (y_ends <= x_ends)

    def _state(self, word: str, at: int, last: list[str], end: str) -> str:
        """The last token of the encoding of word[:at] + end."""
        apart, ids, usable = self.apart, self.ids, self.usable
        for n in self.lengths.get(word[at - 2 if at > 1 else 0 : at] + end, (1,)):
            if n > at:
                continue
            token = word[at - n : at] + end
            if token not in usable:
                continue
            if n == at:
                return token
            pair = (last[at - n], token)
            fits = apart.get(pair)
            if fits is None:
                if len(apart) >= MOST_PAIRS:
                    apart.clear()
                fits = apart[pair] = self._border(*pair) is None
            if fits:
                return token
        raise ValueError(f"no token ends {word[max(at - 20, 0) : at]!r}; known ids: {len(ids)}")

    def encode(self, pieces: Iterable[str]) -> dict[str, list[int]]:
        """The ids of each distinct piece."""
        out: dict[str, list[int]] = {}
        ids, ends, state = self.ids, self.ends, self._state
        last = [""]  # last[n]: the state of the first n symbols of the present path
        before = ""
        for piece in sorted(pieces):
            if not piece:
                out[piece] = []
                continue
            inner = len(piece) - ends
            shared, most = 0, min(len(before), inner, len(last) - 1)
            while shared < most and piece[shared] == before[shared]:
                shared += 1
            del last[shared + 1 :]
            for at in range(shared + 1, inner + 1):
                last.append(state(piece, at, last, ""))
            before = piece
            token, at, found = state(piece, len(piece), last, END) if ends else last[inner], len(piece), []
            while True:
                found.append(ids[token])
                at -= len(token) - token.endswith(END) if ends else len(token)
                if not at:
                    break
                token = last[at]
            out[piece] = found[::-1]
        return out


class TrieIds(WordIds):
    """Ids of texts; the tokenizer's own normaliser and pattern split what is not plain, and all merging is done on the trie.

    With by_words, which only the own tokenizer takes, the ids of a text are those of its space-separated words one after the other.
    """

    def __init__(self, tokenizer_path: str | None = None, cache_words: int = CACHE_WORDS) -> None:
        import public_tokenizers
        from tokenizers import Tokenizer

        path = tokenizer_path or public_tokenizers.path("word_bpe_49k.json")
        with open(path, encoding="utf-8") as f:
            held = json.load(f)
        self.merges_of = Merges(held["model"])
        model = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = model.normalizer, model.pre_tokenizer
        added = held.get("added_tokens") or []
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("only added tokens that are found as they stand are supported")
        self.added = {t["content"]: t["id"] for t in added}
        self.added_in = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if added else None
        self.by_words = tokenizer_path is None
        self.find_ascii = re.compile(ASCII_PIECES).findall
        letters = byte_letters()
        self.odd = {b: letters[b] for b in range(256) if letters[b] != chr(b)}
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.cache_words = cache_words

    def _pieces(self, text: str) -> list[str | int]:
        """Pieces of a text in byte letters; an int is the id of an added token."""
        out: list[str | int] = []
        for part in self.added_in.split(text) if self.added_in else [text]:
            if part in self.added:
                out.append(self.added[part])
            elif part:
                part = self.normalizer.normalize_str(part) if self.normalizer else part
                out += [p for p, _ in self.pre_tokenizer.pre_tokenize_str(part)] if self.pre_tokenizer else [part]
        return out

    def _coded(self, texts: list[str]) -> list[bytes]:
        import numpy as np

        split: list[list[str | int]] = []
        for text in texts:
            if self.by_words and text.isascii() and "<|" not in text:
                found = self.find_ascii(text.lower())
                split.append(found if text.isprintable() else [p.translate(self.odd) for p in found])
            else:
                split.append(self._pieces(text))
        ids = self.merges_of.encode({p for part in split for p in part if isinstance(p, str)})
        flat = {p: np.array(i, "<u4").tobytes() for p, i in ids.items()} | {i: np.array([i], "<u4").tobytes() for i in self.added.values()}
        return [b"".join(map(flat.__getitem__, part)) for part in split]

    def learn(self, words: Collection[bytes]) -> list[bytes]:
        """The ids of distinct words, in their order; those that are not long are remembered."""
        found = [self.known.get(w) or self.older.get(w) for w in words]
        new = [w for w, ids in zip(words, found, strict=True) if ids is None]
        if new:
            fresh = dict(zip(new, self._coded([w.decode("utf-8", "replace") for w in new]), strict=True))
            found = [fresh[w] if ids is None else ids for w, ids in zip(words, found, strict=True)]
        if len(self.known) + len(new) > self.cache_words:
            self.older, self.known = self.known, {}
        self.known.update([x for x in zip(words, found, strict=True) if len(x[0]) <= CACHE_BYTES][: self.cache_words])
        return found

    def code(self, texts):
        """The ids of some texts (an Arrow array of strings), all in one buffer, and where in it each one's begin and the last one's end, in bytes."""
        if self.by_words:
            return super().code(texts)
        coded, starts = self._coded([t or "" for t in texts.to_pylist()]), [0]
        for one in coded:
            starts.append(starts[-1] + len(one))
        return memoryview(b"".join(coded)), starts


def encode(docs: DataFrame, tokenizer_path: str | None = None, cache_words: int = CACHE_WORDS) -> DataFrame:
    """doc_id and the ids of each text, little-endian and 32 bits each."""

    def run(batches: Iterator) -> Iterator:
        import gc

        import pyarrow as pa

        gc.disable()  # no cycles arise here
        model = TrieIds(tokenizer_path, cache_words)
        for batch in batches:
            if batch.num_rows:
                held, starts = model.code(batch.column(1))
                ids = pa.array([bytes(held[a:b]) for a, b in zip(starts, starts[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, ids binary")


def decoder(tokenizer_path: str | None = None):
    """A function from an Arrow array of ids (binary) to their texts; special tokens stay."""
    import numpy as np
    import public_tokenizers
    import pyarrow as pa
    import pyarrow.compute as pc

    with open(tokenizer_path or public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        held = json.load(f)
    kind = (held.get("decoder") or {}).get("type")
    if kind not in (None, "ByteLevel"):
        raise ValueError(f"no decoder of kind {kind}")
    tokens = {i: t for t, i in held["model"]["vocab"].items()} | {t["id"]: t["content"] for t in held.get("added_tokens") or []}
    texts = [tokens.get(i) for i in range(max(tokens) + 1)]
    if kind == "ByteLevel":
        back = {c: b for b, c in enumerate(byte_letters())}
        texts = [None if t is None else bytes(map(back.__getitem__, t)) if all(c in back for c in t) else t.encode() for t in texts]
    vocabulary = pa.array([None if t is None else t.encode() if isinstance(t, str) else t for t in texts], pa.binary())

    def texts_of(ids):
        _, ends, data = ids.buffers()
        at = np.frombuffer(ends, np.int32)[ids.offset : ids.offset + len(ids) + 1]
        flat = np.frombuffer(data, "<u4", (at[-1] - at[0]) // 4, at[0]) if len(ids) and at[-1] > at[0] else np.zeros(0, "<u4")
        shown = pa.ListArray.from_arrays(pa.array((at - at[0]) // 4, pa.int32()), vocabulary.take(pa.array(flat)))
        joined = pc.binary_join(shown, b"" if kind else b" ")
        return pa.array([t.decode("utf-8", "replace") for t in joined.to_pylist()], pa.string()) if kind else joined.cast(pa.string())

    return texts_of


def decode(coded: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """doc_id, ids and the text that these ids stand for; ids as ``encode`` gives them."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        texts_of = decoder(tokenizer_path)
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts_of(batch.column(1))], ["doc_id", "ids", "text"])

    return map_batches(coded.select("doc_id", F.coalesce("ids", F.lit(b"")).alias("ids")), run, "doc_id long, ids binary, text string")


def op11_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = decode(encode(table(spark, sf_dir, "documents")))
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
