import random
import re
import string
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from dwellspan.llm.packing import CAPACITY, PLAIN, WordIds, op10_best_fit_packing, pack, pieces, plan_best_fit


@settings(deadline=None, max_examples=200)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 40), max_size=12), st.integers(30, 40))
def test_plan_places_every_item_once_without_overlap(histogram, capacity):
    bins: dict[int, list] = {}
    seen: dict[int, list] = {k: [] for k in histogram}
    for length, rank0, count, seq0, per_bin, offset0 in plan_best_fit(histogram, capacity):
        for r in range(count):
            bins.setdefault(seq0 + r // per_bin, []).append((offset0 + r % per_bin * length, length))
            seen[length].append(rank0 + r)
    assert {k: sorted(v) for k, v in seen.items()} == {k: list(range(n)) for k, n in histogram.items()}
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(k * n for k, n in histogram.items())
    # no two bins fit into one, as for any best fit
    assert len(bins) <= max(1, 2 * total // capacity + 1)


@settings(deadline=None, max_examples=100)
@given(st.lists(st.text(alphabet="aBzÉßİıǅΣσ'sré .,!? \t\n\x0b\x1c\xa0　<|>endoftext01²½文", max_size=60), max_size=8))
def test_words_give_the_tokenizers_ids(texts):
    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ours = WordIds(None)
    for text in [*texts, "x<|endoftext|>y", "<|ENDOFTEXT|> don't, 's we'll. a., b!,"]:
        words = ours.split(text.encode())
        ours.learn(set(words))
        got = np.frombuffer(b"".join(ours.known[w] for w in words), "<u4").tolist()
        assert got == model.encode(text, add_special_tokens=False).ids


@settings(deadline=None, max_examples=100)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aBzÉßİıǅΣσ'sré .,&#* \t\n\x0b\x1c\xa0　<|endoftext|>01²½文\u0301", max_size=60)), max_size=8))
def test_texts_give_the_tokenizers_ids(texts):
    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    held, starts = WordIds(None).code(pa.array(texts, pa.string()))
    got = [np.frombuffer(bytes(held[a:b]), "<u4").tolist() for a, b in zip(starts, starts[1:])]
    assert got == [model.encode(x or "", add_special_tokens=False).ids for x in texts]


def test_every_plain_letter_before_every_ending():
    letters = [chr(c) for c in range(0x250) if re.fullmatch(PLAIN, chr(c))]
    texts = [" ".join(c * n + end for n in (1, 2, 3) for end in ("", "a", "&&&", "'", "'s", "<|")) for c in letters]
    texts += [f"wordé{a}{b} É{a}{b}s we{b}'s" for a in string.punctuation for b in string.punctuation]
    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    held, starts = WordIds(None).code(pa.array(texts, pa.string()))
    for text, a, b in zip(texts, starts, starts[1:]):
        assert np.frombuffer(bytes(held[a:b]), "<u4").tolist() == model.encode(text, add_special_tokens=False).ids


def test_words_with_odd_endings_are_not_coded_one_by_one(monkeypatch):
    coded: list[str] = []
    one_by_one = WordIds._coded
    monkeypatch.setattr(WordIds, "_coded", lambda self, texts: coded.extend(texts) or one_by_one(self, texts))
    rnd = random.Random(9)
    text = " ".join("".join(rnd.choices("abcdefghijé", k=8)) + rnd.choice(["&&&", ",###", "%%%", ".***", "$$$"]) for _ in range(2000))
    ours = WordIds(None)
    words = ours.split(text.encode())
    ours.learn(set(words))
    assert sorted(coded) == ["$$$", "%%%", "&&&", ",###", ".***"]
    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert np.frombuffer(b"".join(ours.known[w] for w in words), "<u4").tolist() == model.encode(text, add_special_tokens=False).ids


def test_a_small_memory_forgets_and_learns_again(monkeypatch):
    from dwellspan.llm import packing

    monkeypatch.setattr(packing, "CACHE_WORDS", 5)
    model, ours = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), WordIds(None)
    for text in ("a b, c d", "b, e f g h", "a b, c, d 1 2 3 4 5 6 7"):
        words = ours.split(text.encode())
        ours.learn(set(words))
        assert np.frombuffer(b"".join(ours.known[w] for w in words), "<u4").tolist() == model.encode(text, add_special_tokens=False).ids


def test_a_small_memory_gives_all_ids_of_later_texts():
    model, ours = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), WordIds(None, 6)
    for texts in (["a b, c d", None], ["b, e f", "a g&& h"], ["a b, c d", "1 2 3 4 5 6 7"], ["", " "], ["z" * 99 + ".", "d 7 a"]):
        held, starts = ours.code(pa.array(texts, pa.string()))
        assert [np.frombuffer(bytes(held[a:b]), "<u4").tolist() for a, b in zip(starts, starts[1:])] == [model.encode(x or "", add_special_tokens=False).ids for x in texts]


def _expected(rows, capacity, end=1):
    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = []
    for doc_id, text in rows:
        ids = [*model.encode(text or "", add_special_tokens=False).ids, end]
        for n, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            out.append((doc_id, n, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return sorted(out, key=str)


def test_packing_whole_table(spark):
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choice(["the", "quick,", "brøwn", "fox.", "42"]) for _ in range(rnd.choice([0, 1, 5, 30, 300])))) for i in range(120)]
    rows += [(7, rows[7][1]), (None, None), (500, ""), (501, "word " * 3000)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, length int, sequence_id int")
    got = pack(pieces(df, capacity=64), 64).toPandas()
    assert sorted([tuple(None if v != v else int(v) for v in r) for r in got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False)], key=str) == _expected(rows, 64)
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert (g.length.cumsum() - g.length == g.offset).all() and g.length.sum() <= 64
    assert got.sequence_id.nunique() <= 1.02 * -(-got.length.sum() // 64) + 1


def test_hot_length_is_ranked_in_shards(spark, monkeypatch):
    from dwellspan.llm import packing

    monkeypatch.setattr(packing, "SHARD_PIECES", 10)
    df = spark.createDataFrame([(i, "one two") for i in range(300)], "doc_id long, text string")
    got = pack(pieces(df, capacity=16), 16).toPandas()
    assert len(got) == 300 and not got.duplicated(["sequence_id", "offset"]).any() and got.sequence_id.nunique() == 60


def test_empty(spark):
    got = pack(pieces(spark.createDataFrame([], "doc_id long, text string")))
    assert got.count() == 0 and "offset" in got.columns


@pytest.mark.parametrize("capacity", [1, 4096])
def test_extreme_capacity(spark, capacity):
    got = pack(pieces(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), capacity=capacity), capacity).toPandas()
    assert got.length.sum() == 3 and got.length.max() <= capacity


def test_op10_over_the_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = op10_best_fit_packing(spark, sf_dir).toPandas()
    assert sorted([tuple(map(int, r)) for r in got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False)], key=str) == _expected([(r.doc_id, r.text) for r in docs], CAPACITY)
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert (g.length.cumsum() - g.length == g.offset).all() and g.length.sum() <= CAPACITY
    assert got.sequence_id.nunique() == -(-got.length.sum() // CAPACITY)  # no packing has fewer


def test_very_long_words_are_not_remembered():
    model, ours = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), WordIds(None)
    rnd = random.Random(5)
    base64 = "".join(rnd.choices("ABCDEFabcdef0123456789+/", k=10**6))
    for text in (base64 + " a b", "x" * 10**6 + ", " + "y" * 100 + ".", "!" * 10_000, "y" * 100 + " a"):
        words = ours.split(text.encode())
        ours.learn(set(words))
        assert np.frombuffer(b"".join(ours.known[w] for w in words), "<u4").tolist() == model.encode(text, add_special_tokens=False).ids
    ours.learn(set())
    assert max(map(len, [*ours.known, *ours.older])) <= 64 and all(len(m) <= 64 for m in ours.marks)
