import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from dwellspan.llm.bpe import Merges, TrieIds, decode, decoder, encode, op11_bpe_trie

OWN, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = "aBzÉßİıǅΣσ'sré .,!? \t\n\x0b\x1c\xa0　<|>endoftext01²½文́aaeeoo..!!==--"


@pytest.fixture(scope="module")
def models():
    return {None: (Tokenizer.from_file(OWN), TrieIds()), BYTES: (Tokenizer.from_file(BYTES), TrieIds(BYTES))}


def _ids(held, starts):
    return [np.frombuffer(bytes(held[a:b]), "<u4").tolist() for a, b in zip(starts, starts[1:])]


@pytest.mark.parametrize("path", [None, BYTES])
@settings(deadline=None, max_examples=150)
@given(texts=st.lists(st.one_of(st.none(), st.text(alphabet=ODD, max_size=60), st.text(max_size=30)), max_size=8))
def test_texts_give_the_tokenizers_ids_and_texts(models, path, texts):
    library, ours = models[path]
    expected = [library.encode(x or "", add_special_tokens=False).ids for x in texts]
    held, starts = ours.code(pa.array(texts, pa.string()))
    assert _ids(held, starts) == expected
    coded = pa.array([bytes(held[a:b]) for a, b in zip(starts, starts[1:])], pa.binary())
    assert decoder(path)(coded).to_pylist() == [library.decode(x, skip_special_tokens=False) for x in expected]


@pytest.mark.parametrize("text", ["<|endoftext|>a<|startoftext|> <|ENDOFTEXT|>", "a" * 5000, "ab" * 3000, "." * 4000, "-=" * 500, "x" * 10**5 + " " + "é" * 10**4, "9" * 5000, "\x00\x1f a\x7fb"])
def test_long_runs_and_special_tokens(models, text):
    for library, ours in models.values():
        held, starts = ours.code(pa.array([text]))
        assert _ids(held, starts) == [library.encode(text, add_special_tokens=False).ids]


def test_every_token_of_the_vocabulary_as_a_word(models):
    library, ours = models[None]
    texts = [t.removesuffix("</w>") for t in library.get_vocab() if t.isascii()]
    held, starts = ours.code(pa.array(texts))
    assert _ids(held, starts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def _merged(word, rank):
    """Plain BPE: merge the leftmost of the pairs of least rank until none is left."""
    while True:
        found = min(((rank[p], k) for k, p in enumerate(zip(word, word[1:])) if p in rank), default=None)
        if not found:
            return word
        k = found[1]
        word = [*word[:k], word[k] + word[k + 1], *word[k + 2 :]]


@settings(deadline=None, max_examples=300)
@given(st.data())
def test_small_vocabularies_against_plain_merging(data):
    """Merges are learned in order from a random corpus, so ties and runs of one letter are frequent."""
    corpus = data.draw(st.lists(st.text(alphabet="ab", min_size=1, max_size=12), min_size=1, max_size=6))
    suffix = data.draw(st.sampled_from(["", "</w>"]))

    def symbols(w):
        return [*w[:-1], w[-1] + suffix]

    words, merges = [symbols(w) for w in corpus], {}
    for _ in range(data.draw(st.integers(0, 8))):
        pairs = [p for w in words for p in zip(w, w[1:])]
        made = [a + b for a, b in merges]
        pairs = [p for p in pairs if p[0] + p[1] not in made]
        if not pairs:
            break
        merges[max(sorted(set(pairs)), key=pairs.count)] = len(merges)
        words = [_merged(symbols(w), merges) for w in corpus]
    vocab = {t: i for i, t in enumerate(dict.fromkeys(["a", "b", "a" + suffix, "b" + suffix, *(a + b for a, b in merges)]))}
    ours = Merges({"type": "BPE", "vocab": vocab, "merges": [list(m) for m in merges], "end_of_word_suffix": suffix or None})
    tested = data.draw(st.lists(st.text(alphabet="ab", min_size=1, max_size=14), max_size=10)) + corpus
    got = ours.encode(set(tested))
    assert got == {w: [vocab[t] for t in _merged(symbols(w), merges)] for w in tested}


def test_merges_out_of_order_are_refused():
    with pytest.raises(ValueError, match="order"):
        Merges({"type": "BPE", "vocab": {"a": 0, "b": 1, "ab": 2, "aba": 3}, "merges": [["ab", "a"], ["a", "b"]]})
    with pytest.raises(ValueError, match="plain BPE"):
        Merges({"type": "WordPiece", "vocab": {}, "merges": []})


def test_shared_prefixes_are_coded_once(monkeypatch):
    ours, seen = TrieIds().merges_of, []
    state = Merges._state
    monkeypatch.setattr(Merges, "_state", lambda self, word, at, last, end: seen.append(word[:at] + end) or state(self, word, at, last, end))
    rnd = random.Random(4)
    stems = ["".join(rnd.choices("abcdefgh", k=6)) for _ in range(40)]
    words = {s + "".join(rnd.choices("xyz", k=rnd.randint(0, 3))) for s in stems for _ in range(20)}
    ours.encode(words)
    nodes = {w[:k] for w in words for k in range(1, len(w))}
    assert sorted(seen) == sorted([*nodes, *(w + "\n" for w in words)])  # each prefix once, each word's end once
    assert len(seen) < sum(map(len, words)) / 2


def test_a_small_memory_gives_the_same_ids(models):
    library, ours = models[None][0], TrieIds(None, 5)
    for texts in (["a b, c d", None], ["b, e f", "a g&& h"], ["a b, c d", "1 2 3 4 5 6 7"], ["", " "], ["z" * 99 + ".", "d 7 a"]):
        held, starts = ours.code(pa.array(texts, pa.string()))
        assert _ids(held, starts) == [library.encode(x or "", add_special_tokens=False).ids for x in texts]
        assert len(ours.known) + len(ours.older) <= 10 and all(len(w) <= 64 for w in ours.known)


def test_frames_with_nulls_repeats_and_other_columns(spark):
    rows = [(1, "One two", b"x", "y"), (1, "One two", b"x", "y"), (None, "three", b"", ""), (4, None, None, None), (5, "", b"", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids binary, tokens string")
    got = decode(encode(docs)).toPandas()
    assert list(got.columns) == ["doc_id", "ids", "text"] and len(got) == 5
    library = Tokenizer.from_file(OWN)
    expected = sorted((library.encode(t or "", add_special_tokens=False).ids for _, t, *_ in rows), key=str)
    assert sorted((np.frombuffer(i, "<u4").tolist() for i in got.ids), key=str) == expected
    assert sorted(got.text) == sorted(library.decode(i, skip_special_tokens=False) for i in expected)
    assert decode(encode(docs.limit(0))).count() == 0
    assert decode(docs.select("doc_id", "ids").where("ids is null")).first().text == ""


def test_op11_over_the_whole_table(spark, sf_dir):
    library = Tokenizer.from_file(OWN)
    expected = []
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        digests = [hashlib.sha256(x).hexdigest() for x in (np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False).encode())]
        expected.append((r.doc_id, len(ids), *digests))
    got = op11_bpe_trie(spark, sf_dir)
    assert got.dtypes == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected)
