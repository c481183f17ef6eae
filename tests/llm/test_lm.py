import math
import zlib
from collections import Counter

import numpy as np
import pytest

from dwellspan.llm import lm
from dwellspan.llm.lm import held_out, op7_maxent_scores, score_texts, token_counts, train

COLUMNS = "doc_id long, text string"


def _tokens(text):
    return [w.lower() for w in (text or "").encode().split()] + [b"\n"]


def _check(rows, got):
    out = {str(i) for i, _ in rows}
    training = Counter(w for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1 for w in _tokens(t))
    n, v = sum(training.values()), len(training)
    assert len(got) == len(rows) and {str(r.doc_id) for r in got} == out
    said = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, r.held_out, round(r.base_score, 6)) for r in got)
    want = []
    for i, t in rows:
        w = _tokens(t)
        base = sum(math.log10((training[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        want.append((str(i), len(w), sum(training[x] > 0 for x in w), n, zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1, round(base, 6)))
    want.sort()
    assert [x[:5] for x in said] == [x[:5] for x in want]
    assert np.allclose([x[5] for x in said], [x[5] for x in want], atol=2e-6)


def _run(spark, df):
    docs = df.select("doc_id", "text", held_out(df.doc_id).alias("held_out"))
    counts = token_counts(docs.filter("not held_out"))
    return score_texts(docs, train(docs.filter("not held_out"), counts), counts)


def test_whole_table_and_held_out_texts(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = op7_maxent_scores(spark, sf_dir).collect()
    _check(rows, got)
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)  # contexts help on unseen texts


@pytest.mark.parametrize("known", [3, 2**18])
def test_edges(spark, monkeypatch, known):
    monkeypatch.setattr(lm, "KNOWN_WORDS", known)
    monkeypatch.setattr(lm, "FLUSH_TOKENS", 50)
    rows = [(i, " ".join(f"w{k % (i + 2)}" for k in range(i))) for i in range(40)] + [(50, None), (51, ""), (None, "W1 w2"), (3, "w0 w1 w2"), (52, "a\x1cb É " * 3), (53, "w1 " * 20_000)]
    df = spark.createDataFrame([(*r, 0.5) for r in rows], COLUMNS + ", score double").repartition(3)
    got = _run(spark, df).collect()
    _check(rows, got)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_empty_tables(spark):
    assert _run(spark, spark.createDataFrame([], COLUMNS)).count() == 0
    only_held = [i for i in range(30) if zlib.crc32(str(i).encode()) % 5 == 1]
    got = _run(spark, spark.createDataFrame([(i, "a b") for i in only_held], COLUMNS)).collect()
    assert len(got) == len(only_held) and all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in got)


@pytest.mark.parametrize("known", [10, 2**18])
def test_probabilities_of_all_tokens_add_up(spark, monkeypatch, known):
    monkeypatch.setattr(lm, "KNOWN_WORDS", known)
    monkeypatch.setattr(lm, "BUCKET_TOKENS", 4)
    words = [f"w{i}" for i in range(50)]
    rows = [(i, " ".join(words[(i * 7 + k * k) % 50] for k in range(30))) for i in range(60)]
    docs = spark.createDataFrame(rows, COLUMNS)
    counts = token_counts(docs)
    model = train(docs, counts)
    assert np.abs(model.weights).max() > 0.1
    exact = {r.token: r.c for r in counts.collect()}
    _, sizes = lm._digests([b"w1 w2"])

    def probability(digest):  # of a token after w1
        before = lm._digests([b"w1"])[0][:1]
        log, known = model.score(np.array([before[0], digest, 0], np.uint64), sizes)
        assert known[1] in (-1, exact.get(int(np.uint64(digest).astype(np.int64)), 0))
        return 10 ** log[1] * (1 if known[1] >= 0 else exact.get(int(np.uint64(digest).astype(np.int64)), 0) + 0.5)

    total = sum(probability(np.int64(t).astype(np.uint64)) for t in exact)
    buckets = len(model.bucket_logs)
    unseen = {}
    for i in range(10_000):  # one unseen token of each bucket
        d = lm._digests([f"unseen{i}".encode()])[0][0]
        unseen.setdefault(int(d) % buckets, d)
    assert len(unseen) == buckets and (buckets > 1) == (known == 10)
    assert abs(total + sum(probability(d) for d in unseen.values()) - 1) < 1e-5


def test_model_does_not_depend_on_partitions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    counts = lm.written(token_counts(docs), "counts")
    one, many = (train(docs.repartition(n), counts).weights for n in (1, 40))
    assert np.abs(one).max() > 0.5 and np.abs(one - many).max() < 0.02


def test_class_tree_has_least_depth():
    rng = np.random.default_rng(0)
    for n in (1, 2, 15, 16, 17, 300):
        w = rng.integers(1, 1000, n).astype(float)
        ptr, classes, members, bias = lm.class_tree(w)
        depth = np.diff(ptr)
        assert (depth >= 1).all() and (n > 16 or (depth == 1).all())
        logs = np.array([bias[classes[a:b], members[a:b]].sum() for a, b in zip(ptr, ptr[1:], strict=False)])
        assert np.allclose(np.exp(logs), w / w.sum(), rtol=1e-4)  # steps multiply to the leaf's share
        heavy = np.argsort(-w)
        assert (np.diff(depth[heavy]) >= 0).all() or n <= 16  # rarer leaves lie no higher


def test_size_grows_with_the_corpus(spark):
    def size(n):
        docs = spark.createDataFrame([(i, " ".join(f"t{i * 40 + k}" for k in range(40))) for i in range(n)], COLUMNS)
        model = lm.untrained(token_counts(docs))
        return len(model.weights), len(model.ptr)

    (rows_small, leaves_small), (rows_large, leaves_large) = size(20), size(2000)
    assert rows_large > rows_small and leaves_large > 50 * leaves_small


def test_words_are_digested_in_bulk(monkeypatch):
    """No call a word but for those of more than 16 bytes; equal tokens, and only those, have equal digests."""
    import xxhash

    called, real = [], xxhash.xxh3_64_intdigest
    monkeypatch.setattr(xxhash, "xxh3_64_intdigest", lambda b: called.append(bytes(b)) or real(b))
    rng = np.random.default_rng(0)
    texts = [None, b"", b" \t\n\r\x0b\x0c ", b"a", b" a b\xc3\x89\x1c\x85 ", b"x" * 7 + b" " + b"x" * 8 + b" " + b"X" * 16, b"a\0 \0a a\0\0 \0 \0\0"]
    texts += [bytes(rng.choice(np.frombuffer(b"abcABC\0\xff \n\t\x0c", np.uint8), n)) for n in rng.integers(0, 200, 300)]
    texts += [b"q" * n + b"r" for n in range(30)] + [b"r" + b"q" * n for n in range(30)]
    digests, sizes = lm._digests(texts)
    words = [w for t in texts for w in (t or b"").lower().split() + [b"\n"]]
    assert sizes.tolist() == [len((t or b"").split()) + 1 for t in texts] and len(digests) == len(words)
    by_word = dict(zip(words, digests.tolist(), strict=True))
    assert [by_word[w] for w in words] == digests.tolist() and len(set(by_word.values())) == len(by_word)
    assert sorted(called) == sorted([w for w in words if len(w) > 16] + [b"\n"])


def test_gradients_are_sums_over_events_in_double_precision():
    words = [f"w{i % 7}" for i in range(5000)] + ["w1"] * 3000  # several batches, rows that many events share
    texts = [" ".join(words).encode(), b"w2 w3", None]
    digests, sizes = lm._digests(texts)
    tokens, c = np.unique(digests, return_counts=True)
    model = lm.Model.of(lm.Model(tokens, c, np.zeros((2, 1)), len(digests), len(tokens)).__dict__)
    model.weights[:] = np.random.default_rng(0).normal(size=model.weights.shape)
    assert model.weights.ctypes.data % 128 == 0
    sums, seen = lm.in_lines(model.weights.shape, "f8"), np.zeros(len(model.weights))
    model.gradient(digests, sizes, sums, seen)
    _, taken, classes, rows = model.events(model.look_up(digests)[0], model.contexts(digests, sizes))
    _, exp, total = model.odds(classes, rows)
    parts = exp / total[:, None]
    parts[np.arange(len(taken)), taken] -= 1
    want, n = np.zeros(sums.shape), np.zeros(len(seen))
    for row in rows:
        np.add.at(want, row, parts.astype(float))
        np.add.at(n, row, 1)
    assert n.max() > 2000 and np.array_equal(seen, n) and np.allclose(sums, want, rtol=1e-9, atol=1e-9)
