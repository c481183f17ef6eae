import random
from collections import defaultdict

import numpy as np
import pytest

from dwellspan.llm import minhash
from dwellspan.llm.minhash import OP3_SQL, components, forest, near_duplicates, op3_minhash_near_dedup, shingle_set, signature


def test_op3_equals_sql(same):
    same(op3_minhash_near_dedup, OP3_SQL)


def _shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset([tuple(w)]) if 0 < len(w) < 5 else frozenset(zip(*(w[k:] for k in range(5)), strict=False))


def _brute(rows, percent=85):
    """rows of distinct ids."""
    sets = {i: _shingles(t) for i, t in rows}
    holders, parent = defaultdict(list), {i: i for i in sets}
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sets.items():
        shared = defaultdict(int)
        for x in s:
            for k in holders[x]:
                shared[k] += k < i
        for k, n in shared.items():
            if n and 100 * n >= percent * (len(s) + len(sets[k]) - n):
                a, b = find(i), find(k)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_whole_table_against_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op3_minhash_near_dedup(spark, sf_dir).collect()}
    assert got == _brute(rows)


def _family(rnd, n, words=80, edits=6):
    base = [f"w{rnd.randint(0, 9999)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rnd.randint(0, edits)):
            own[rnd.randrange(words)] = f"x{rnd.randint(0, 999999)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("block", [4, 256])
def test_families_with_members_far_from_the_hub(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK_DOCS", block)
    rnd = random.Random(11)
    texts = [t for _ in range(12) for t in _family(rnd, 14)] + _family(rnd, 10, 12, 1) + _family(rnd, 6, 7, 1)
    rnd.shuffle(texts)
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = _brute(rows)
    assert got == want
    assert len({c for _, c in want.values()}) < len(texts) - 40


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a b"), (5, "A  B"), (6, "b a"), (7, "a b c d e"), (8, "x " * 50_000), (9, "x x x x x"), (9, "x x x x x"), (None, "a b"), (10, "É b"), (11, "é b")]
    got = near_duplicates(spark.createDataFrame([(*r, 0, "q") for r in rows], "doc_id long, text string, component_id int, kept string")).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [by[i].n_shingles for i in (1, 2, 3, 4, 7, 8)] == [0, 0, 0, 1, 1, 1]
    assert [by[i].component_id for i in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11)] == [1, 2, 3, 4, 4, 6, 7, 8, 8, 10, 11]
    assert by[4].kept and not by[5].kept and by[1].kept and not by[9].kept
    assert by[None].component_id == 4 and not by[None].kept


def test_empty(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_copies_make_no_pairs(spark):
    rows = [(i, "one two three four five six seven") for i in range(500)] + [(1000 + i, f"other text number {i} of its own kind") for i in range(5)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in got if r.doc_id < 500} == {0} and sum(r.kept for r in got) == 6


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 200), (200, 100), (200, 300), (7, 7)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(2, 61)} | {200: 100, 300: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_signature_estimates_similarity():
    rnd = np.random.default_rng(0)
    for share in (0.5, 0.85):
        hits = []
        for _ in range(60):
            pool = np.unique(rnd.integers(0, 2**63, 400, np.uint64) * np.uint64(2))
            n = int(len(pool) * (1 - share) / 2)
            a, b = pool[n:], pool[: len(pool) - n]
            hits.append((signature(np.sort(a)) == signature(np.sort(b))).mean())
        assert abs(np.mean(hits) - (len(pool) - 2 * n) / len(pool)) < 0.05


def test_forest_finds_cross_links_only():
    a, b = shingle_set(b"a b c d e f g h i j k l m n o p q r s t u v w x y z"), shingle_set(b"z y x w v u t s r q")
    assert forest([1, 2, 3], [a, a, b]) == [(1, 2)]
    assert forest([1, 2, 3], [a, a, b], cross=2) == []
    assert forest([1, 2, 3], [a, b, a], cross=2) == [(1, 3)]


def _brute_rows(rows, percent=85):
    """Components of rows whose ids may repeat: rows of one id are one document."""
    sets, parent = [_shingles(t) for _, t in rows], {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, _) in enumerate(rows):
        for j, (o, _) in enumerate(rows[:k]):
            shared = len(sets[k] & sets[j])
            if shared and 100 * shared >= percent * (len(sets[k]) + len(sets[j]) - shared):
                a, b = find(i), find(o)
                parent[max(a, b)] = min(a, b)
    return sorted((i, len(s), find(i)) for (i, _), s in zip(rows, sets, strict=True))


@pytest.mark.parametrize("block", [3, 256])
def test_repeated_ids_of_other_texts(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK_DOCS", block)
    monkeypatch.setattr(minhash, "PART_DOCS", block)
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    near_b = b.replace("b39", "z")
    rows = [(5, a), (5, b), (3, b), (9, a), (9, a), (20, c), (21, near_b), (21, c), (30, "q r"), (30, a)]
    rnd = random.Random(2)
    for k in range(8):  # families whose hubs have several texts
        texts = _family(rnd, 9)
        rows += [(100 * k + 100 + n // 2, t) for n, t in enumerate(texts)] + [(100 * k + 150, texts[0]), (100 * k + 101, texts[5])]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == _brute_rows(rows)
    assert {r.component_id for r in got if r.doc_id in (3, 5, 9, 20, 21, 30)} == {3}


def test_members_that_the_hub_links_do_not_meet(spark, monkeypatch):
    met = []
    real = minhash.by_run
    monkeypatch.setattr(minhash, "by_run", lambda df, n, run: (met.append(df.count()), real(df, n, run))[1])
    base = [f"w{k}" for k in range(400)]
    rows = [(0, " ".join(base))] + [(i, " ".join(base[:i] + [f"x{i}"] + base[i + 1 :])) for i in range(1, 300)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {0} and met == [0]
