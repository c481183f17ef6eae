import random
from difflib import SequenceMatcher

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dwellspan.operators import resolve
from dwellspan.operators.alike import Held, Index, alike, closest, similarity

TIGHT, LOOSE = Held(0.86, 6, 0.6), Held(0.88)


def _plain(a, b, held):
    fit = SequenceMatcher(None, a, b).ratio() if a or b else 1.0
    if held and a and (a in b or b in a) and len(a) >= held.chars and len(a) >= held.share * len(b):
        fit = max(fit, held.fit)
    return fit


@settings(deadline=None, max_examples=150)
@given(st.data())
def test_no_pair_is_lost(data):
    letters = data.draw(st.sampled_from(["AB", "ABCDE", "ÄÖЖA1 "]))
    texts = st.text(alphabet=letters, max_size=data.draw(st.sampled_from([4, 12, 90])))
    left, right = data.draw(st.lists(texts, max_size=12)), data.draw(st.lists(texts, min_size=1, max_size=30))
    held, least = data.draw(st.sampled_from([None, TIGHT, LOOSE])), data.draw(st.sampled_from([0.0, 0.4, 0.75, 1.0]))
    index = Index(right)
    every = {(i, j): _plain(a, b, held) for i, a in enumerate(left) for j, b in enumerate(right)}
    assert {(i, j): f for i, j, f in index.alike(left, least, None, held)} == {p: f for p, f in every.items() if f >= least}
    margin = data.draw(st.sampled_from([0.0, 0.03]))
    near = {(i, j): f for i, j, f in index.alike(left, 0.0, margin, held)}
    for i in range(len(left)):
        best = max(every[i, j] for j in range(len(right)))
        assert {(i, j) for j in range(len(right)) if best - every[i, j] <= margin} <= {p for p in near if p[0] == i}
    assert all(every[p] == f for p, f in near.items())


def _words(n, seed, spoilt=0.0):
    rnd = random.Random(seed)
    parts = ["ba", "ri", "to", "ne", "ka", "so", "lux", "mer", "an", "de", "or", "pi", "ty", "gra", "ven", "co", "st", "el", "um", "qi"]
    out = set()
    while len(out) < n:
        word = list("".join(rnd.choices(parts, k=rnd.randint(2, 5))).upper())
        if rnd.random() < spoilt:
            word[rnd.randrange(len(word))] = rnd.choice("0123456789QWXZ")
        out.add("".join(word))
    return sorted(out)


def test_under_a_hundredth_of_pairs_is_compared(spark):
    tokens, names = _words(3000, 1, 0.7), _words(20_000, 2)
    left, right = spark.createDataFrame([(t,) for t in tokens], "a string"), spark.createDataFrame([(n,) for n in names], "b string")
    rows = alike(left, right, margin=0.03, held=TIGHT, counts=True, block=8192).collect()
    pairs, compared = sum(r.fit for r in rows if r.a is None), sum(int(r.b) for r in rows if r.a is None)
    assert pairs == len(tokens) * len(names) and compared < 0.01 * pairs
    found = {}
    for r in rows:
        if r.a is not None:
            found.setdefault(r.a, {})[r.b] = r.fit
    for token in random.Random(3).sample(tokens, 12):
        every = {n: similarity(token, n, TIGHT) for n in names}
        best = max(every.values())
        assert {n for n, f in every.items() if best - f < 0.03} <= found[token].keys()


def test_keys_chunks_and_blocks(spark):
    words = _words(300, 5, 0.5)
    rows = spark.createDataFrame([(i % 3, w) for i, w in enumerate(words)] + [(0, words[0])] * 50 + [(1, None), (7, "ALONE")], "k int, a string")
    got = alike(rows, rows.withColumnRenamed("a", "b"), ["k"], 0.75, held=LOOSE, chunk=16, block=32)
    expected = {(k, a, b) for k in range(3) for a in words[k::3] for b in words[k::3] if _plain(a, b, LOOSE) >= 0.75} | {(7, "ALONE", "ALONE")}
    assert sorted((r.k, r.a, r.b) for r in got.collect()) == sorted(expected)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert alike(rows.limit(0), rows.withColumnRenamed("a", "b"), ["k"]).count() == 0
    assert closest(rows.select("a"), rows.select(F.col("a").alias("b")).limit(0)).agg(F.max("fit")).first()[0] == 0


def _match(token, names, min_match=0.62):
    scores = {}
    for norm, name in names:
        scores[name] = max(scores.get(name, 0.0), _plain(token, norm, TIGHT))
    order = sorted(scores.items(), key=lambda x: -x[1])
    if len(token) < 3:
        return None, 0.0
    sure = order[0][1] >= min_match and (len(order) == 1 or order[0][1] - order[1][1] >= 0.03)
    return (order[0][0] if sure else None), order[0][1]


def test_resolve_against_every_name(spark):
    rnd = random.Random(4)
    names = sorted({"".join(rnd.choice("ABCDE") for _ in range(rnd.randint(2, 12))) for _ in range(40)})
    listed = [(n, f"n{i // 2}") for i, n in enumerate(names)]
    tokens = sorted({"".join(rnd.choice("ABCDE") for _ in range(rnd.randint(1, 12))) for _ in range(400)} - set(names))
    got = resolve.resolve(spark.createDataFrame([(t, t) for t in tokens], "token string, name_ string"), spark.createDataFrame(listed, "norm string, name string")).collect()
    assert len(got) == len(tokens)
    for r in got:
        assert (r.name, r.match) == _match(r.token, listed), r


def _led(strings, merge=0.75):
    """One string after the other."""
    out, heads = {}, []
    for norm, _ in sorted(strings, key=lambda s: (-s[1], s[0])):
        fits = [(_plain(norm, h, LOOSE), -k) for k, h in enumerate(heads)]
        if fits and max(fits)[0] >= merge:
            out[norm] = heads[-max(fits)[1]]
        else:
            heads.append(norm)
            out[norm] = norm
    return out


@pytest.mark.parametrize("first", [8, 4096])
def test_leaders_in_rounds_equal_one_by_one(spark, monkeypatch, first):
    monkeypatch.setattr(resolve, "FIRST_TURN", first)
    rnd = random.Random(6)
    rows = {(k, "".join(rnd.choice("ABC") for _ in range(rnd.randint(3, 7)))): rnd.choice([0.5, 0.6, 0.9]) for k in (1, 2) for _ in range(60 + 60 * (k == 1))}
    got = resolve.leaders(spark.createDataFrame([(k, n, c) for (k, n), c in rows.items()], "k int, norm string, conf double"), ["k"]).collect()
    assert len(got) == len(rows)
    for k in (1, 2):
        assert {r.norm: r.lead for r in got if r.k == k} == _led([(n, c) for (g, n), c in rows.items() if g == k])


def test_a_hot_key_of_like_strings_spreads_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(resolve, "FIRST_TURN", 64)
    rnd = random.Random(8)
    base = "HEINEKENBEER"
    strings = {base: 1.0}
    while len(strings) < 1500:  # one family: each differs from the leader in two letters
        s = list(base)
        for _ in range(2):
            s[rnd.randrange(len(s))] = rnd.choice("0123456789XYZQW")
        strings.setdefault("".join(s), rnd.random() * 0.9)
    got = resolve.leaders(spark.createDataFrame([(1, n, c) for n, c in strings.items()], "k int, norm string, conf double"), ["k"])
    assert {r.norm: r.lead for r in got.collect()} == _led(list(strings.items()))
