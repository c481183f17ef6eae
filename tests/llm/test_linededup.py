import hashlib
from collections import defaultdict

import pytest

from dwellspan.llm import linededup
from dwellspan.llm.linededup import OP9_SQL, drop_frequent_lines, op9_line_dedup

STRIP = " \t\n\x0b\x0c\r"


def test_op9_equals_sql(same):
    same(op9_line_dedup, OP9_SQL)


def _key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(STRIP))


def _brute(rows, min_docs, keep_first):
    docs = defaultdict(set)
    for n, (_, text) in enumerate(rows):
        for line in (text or "").split("\n"):
            if _key(line):
                docs[_key(line)].add(n)
    hot = {k: min((rows[n][0] for n in v if rows[n][0] is not None), default=None) for k, v in docs.items() if len(v) >= min_docs}
    out = []
    for doc_id, text in rows:
        kept, seen = [], set()
        lines = (text or "").split("\n")
        for line in lines:
            k = _key(line)
            if k not in hot:
                kept.append(line)
            elif keep_first and hot[k] == doc_id and k not in seen:
                seen.add(k)
                kept.append(line)
        out.append((doc_id, None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


ROWS = [
    *((i, f"own {i}\n  Shared LINE\t\nÉtoile\nother {i % 3}\n\nown {i}") for i in range(15)),
    (15, None), (16, ""), (17, "\n\n"), (18, "shared line"), (18, "shared line"), (None, "SHARED LINE\nx"), (19, "étoile\n" * 2000), (20, "\x1cShared line"), (21, "long " * 20_000),
]


@pytest.mark.parametrize("joined", [False, True])
@pytest.mark.parametrize("keep_first", [False, True])
def test_against_brute_force(spark, joined, keep_first):
    df = spark.createDataFrame([(*r, 5, "s") for r in ROWS], "doc_id long, text string, n_lines int, source string")
    out = drop_frequent_lines(df, 10, 1, keep_first, max_broadcast_keys=0 if joined else 1000)
    assert set(out.columns) == {"doc_id", "text", "source", "n_lines", "n_dropped"}
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out.collect()), key=str) == _brute(ROWS, 10, keep_first)


@pytest.mark.parametrize("joined", [False, True])
def test_any_other_column_and_texts_without_an_id(spark, joined):
    rows = [(None, f"only {i}\nshared") for i in range(12)] + [(1, "shared\nx"), (1, "y\nshared")]
    df = spark.createDataFrame([(*r, "k", "d", 7, "h") for r in rows], "doc_id long, text string, frequent_keys_ string, digest string, key_doc int, held_xxxxxxxxxxxxxxxx string").withColumnRenamed("key_doc", "row")
    out = drop_frequent_lines(df, max_broadcast_keys=0 if joined else 1000)
    assert out.columns == [*df.columns, "n_lines", "n_dropped"]
    got = out.collect()
    assert sorted(r.text for r in got) == sorted([*(f"only {i}" for i in range(12)), "x", "y"])
    assert {tuple(r)[2:6] for r in got} == {("k", "d", 7, "h")} and {r.n_dropped for r in got} == {1}


def test_full_filters_only_cost_suspects(spark, monkeypatch):
    monkeypatch.setattr(linededup, "MIN_BITS", 64 * 8)
    monkeypatch.setattr(linededup, "MAX_BITS", 64 * 8)
    rows = [(i, "\n".join([f"line {i} {k}" for k in range(30)] + ["same"])) for i in range(40)]
    out = drop_frequent_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(7))
    assert {r.n_dropped for r in out.collect()} == {1}


def test_counts_meet_across_partitions(spark):
    rows = [(i, f"x{i}\nsame") for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(10)
    assert {r.n_dropped for r in drop_frequent_lines(df).collect()} == {1}
    assert {r.n_dropped for r in drop_frequent_lines(df, min_docs=11).collect()} == {0}


def test_empty(spark):
    assert drop_frequent_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_digest_of_dropped_text():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")
