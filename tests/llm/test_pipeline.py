import pytest

import corpus_pipeline as cp
from dwellspan.llm.common import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """What goes in and comes out of each stage over the whole table."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in cp.STAGES:
        after = written(stage(spark, docs, sf_dir), "t")
        out.append((name, docs, after))
        docs = after
    return out


def test_names_and_columns(stages):
    assert [n for n, _, _ in stages] == [n for n, _ in cp.STAGES] and len(cp.STAGES) == 5
    assert all(after.columns == COLUMNS for _, _, after in stages[:-1])


def test_quality_keeps_good_and_drops_bad(stages, spark, sf_dir):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    _, before, after = stages[0]
    kept = {r.doc_id for r in after.select("doc_id").collect()}
    rows = [(r.doc_id, len(r.text.split())) for r in before.collect()]
    good = [i for i, n in rows if labels.get(i) == 1 and n >= 20]
    bad = [i for i, n in rows if labels.get(i) == 0]
    assert sum(i in kept for i in good) == len(good)
    assert sum(i in kept for i in bad) <= 0.5 * len(bad)


def test_lines_lose_repeats_but_for_the_first(stages):
    from collections import defaultdict

    _, before, after = stages[1]
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").lower()
    had, has = defaultdict(set), defaultdict(set)
    for df, held in ((before, had), (after, has)):
        for r in df.collect():
            for line in r.text.split("\n"):
                held[key(line)].add(r.doc_id)
    for k, docs in had.items():
        if k and len(docs) >= 10:
            assert len(has[k]) == 1
    assert {r.doc_id: r.n_chars for r in after.collect()} == {r.doc_id: len(r.text) for r in after.collect()}


def test_near_duplicates_leave_one_of_a_group(stages):
    from .test_minhash import _brute

    _, before, after = stages[2]
    want = {i for i, (_, c) in _brute([(r.doc_id, r.text) for r in before.collect()], cp.PERCENT).items() if i == c}
    assert cp.PERCENT == 80
    assert {r.doc_id for r in after.collect()} == want


def test_mixture_takes_whole_documents(stages):
    _, before, after = stages[3]
    texts = {r.doc_id: r.text for r in before.collect()}
    times: dict[int, int] = {}
    for r in after.collect():
        assert texts[r.doc_id] == r.text
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert max(times.values()) <= 3


def test_packed_rows(stages):
    _, before, after = stages[4]
    rows = after.toPandas()
    assert (rows.piece == 0).sum() == before.count()
    for _, g in rows.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert (g.length.cumsum() - g.length == g.offset).all() and g.length.sum() <= 4096


def test_run_and_empty(spark, sf_dir, stages, tmp_path):
    assert cp.run(spark, sf_dir).count() == stages[-1][2].count()
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_rows_of_nulls_pass(spark, tmp_path):
    rows = [(None, None, None, None, None), (1, None, None, None, None), (2, "", "en", "a", 0), (3, "the of and to in is that " + " ".join(f"word{i}" for i in range(40)), None, None, None)] * 2
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id for r in cp.run(spark, str(tmp_path)).collect()} == {3}


def test_near_duplicates_link_from_80_percent(spark):
    words = [f"w{i}" for i in range(50)]
    once = [*words[:25], "other", *words[26:]]  # 41 of 51 shingles
    more = [f"v{i}" for i in range(50)]
    far = [*more[:20], "other", *more[21:27], "another", *more[28:]]  # 34 of 58
    rows = [(i, " ".join(w), "en", "a", 0) for i, w in enumerate((words, once, more, far))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id for r in cp.near_duplicate_groups(spark, docs, "").collect()} == {0, 2, 3}


def test_near_duplicates_are_judged_by_row(spark):
    words = {c: " ".join(f"{c}{i}" for i in range(30)) for c in "abcd"}
    rows = [(None, words["a"]), (None, words["a"]), (1, words["b"]), (2, words["b"]), (2, words["c"]), (3, words["d"]), (3, words["d"]), (4, " "), (4, " "), (5, " "), (None, None), (None, None)]
    docs = spark.createDataFrame([(*r, "en", "a", 0) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = cp.near_duplicate_groups(spark, docs, "").collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted({*rows} - {(2, words["b"])}, key=str)


CLASHES = ("kept", "n_words", "row", "key", "digest", "group", "mix_key", "mix_copies", "n_lines", "n_dropped", "component_id", "hub", "x")


def test_stages_keep_columns_of_any_name(spark):
    texts = ["the of and to in is that " + " ".join(f"word{i}x{k}" for k in range(40)) for i in range(12)]
    rows = [(i // 2, t, "en", "ab"[i % 2], len(t), *(f"{c}{i}" for c in CLASHES)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES))
    for _, stage in cp.STAGES[:-1]:
        after = written(stage(spark, docs, ""), "t")
        assert after.columns == docs.columns
        assert all(r[c] == f"{c}{texts.index(r.text)}" for r in after.collect() for c in CLASHES)
        docs = after
    assert docs.count() >= 10
    packed = cp.STAGES[-1][1](spark, docs, "")
    assert packed.count() == docs.count()


def test_repeated_rows_and_long_texts(spark):
    long = " ".join(f"the word{i} of and" for i in range(20_000))
    plain = "the of and to in is that " + " ".join(f"v{i}" for i in range(40))
    rows = [(1, plain)] * 3 + [(2, plain), (3, long), (3, plain + " the end"), (4, long)]
    docs = spark.createDataFrame([(*r, "en", "a", 0) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = written(cp.quality(spark, docs, ""), "q")
    assert kept.count() == len(rows)
    one = written(cp.near_duplicate_groups(spark, kept, ""), "n")
    assert sorted((r.doc_id, len(r.text)) for r in one.collect()) == [(1, len(plain)), (3, len(long))]
    mixed = written(cp.mixture(spark, kept, ""), "m")
    assert mixed.count() == len(rows)  # one source: each row once
    packed = cp.packed(spark, mixed, "").toPandas()
    assert (packed.piece == 0).sum() == len(rows) and not packed.duplicated(["sequence_id", "offset"]).any() and packed.length.max() == 4096
