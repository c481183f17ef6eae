import re

from dwellspan.llm.quality import OP2_SQL, Rule, judge, op2_quality_rules, verdict

WS = r"[\x20\x09-\x0D]"


def test_op2_equals_sql(same):
    same(op2_quality_rules, OP2_SQL)


def _brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen: dict[tuple, list] = {}
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_measures_against_brute_force(spark):
    chunk = "a b c d e f g h i "
    texts = [None, "", " \t\n\x0b\x0c\r", "a", chunk * 2, chunk * 3 + "x " + chunk, "é ü\x1c\xa0 \U0001f600 x", "line\nline\n \n line\nline", "#*$ %&|<> " * 4, "w " * 30_000, "x" * 100_000, ("u v w x y z 1 2 " * 3 + "\n") * 5,
             " ".join(f"w{i % 11}" for i in range(100)), " ".join(f"w{i}" for i in range(3000)) + " w5 w6 w7 w8 w9 w10 w11 w12 w13"]
    df = spark.createDataFrame([(i, t, 1, "z") for i, t in enumerate(texts)], "doc_id long, text string, n_words int, kept string")
    for r in judge(df).collect():
        want = _brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, texts[r.doc_id][:60]
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept)


def test_good_prose_stays_and_junk_goes(spark):
    prose = "The quick brown fox jumps over the lazy dog, and the hunter was not at home for it. This is what we know of the story, as it was told by those who were there."
    junk = ["%%% *** ### &&& <<< >>> " * 10, "Qzx wvk plm trs bnd grk fld mnt vst zzt " * 3 + "lkj hgf dsa poi uyt rew", "1234 5678 9012 3456 7890 1111 2222 3333 4444 5555 6666 7777 8888 9999 0000 1212 3434 5656 7878 9090 2323 the of"]
    df = spark.createDataFrame([(0, prose), *((i + 1, t) for i, t in enumerate(junk))], "doc_id long, text string")
    assert {r.doc_id for r in judge(df).filter("kept").collect()} == {0}


def test_filters_on_verdicts_stay_above_the_measures(spark):
    df = spark.createDataFrame([(i, "the of and " * 40) for i in range(20)], "doc_id long, text string")
    assert judge(df).filter("kept").count() == 0  # a repeated window fails; the point is that it ends
    assert judge(df).filter("base_failed").count() == 20


def test_empty_and_own_rules(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert judge(empty).count() == 0
    df = spark.createDataFrame([(1, " ".join(f"word{i}" for i in range(30)))], "doc_id long, text string")
    assert judge(df, (Rule("long", "n_words", high=10),)).first().kept is False
    assert judge(df, ()).first().kept is True
    assert "and" in str(verdict((Rule("a", "x", 1, 2),)))


def test_no_python_in_the_plan(spark, sf_dir):
    plan = op2_quality_rules(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


def test_columns_with_the_names_of_the_steps_stay(spark):
    df = spark.createDataFrame([(1, "a b " * 30, 5, "m", None, 3), (2, None, 6, "n", "x", 4)], "doc_id long, text string, qr_words int, QR_M string, kept string, n_words int")
    got = judge(df)
    assert {"qr_words", "QR_M"} <= set(got.columns)
    plain = judge(df.select("doc_id", "text")).orderBy("doc_id").collect()
    for a, b in zip(got.orderBy("doc_id").collect(), plain, strict=True):
        assert all(a[c] == b[c] for c in plain[0].asDict())
    assert [(r.qr_words, r.QR_M) for r in got.orderBy("doc_id").collect()] == [(5, "m"), (6, "n")]
