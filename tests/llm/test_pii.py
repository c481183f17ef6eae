import hashlib
import random
import re

from dwellspan.llm.pii import op4_pii_contexts, personal_data


def _luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _digits(m):
    return re.sub("[^0-9]", "", m)


BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(_digits(m)) <= 19 and _luhn(_digits(m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(_digits(m)) <= 15),
}


def _base(text):
    return {k: [(m.start(), m.end()) for m in re.finditer(p, text or "") if ok(m[0])] for k, (p, ok) in BASE.items()}


def _check(rows, got):
    assert len(got) == len(rows)
    for text, r in zip([t for _, t in sorted(rows, key=str)], sorted(got, key=lambda r: str((r.doc_id,))), strict=True):
        want = _base(text)
        said = ",".join(f"{k}:{a}:{b}" for k in BASE for a, b in want[k])
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest(), (text, said, r.spans)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(len(want[k]) for k in BASE)
        assert set(filter(None, said.split(","))) <= set(r.spans.split(","))


def test_base_spans_against_brute_force(spark):
    rnd = random.Random(5)
    texts = [None, "", "a@b.c@d.e", "x a@b.c.x@d.com a@b.c_d@e.f", "..1.2.3.4.5.6.7.8", "1.2.3.4 256.1.1.1 0255.1.1.1 999999999999999999999.1.1.1", "4387513035237269", "4387 5130 3523 7269 1", "+1 (456) 555-2186 45", "ñ é ü+49 123-456 78x",
             "4417-1234 5678-9113", "\U0001f600 q@w.er \U0001f600 1.1.1.1", "a@b-.-c", "1 " * 30_000, "9" * 60_000, "a" * 60_000, "a@" * 20_000, "1." * 30_000, "x@y.zz " * 3000]
    texts += ["".join(rnd.choice("ab1@.+- (9%_5.4é\n") for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "q@w.er"), (0, None)]
    rows = [(i, t) for i, t in rows if (i, t) != (0, None)] + [(0, None)]
    got = personal_data(spark.createDataFrame([(*r, "z", 1) for r in rows], "doc_id long, text string, spans string, n_email int")).collect()
    _check(rows, got)


def test_whole_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    _check(rows, op4_pii_contexts(spark, sf_dir).collect())


def test_contexts_find_identifiers_that_no_base_pattern_fits(spark):
    rows = [(i, f"we can reach them now, write to user{i}@mail{i}.example.com and wait for word {i}") for i in range(40)]
    rows += [(100 + i, f"some words first, write to person{i}(at)host{i} and more words") for i in range(5)]
    rows += [(200 + i, f"the lot number ab{i}cd{i}99 was sold") for i in range(60)]
    got = {r.doc_id: r for r in personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i in range(5):
        text = rows[40 + i][1]
        at = text.index("person")
        assert got[100 + i].spans == f"email:{at}:{text.index(' and more')}" and got[100 + i].n_email == 0
    assert all(got[200 + i].spans == "" for i in range(60))


def test_contexts_find_grouped_numbers_and_spelt_addresses(spark):
    rnd = random.Random(3)
    rows = [(i, f"today you may call me at +1 (456) 555-21{i:02} or later") for i in range(40)]
    for i in range(40):
        d = "".join(rnd.choice("0123456789") for _ in range(15))
        d = next(d + c for c in "0123456789" if _luhn(d + c))
        rows.append((100 + i, f"then we pay with card {d[:4]} {d[4:8]} {d[8:12]} {d[12:]} or later"))
    rows += [(200 + i, f"now write to user{i}@mail{i}.example.com or later") for i in range(40)]
    planted = {
        300: ("phone", "today you may call me at ", "(456) 555-2186", " or later"),
        301: ("phone", "today you may call me at ", "456 555 2186", ", or later"),
        302: ("phone", "today you may call me at ", "[456] 555 - 2186", ". Later"),
        303: ("card", "then we pay with card ", "4387 5130 3523 7260", " or later"),
        304: ("email", "now write to ", "john(at)host.com", ", or later"),
        305: ("email", "now write to ", "john at host dot com", " or later"),
        306: ("email", "now write to ", "john [at] host [dot] com", " or later"),
        308: ("phone", "today you may call me at ", "456 555-2186", ". 20 came later"),
        307: ("phone", "today you may call me at ", "456 555 2186", " 7th or later"),
    }
    rows += [(k, "".join(p[1:])) for k, p in planted.items()] + [(400 + i, f"the lot 12 {i} 77 {i} was sold") for i in range(20)]
    got = {r.doc_id: r.spans for r in personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k: got[k] for k in planted} == {k: f"{kind}:{len(before)}:{len(before) + len(m)}" for k, (kind, before, m, _) in planted.items()}
    assert all(got[400 + i] == "" for i in range(20))


def test_texts_of_very_many_matches(spark):
    import time

    rnd = random.Random(7)
    numeric = " ".join(str(rnd.randint(10**6, 10**8)) + rnd.choice([",", "x", ";"]) for _ in range(200_000))  # 2 MB
    mixed = " ".join(rnd.choice(["a@b.cd", "1.2.3.4", "+1 234 567 890", "w", "n0t3d"]) for _ in range(60_000))
    rows = [(1, numeric), (2, mixed), (3, "x"), (4, " ".join(f"q{k}z" for k in range(50_000)))]
    start = time.perf_counter()
    got = personal_data(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    taken = time.perf_counter() - start
    _check(rows, got)
    assert taken < 90


def test_long_context_words_stay_apart(spark):
    one, two = "k" * 100, "j" * 30 + "k" * 100
    rows = [(i, f"first {one} user{i}@mail{i}.example.com said word{i % 3}") for i in range(30)] + [(100 + i, f"first {two} john{i}(at)host") for i in range(5)] + [(200 + i, f"first {one} john{i}(at)host") for i in range(5)]
    got = {r.doc_id: r.spans for r in personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[100 + i] == "" for i in range(5))
    assert all(got[200 + i] == f"email:{107}:{107 + len(f'john{i}(at)host')}" for i in range(5))


def test_empty_and_native(spark, sf_dir):
    assert personal_data(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert not re.search("Python|Arrow|Pandas", op4_pii_contexts(spark, sf_dir)._jdf.queryExecution().executedPlan().toString())
