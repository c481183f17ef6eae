import numpy as np
import pytest

from dwellspan.llm.urlfilter import OP5_SQL, RULES, DigestArray, judge_urls, op5_url_filter, split_url


def test_op5_equals_sql(same):
    same(op5_url_filter, OP5_SQL)


URLS = [
    None, "", "no scheme", "http://", "http://EXAMPLE.org", "http://EXAMPLE.org/", "https://a.b.example.org/es/x?y#z", "https://example.org/en/1", "https://example.org/en/12", "https://myexample.org/es/",
    "https://x.com/fr/", "https://x.com/FR/", "https://com/de/x", "http://a.com/de/#/fr/", "http://a.com?/fr/", "http://u:p@a.org:80/", "x://b.net/://a.org/", "http://.org/", "http://" + "s." * 5000 + "org/" + "p" * 50_000, "http://" + "s." * 100_000 + "org/x", "http://malware.example.net/", "http://bücher.org/",
]


def _brute(url):
    host, path = split_url(url)
    best = None
    for verdict, h, p in RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[1])):
            best = (verdict, h + p)
    return (host, path, best[1] if best else None, best[0] if best else "block" if url == "http://malware.example.net/" else "allow")


def test_against_brute_force(spark):
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS)] + [(None, "http://a.org/", "h"), (0, None, "h")], "page_id long, url string, host string")
    got = judge_urls(df).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        url = "http://a.org/" if r.page_id is None else URLS[r.page_id]
        assert (r.host, r.path, r.rule, r.verdict) == _brute(url)


def test_collisions_do_no_harm(tmp_path):
    path = str(tmp_path / "a.bin")
    DigestArray.write(path, [b"one", b"two", b"three", b"one"])
    array = DigestArray(path)
    assert len(array.digests) == 3 and array.holds([b"two", b"four", b"one"]) == [True, False, True]
    same = np.array([array.digests[1]] * 3)  # digests that all equal a stored one
    assert array.holds([array.key(1), b"other", b""], same) == [True, False, False]


def test_empty_lists_and_tables(spark, tmp_path):
    path = str(tmp_path / "e.bin")
    DigestArray.write(path, [])
    assert DigestArray(path).holds([b"x"]) == [False]
    assert judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0
    df = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert judge_urls(df, rules=(), blocked_urls=()).first().verdict == "allow"


def test_too_long_a_list_is_refused(tmp_path, monkeypatch):
    from dwellspan.llm import urlfilter

    monkeypatch.setattr(urlfilter, "MAX_FILE_BYTES", 10)
    with pytest.raises(ValueError):
        DigestArray.write(str(tmp_path / "x"), [b"abc"])


def test_long_lists_come_from_a_table(spark, tmp_path):
    n = 10**6
    path = str(tmp_path / "listed")
    spark.range(n).selectExpr("concat('http://listed.net/', id) as url").union(spark.createDataFrame([("http://listed.net/5",), (None,)], "url string")).write.parquet(path)
    df = spark.createDataFrame([(i, f"http://listed.net/{k}") for i, k in enumerate((0, 5, n - 1, n, "x"))], "page_id long, url string")
    got = {r.page_id: r.verdict for r in judge_urls(df, blocked_urls=path).collect()}
    assert got == {0: "block", 1: "block", 2: "block", 3: "allow", 4: "allow"}


def test_all_keys_of_one_digest_are_kept_once(tmp_path, monkeypatch):
    import xxhash

    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda x: len(x))
    path = str(tmp_path / "c.bin")
    DigestArray.write(path, [b"aa", b"bb", b"aa", b"c", b"bb", b"dd"])
    array = DigestArray(path)
    assert len(array.digests) == 4 and array.holds([b"aa", b"bb", b"dd", b"ee", b"c", b"d"]) == [True, True, True, False, True, False]


def test_a_list_too_long_for_the_driver_is_sharded(spark, tmp_path, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    from dwellspan.llm import urlfilter

    monkeypatch.setattr(urlfilter, "MAX_DRIVER_BYTES", 1000)
    monkeypatch.setattr(urlfilter, "SHARD_BYTES", 2**20)
    monkeypatch.setattr(urlfilter, "BLOCK_PROBES", 50)
    monkeypatch.setattr(DataFrame, "toArrow", lambda self: pytest.fail("the list reaches the driver"))
    n, path = 200_000, str(tmp_path / "listed")
    spark.range(n).selectExpr("concat('http://listed.net/', id) as url").union(spark.createDataFrame([("http://listed.net/5",), (None,), ("",), ("http://EXAMPLE.org/",)], "url string")).write.parquet(path)
    assert urlfilter.list_bytes(spark, path) > 5 * 2**20
    urls = [*URLS, *(f"http://listed.net/{k}" for k in (0, n - 1, n, "x")), *["http://listed.net/5"] * 5000, *(f"http://other.net/{k}" for k in range(3000))]
    df = spark.createDataFrame([*enumerate(urls), (None, "http://listed.net/7")], "page_id long, url string")
    got = judge_urls(df, blocked_urls=path).collect()
    assert sorted(r.page_id for r in got if r.page_id is not None) == list(range(len(urls)))
    for r in got:
        url = "http://listed.net/7" if r.page_id is None else urls[r.page_id]
        host, path_, rule, verdict = _brute(url)
        held = url is not None and (url == "" or (url.startswith("http://listed.net/") and url[18:].isdigit() and int(url[18:]) < n))
        assert (r.host, r.path, r.rule) == (host, path_, rule)
        assert r.verdict == (verdict if rule else "block" if held else "allow"), url
    assert judge_urls(df.limit(0), blocked_urls=path).count() == 0
