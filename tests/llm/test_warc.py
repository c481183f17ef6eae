import gzip
import hashlib
import zlib

import pytest

from dwellspan.llm import warc
from dwellspan.llm.warc import OP6_SQL, WarcError, op6_warc, payload_digest, read_archive, read_archives, record, write_archives


def test_op6_equals_sql(same):
    same(op6_warc, OP6_SQL)


ROWS = [(1, "http://a/\r\nX: y", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u", None), (4, "u", ""), (5, "u", "\r\n\r\nWARC/1.1\r\n\r\n"), (None, "u", "<p>é</p>"), (6, "u", "x" * 300_000), (6, "v", "x" * 300_000), (7, "u", "only")]


@pytest.mark.parametrize("size", [1, 10_000, 2**22])
def test_round_trip(spark, size):
    df = spark.createDataFrame([(*r, "z") for r in ROWS], "page_id long, url string, html string, payload string").repartition(3)
    archives = write_archives(df, archive_bytes=size)
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in read_archives(archives).collect()), key=str)
    newest = {}
    for p, _, h in ROWS:
        if p is not None:
            newest[h or ""] = max(p, newest.get(h or "", p))
    want = []
    for p, _, h in ROWS:
        data = (h or "").encode()
        revisit = p is None or p < newest[h or ""]
        want.append((p, len(data), payload_digest(data), "revisit" if revisit else "response", newest[h or ""] if revisit else None))
    assert got == sorted(want, key=str)


def test_payloads_come_back_whole(spark):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    payloads = {r.page_id: bytes(r.payload) for r in read_archives(write_archives(df)).filter("record_type = 'response'").collect()}
    assert payloads[5] == ROWS[4][2].encode() and payloads[6] == b"x" * 300_000


def test_small_payloads_may_stay_responses(spark):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    kinds = {(r.page_id, r.record_type) for r in read_archives(write_archives(df, min_bytes=10)).collect()}
    assert (1, "response") in kinds and (3, "response") in kinds


def test_one_member_a_record_and_any_chunking():
    whole = record(1, "u", b"a" * 1000) + record(2, "u", b"b") + record(3, "u", b"b", 2)
    assert gzip.decompress(whole).count(b"WARC/1.1") == 3
    for n in (1, 7, 10_000):
        got = [(r[0], r[2], r[4], r[5]) for r in read_archive(whole[i : i + n] for i in range(0, len(whole), n))]
        assert got == [(1, 1000, "response", None), (2, 1, "response", None), (3, 1, "revisit", 2)]


def test_faults_are_found():
    good = record(1, "u", b"payload")
    with pytest.raises(WarcError):
        list(read_archive([good[:-9]]))
    plain = gzip.decompress(good)
    for bad in (plain.replace(b"payload", b"payl0ad"), plain[:-2], plain.replace(b"WARC/1.1", b"HTTP/1.1", 1)):
        with pytest.raises(WarcError):
            list(read_archive([gzip.compress(bad)]))
    with pytest.raises(zlib.error):
        list(read_archive([b"no gzip at all"]))


def test_files_of_others_can_be_read(spark, tmp_path):
    (tmp_path / "a.warc.gz").write_bytes(record(9, "http://x/", b"hello"))
    got = read_archives(spark.read.format("binaryFile").load(str(tmp_path))).first()
    assert (got.page_id, got.url, bytes(got.payload)) == (9, "http://x/", b"hello")
    assert got.payload_digest == warc.base64.b32encode(hashlib.sha1(b"hello").digest()).decode()


def test_empty(spark):
    assert read_archives(write_archives(spark.createDataFrame([], "page_id long, url string, html string"))).count() == 0


def test_files_and_broken_revisits(spark, tmp_path):
    import glob
    import gzip

    rows = [(i, f"http://a/{i}", "same page" if i % 3 else f"page {i} " * (5000 if i == 9 else 1)) for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    uri = (tmp_path / "w").as_uri()
    written_ = warc.write_files(warc.write_archives(pages, archive_bytes=2000), uri).collect()
    found = glob.glob(f"{tmp_path}/w/*.warc.gz")
    assert len(found) == len(written_) > 1 and not glob.glob(f"{tmp_path}/w/.*")
    assert gzip.open(found[0]).read().startswith(b"WARC/1.1")
    records = warc.read_files(spark, uri)
    got = {r.page_id: r for r in records.collect()}
    assert len(got) == 40 and all(got[i].payload is None or bytes(got[i].payload).decode() == html for i, _, html in rows)
    assert sum(r.record_type == "revisit" for r in got.values()) == 25 and warc.broken_revisits(records).count() == 0
    wrong = records.filter("page_id <> 38").union(spark.createDataFrame([(50, "u", 3, "AAAA", "revisit", 9, None)], records.schema))
    assert {r.page_id for r in warc.broken_revisits(wrong).collect()} == {i for i in range(38) if i % 3} | {50}


def test_a_member_that_goes_on_is_refused_before_it_is_inflated():
    from itertools import chain

    whole = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    taken = []

    def bomb():
        for n in range(10_000):
            taken.append(n)
            yield bytes(65536)

    with pytest.raises(WarcError, match="goes on"):
        warc.read_record(chain([whole], bomb()))
    assert len(taken) == 1
    with pytest.raises(WarcError):
        warc.read_record(iter([whole + whole]))
    assert warc.read_record(iter([whole[:20], whole[20:]]))[1] == b"abc"
    with pytest.raises(WarcError, match="Content-Length"):
        warc.read_record(iter([whole[:-1]]))
