"""WARC archives: records written one gzip member each, and a sequential reader.

An archive is a row (archive, content), as Spark's binaryFile source gives it, so archives travel
through Spark's own writers to any store and the reader takes both kinds. As files, of any size, they are written by
``write_files`` and read by ``read_files``, a piece at a time, in any store that Arrow knows. The reader inflates
piece by piece, finds each block by its Content-Length, and checks payload digests; ``broken_revisits`` checks those
of revisits against their responses.

Of pages with equal payloads of at least min_bytes, the one with the largest page_id is the
response; the others become revisits that name it and hold the HTTP header only. Pages
that share that largest id and the payload are all responses; pages without an id refer to it.
A null html is an empty payload, a null url leaves out the target. Control characters in urls are
percent-encoded. An empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, table, written

#: An archive is closed when it has grown to so many bytes.
ARCHIVE_BYTES = 4 * 2**20
CHUNK = 2**16
DATE = "2000-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


class WarcError(ValueError):
    """A record that breaks the format or its digest."""


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None) -> bytes:
    """One gzip member with a response, or with a revisit if refers_to is given."""
    revisit = refers_to is not None
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + (b"" if revisit else payload)
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    fields.append(("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"))
    if revisit:
        fields += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    zipped = zlib.compressobj(6, zlib.DEFLATED, 31)
    return zipped.compress(head.encode() + block + b"\r\n\r\n") + zipped.flush()


def members(chunks: Iterable[bytes]) -> Iterator[Iterator[bytes]]:
    """For each gzip member an iterator of its inflated pieces; each must be used up before the next."""
    source, rest = iter(chunks), b""
    while True:
        while not rest:
            rest = next(source, None)
            if rest is None:
                return
        inflate = zlib.decompressobj(31)

        def pieces(inflate=inflate) -> Iterator[bytes]:
            nonlocal rest
            while not inflate.eof:
                if not rest:
                    rest = next(source, None)
                    if rest is None:
                        raise WarcError("the archive ends within a member")
                out = inflate.decompress(rest, CHUNK)
                rest = inflate.unused_data if inflate.eof else inflate.unconsumed_tail
                if out:
                    yield out

        yield pieces()


def read_record(pieces: Iterator[bytes]) -> tuple[dict[str, str], bytes]:
    """Header fields, by lower-cased name, and block of the one record in a member."""
    held = bytearray()
    while (at := held.find(b"\r\n\r\n")) < 0:
        piece = next(pieces, None)
        if piece is None:
            raise WarcError("a record without a full header")
        held += piece
    first, *lines = held[:at].decode("utf-8").split("\r\n")
    if not first.startswith("WARC/"):
        raise WarcError("no WARC record here")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    length = int(fields["content-length"])
    for piece in pieces:
        held += piece
        if len(held) > at + 4 + length + 4:
            raise WarcError("a member goes on behind its record")  # it is not inflated further
    if len(held) != at + 4 + length + 4 or held[-4:] != b"\r\n\r\n":
        raise WarcError("the block's length is not Content-Length")
    return fields, bytes(held[at + 4 : at + 4 + length])


def _id(text: str) -> int | None:
    found = text.removeprefix("<urn:page:").removesuffix(">")
    return int(found) if found else None


def read_archive(chunks: Iterable[bytes]) -> Iterator[tuple]:
    """Rows of RECORDS; raises WarcError where a digest or length is wrong."""
    for member in members(chunks):
        fields, block = read_record(member)
        head, mark, payload = block.partition(b"\r\n\r\n")
        said = re.search(rb"(?im)^content-length:\s*(\d+)", head)
        if not mark or not said:
            raise WarcError("a block without an HTTP header")
        digest, kind = fields["warc-payload-digest"].removeprefix("sha1:"), fields["warc-type"]
        if kind == "response" and (int(said[1]) != len(payload) or payload_digest(payload) != digest):
            raise WarcError(f"the payload of {fields['warc-record-id']} is not what its digest says")
        refers = _id(fields["warc-refers-to"]) if kind == "revisit" else None
        yield _id(fields["warc-record-id"]), fields.get("warc-target-uri"), int(said[1]), digest, kind, refers, payload if kind == "response" else None


def write_archives(pages: DataFrame, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """archive, content: the pages as WARC archives."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.encode("html", "UTF-8"), F.lit(b"")).alias("payload"))
    keyed = pages.withColumn("sha", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    groups = keyed.filter(F.col("size") >= min_bytes).groupBy("sha", "size").agg(F.count("*").alias("n"), F.max("page_id").alias("response"))
    # only payloads that repeat; as a table its size is known, so that Spark broadcasts it only if it is small
    groups = written(groups.filter("n > 1 and response is not null").drop("n"), "equal-payloads")
    dealt = keyed.join(groups, ["sha", "size"], "left").select("page_id", "url", "payload", F.expr("if(page_id is null or page_id < response, response, null)").alias("refers_to"))

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        task, n, held, size = TaskContext.get().partitionId(), 0, [], 0
        out = lambda: pa.RecordBatch.from_arrays([pa.array([f"part-{task:06d}-{n:06d}.warc.gz"]), pa.array([b"".join(held)], pa.binary())], ["archive", "content"])
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for row in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns), strict=True):
                    held.append(record(*row))
                    size += len(held[-1])
                    if size >= archive_bytes:
                        yield out()
                        n, held, size = n + 1, [], 0
        if held:
            yield out()

    return map_batches(dealt, write, "archive string, content binary")


def _batched(rows: Iterable[tuple], with_payload: bool, size: int = 256) -> Iterator:
    """RECORDS as Arrow batches."""
    import pyarrow as pa

    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
    names = [x.split()[0] for x in RECORDS.split(", ")]
    held: list[tuple] = []
    made = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), kinds, strict=True)], names)
    for row in rows:
        held.append(row if with_payload else (*row[:6], None))
        if len(held) == size:
            yield made()
            held = []
    if held:
        yield made()


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """RECORDS of all archives; archives has their bytes in content."""

    def read(batches: Iterator) -> Iterator:
        for batch in batches:
            for i in range(batch.num_rows):
                content = memoryview(batch.column(0)[i].as_buffer() or b"")
                yield from _batched(read_archive(bytes(content[k : k + CHUNK]) for k in range(0, len(content), CHUNK)), with_payload)

    return map_batches(archives.select("content"), read, RECORDS)


def write_files(archives: DataFrame, uri: str) -> DataFrame:
    """Write each archive as a file in the folder uri; archive, bytes. A file takes its name when it is whole, so a task that is run again does no harm."""

    def write(batches: Iterator) -> Iterator:
        import uuid

        import pyarrow as pa
        from pyarrow import fs

        store, folder = fs.FileSystem.from_uri(uri)
        store.create_dir(folder, recursive=True)
        for batch in batches:
            for i, name in enumerate(batch.column(0).to_pylist()):
                content = batch.column(1)[i].as_buffer()
                part = f"{folder}/.{name}.{uuid.uuid4().hex}"
                with store.open_output_stream(part, compression=None) as out:
                    out.write(content)
                store.move(part, f"{folder}/{name}")
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([content.size])], ["archive", "bytes"])

    return map_batches(archives.select("archive", "content"), write, "archive string, bytes long")


def read_files(spark: SparkSession, uri: str, with_payload: bool = True) -> DataFrame:
    """RECORDS of all files *.warc.gz in the folder uri; a task holds CHUNK bytes and a record of its file at once."""
    from pyarrow import fs

    store, folder = fs.FileSystem.from_uri(uri)
    names = sorted(f.path for f in store.get_file_info(fs.FileSelector(folder)) if f.path.endswith(".warc.gz") and not f.base_name.startswith("."))
    files = spark.createDataFrame([(n,) for n in names], "path string").repartition(max(1, min(len(names), 10_000)), "path")

    def read(batches: Iterator) -> Iterator:
        store, _ = fs.FileSystem.from_uri(uri)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with store.open_input_stream(path, compression=None) as file:
                    yield from _batched(read_archive(iter(lambda: file.read(CHUNK), b"")), with_payload)  # noqa: B023

    return map_batches(files, read, RECORDS)


def broken_revisits(records: DataFrame) -> DataFrame:
    """page_id, refers_to, payload_digest of the revisits whose response is missing or has another payload."""
    responses = records.filter("record_type = 'response'").select(F.col("page_id").alias("r_id"), F.col("payload_digest").alias("r_digest"), F.col("payload_bytes").alias("r_bytes"))
    revisits = records.filter("record_type = 'revisit'").select("page_id", "refers_to", "payload_digest", "payload_bytes")
    same = (F.col("refers_to") == F.col("r_id")) & (F.col("payload_digest") == F.col("r_digest")) & (F.col("payload_bytes") == F.col("r_bytes"))
    return revisits.join(responses, same, "left_anti").drop("payload_bytes")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = written(write_archives(table(spark, sf_dir, "pages")), "warc")
    return read_archives(archives, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP6_SQL = r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
k AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex, max(page_id) OVER (PARTITION BY payload) AS newest FROM p),
b AS (SELECT *, list_reduce(list_transform(range(1, 41), lambda i: lpad(bin(position(substr(hex, i, 1) IN '0123456789abcdef') - 1), 4, '0')), lambda x, y: x || y) AS bits FROM k)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
       list_reduce(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + list_sum(list_transform(range(1, 6), lambda j: substr(bits, i * 5 + j, 1)::INT * (1 << (5 - j))))::INT, 1)), lambda x, y: x || y) AS payload_digest,
       CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id < newest THEN newest END AS refers_to
FROM b
"""
