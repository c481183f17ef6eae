"""URL filters: rules and listed urls as sorted digest arrays that executors map into memory.

An array holds the sorted 64-bit xxhash of each key and the keys themselves. Probes are hashed and
looked up by one binary search for a whole batch; a hit counts only if the stored string
equals the probe, so collisions do no harm. The files lie in the shared folder, go to executors once, by
Spark's file service, and are mapped, not loaded; ``MAX_FILE_BYTES`` bounds them. Long lists come from a Parquet table of
urls by its path. Spark measures such a list first: one of more than ``MAX_DRIVER_BYTES`` never reaches the driver, but is dealt by url in shards, of each
of which a task makes an array, and the urls to be judged, each distinct one once, meet their shard's array in blocks of bounded size.

A rule is a host and a path: it fits that host and its subdomains where the url's path starts with
the rule's. The longest fitting rule wins; of equally long ones that of the longer host. Urls that no
rule fits are blocked if they are in the list of blocked urls, as whole strings, else allowed.

Host: after the first :// up to /, ? or #, A-Z lower-cased; path: up to ? or #. A null url, or one
without ://, has both empty and is allowed. Only the ends of a host that are as long as some rule's host
are probed, so hosts of any number of labels cost the same. Each row is judged by itself; columns other than
page_id and url are left out; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator

from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, own_dir, table, written

#: verdict, host, path; the longest fitting one wins.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
BLOCKED_URLS = ("http://malware.example.net/", "https://malware.example.net/", "http://phishing.example.net/login", "https://phishing.example.net/login")
MAX_FILE_BYTES = 2**31
#: Lists in tables that are longer than this are sharded; shards have about so many bytes, and blocks of probes so many urls.
MAX_DRIVER_BYTES, SHARD_BYTES, BLOCK_PROBES = 2**26, 2**24, 200_000
PART_BYTES = 2**24
PARTS = r"://([^/?#]*)([^?#]*)"
VERDICTS = "page_id long, host string, path string, rule string, verdict string"


def _slices(strings) -> Iterator:
    for at in range(0, len(strings), 65_536):
        yield strings.slice(at, 65_536)


class DigestArray:
    """Keys as a sorted array of digests, with the strings beside it, in one file (a path) or in memory (its bytes)."""

    def __init__(self, path: str | bytes) -> None:
        import numpy as np

        if isinstance(path, bytes):
            n = int(np.frombuffer(path, "<u8", 1)[0])
            self.digests, self.ends = np.frombuffer(path, "<u8", n, 8), np.frombuffer(path, "<u8", n + 1, 8 + 8 * n)
            self.strings = np.frombuffer(path, np.uint8, int(self.ends[-1]), 16 + 16 * n)
            return
        n = int(np.fromfile(path, "<u8", 1)[0])
        self.digests = np.memmap(path, "<u8", "r", 8, (n,)) if n else np.empty(0, "<u8")
        self.ends = np.memmap(path, "<u8", "r", 8 + 8 * n, (n + 1,))
        size = int(self.ends[-1])
        self.strings = np.memmap(path, np.uint8, "r", 16 + 16 * n, (size,)) if size else np.empty(0, np.uint8)

    @staticmethod
    def content(keys: Iterable) -> Iterator[bytes]:
        """The file's bytes for keys, Arrow arrays of strings, in parts; repeated keys count once."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from xxhash import xxh64_intdigest

        chunks = [c for k in keys for c in _slices(k.cast(pa.large_binary()).drop_null())]
        strings = pa.concat_arrays(chunks) if chunks else pa.array([], pa.large_binary())
        digests = np.concatenate([np.empty(0, np.uint64), *(np.fromiter(map(xxh64_intdigest, c.to_pylist()), np.uint64, len(c)) for c in chunks)])
        order = np.argsort(digests, kind="stable")
        digests, strings = digests[order], strings.take(pa.array(order))
        keep, held, last = np.ones(len(digests), bool), set(), -1
        for at in (np.flatnonzero(digests[1:] == digests[:-1]) + 1).tolist():  # repeated keys, or collisions
            if at - 1 != last:
                held = {strings[at - 1].as_py()}
            key = strings[at].as_py()
            keep[at], last = key not in held, at
            held.add(key)
        if not keep.all():
            digests, strings = digests[keep], strings.filter(pa.array(keep))
        ends = np.concatenate([[0], np.cumsum(pc.binary_length(strings).to_numpy(zero_copy_only=False))]).astype("<u8")
        if 16 + 16 * len(digests) + int(ends[-1]) > MAX_FILE_BYTES:
            raise ValueError(f"{len(digests)} keys take more than {MAX_FILE_BYTES} bytes; split the list and filter in turns")
        yield np.array([len(digests)], "<u8").tobytes()
        yield digests.astype("<u8").tobytes()
        yield ends.tobytes()
        for part in _slices(strings):
            yield b"".join(part.to_pylist())

    @classmethod
    def write(cls, path: str, keys: Iterable[bytes]) -> None:
        import pyarrow as pa

        with open(path, "wb") as out:
            out.writelines(cls.content([pa.array([*keys], pa.large_binary())]))

    def key(self, at: int) -> bytes:
        return self.strings[int(self.ends[at]) : int(self.ends[at + 1])].tobytes()

    def holds(self, probes: list[bytes], digests=None) -> list[bool]:
        """Whether each probe is a key."""
        import numpy as np
        from xxhash import xxh64_intdigest

        if not probes or not len(self.digests):
            return [False] * len(probes)
        wanted = np.fromiter(map(xxh64_intdigest, probes), np.uint64, len(probes)) if digests is None else digests
        first = np.searchsorted(self.digests, wanted)
        found = self.digests[np.minimum(first, len(self.digests) - 1)] == wanted
        out = [False] * len(probes)
        for i in np.flatnonzero(found):
            at = int(first[i])
            while at < len(self.digests) and self.digests[at] == wanted[i]:  # all keys of one digest
                if self.key(at) == probes[i]:
                    out[i] = True
                    break
                at += 1
        return out


def split_url(url: str | None) -> tuple[str, str]:
    found = re.search(PARTS, url or "")
    return (found[1].translate({k: k + 32 for k in range(65, 91)}), found[2]) if found else ("", "")


def candidates(host: str, path: str, host_lengths: tuple[int, ...], path_lengths: tuple[int, ...]) -> Iterator[str]:
    """host/path keys of the rules that may fit, the longest first, longer hosts first."""
    ends = [host[len(host) - n :] for n in host_lengths if n == len(host) or (n < len(host) and host[-n - 1] == ".")]
    both = [(s, path[:n]) for s in ends for n in path_lengths if n <= len(path)]
    both.sort(key=lambda x: (-len(x[0]) - len(x[1]), -len(x[0])))
    return (f"{s}\n{p}" for s, p in both)


def _shared(spark: SparkSession, keys: Iterable) -> str:
    """Put a DigestArray of Arrow arrays into the shared folder and hand it to all executors; its file name."""
    name = f"digests-{uuid.uuid4().hex}.bin"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{own_dir(spark)}/{name}")
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = store.create(path)
    for part in DigestArray.content(keys):
        for at in range(0, len(part), PART_BYTES):
            out.write(bytearray(part[at : at + PART_BYTES]))
    out.close()
    spark.sparkContext.addFile(store.makeQualified(path).toString())
    return name


def listed_urls(spark: SparkSession, urls: str | Iterable[str]) -> Iterable:
    """Arrow arrays of urls: those given, or the column url of the Parquet table at a path, batch by batch."""
    import pyarrow as pa

    if not isinstance(urls, str):
        return [pa.array([*urls], pa.string())]
    return spark.read.parquet(urls).select("url").toArrow().column(0).chunks


def list_bytes(spark: SparkSession, path: str) -> int:
    """About what the list at a path takes as an array."""
    return spark.read.parquet(path).agg(F.sum(F.octet_length("url") + 16)).first()[0] or 0


def blocked_among(urls: DataFrame, path: str, size: int) -> DataFrame:
    """The distinct urls of urls (url) that the list at a path, of about size bytes, holds; neither side passes the driver, nor a task as a whole."""
    shards = max(1, -(-size // SHARD_BYTES))
    shard = F.pmod(F.xxhash64("url"), F.lit(shards)).cast("int")

    def build(own):
        import pyarrow as pa

        return pa.table({"shard": own.column("shard").slice(0, 1), "content": pa.array([b"".join(DigestArray.content(own.column("url").chunks))], pa.binary())})

    def probe(own, arrays):
        import pyarrow as pa

        if not own.num_rows or not arrays.num_rows:
            return pa.table({"url": pa.array([], pa.string())})
        urls = own.column("url").to_pylist()
        hits = DigestArray(arrays.column("content")[0].as_py()).holds([u.encode() for u in urls])
        return pa.table({"url": pa.array([u for u, hit in zip(urls, hits, strict=True) if hit], pa.string())})

    listed = urls.sparkSession.read.parquet(path).select("url").where("url is not null").distinct().withColumn("shard", shard)
    arrays = listed.groupBy("shard").applyInArrow(build, "shard int, content binary")
    probes = written(urls.where("url is not null").select("url").distinct(), "probes")
    blocks = max(1, -(-probes.count() // (shards * BLOCK_PROBES)))
    probes = probes.withColumns({"shard": shard, "block": F.pmod(F.xxhash64("url", F.lit(1)), F.lit(blocks)).cast("int")})
    arrays = arrays.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return probes.groupBy("shard", "block").cogroup(arrays.groupBy("shard", "block")).applyInArrow(probe, "url string")


def judge_urls(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, blocked_urls: str | Iterable[str] = BLOCKED_URLS) -> DataFrame:
    """VERDICTS for each row of pages (page_id, url); blocked_urls are strings, or the path of a Parquet table with column url."""
    import pyarrow as pa

    spark = pages.sparkSession
    size = list_bytes(spark, blocked_urls) if isinstance(blocked_urls, str) else 0
    sharded = size > MAX_DRIVER_BYTES
    allowed, blocked = (_shared(spark, [pa.array([f"{h}\n{p}" for v, h, p in rules if v == verdict], pa.string())]) for verdict in ("allow", "block"))
    listed = _shared(spark, [] if sharded else listed_urls(spark, blocked_urls))
    host_lengths, path_lengths = (tuple(sorted({len(r[k]) for r in rules if r[1]})) for k in (1, 2))

    def judge(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from xxhash import xxh64_intdigest

        allow, block, urls_blocked = (DigestArray(SparkFiles.get(x)) for x in (allowed, blocked, listed))
        names = [x.split()[0] for x in VERDICTS.split(", ")] + ["url"] * sharded
        for batch in batches:
            urls = batch.column(1).to_pylist()
            parts = [split_url(u) for u in urls]
            probes, owner = [], []
            for k, (host, path) in enumerate(parts):
                own = [c.encode() for c in candidates(host, path, host_lengths, path_lengths)]
                probes += own
                owner += [k] * len(own)
            digests = np.fromiter(map(xxh64_intdigest, probes), np.uint64, len(probes))
            rule: list[str | None] = [None] * len(urls)
            verdict: list[str | None] = [None] * len(urls)
            for k, probe, yes, no in zip(owner, probes, allow.holds(probes, digests), block.holds(probes, digests), strict=True):
                if (yes or no) and verdict[k] is None:
                    rule[k], verdict[k] = probe.decode().replace("\n", ""), "allow" if yes else "block"
            rest = [k for k, v in enumerate(verdict) if v is None]
            for k, hit in zip(rest, urls_blocked.holds([(urls[k] or "").encode() for k in rest]), strict=True):
                verdict[k] = "block" if hit else "allow"
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array([h for h, _ in parts], pa.string()), pa.array([p for _, p in parts], pa.string()), pa.array(rule, pa.string()), pa.array(verdict, pa.string()), *[batch.column(1)] * sharded], names)

    if not sharded:
        return map_batches(pages.select("page_id", "url"), judge, VERDICTS)
    judged = written(map_batches(pages.select("page_id", "url"), judge, f"{VERDICTS}, url string"), "judged")
    hits = blocked_among(judged.where("rule is null").select("url"), blocked_urls, size).withColumn("hit", F.lit(True))
    both = judged.join(hits, "url", "left")  # a url that many pages share is split by Spark's handling of skewed joins
    return both.select("page_id", "host", "path", "rule", F.when(F.col("rule").isNull() & F.col("hit"), "block").otherwise(F.col("verdict")).alias("verdict"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


_TABLE = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
_LISTED = ", ".join(f"'{u}'" for u in BLOCKED_URLS)
OP5_SQL = rf"""
WITH rules(verdict, rule_host, rule_path) AS (VALUES {_TABLE}),
p AS (SELECT row_number() OVER () AS r, page_id, url,
             translate(regexp_extract(coalesce(url, ''), '{PARTS}', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(url, ''), '{PARTS}', 2) AS path FROM pages),
best AS (SELECT p.r, arg_max(rule_host || rule_path, (length(rule_host) + length(rule_path), length(rule_host))) AS rule,
                arg_max(verdict, (length(rule_host) + length(rule_path), length(rule_host))) AS verdict
         FROM p JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY p.r)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN url IN ({_LISTED}) THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN best ON p.r = best.r
"""
