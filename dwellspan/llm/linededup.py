"""Drop lines that many documents share, with two Bloom filters before the exact count.

A first pass hashes each document's distinct line keys into a filter of once-seen and one of
twice-seen hashes. Parts of the filters meet by slice; a hash that two parts saw once is
seen twice. Only keys in the twice-seen filter, which errs to the safe side, are counted
exactly, after each task has summed its own. The filters have at most MAX_BITS bits: with more
distinct lines they hold more false suspects, which costs shuffle but no right result.

A line's key is the line without white space (space, \\x09-\\x0D) at both ends, A-Z
lower-cased. Keys stand as 128-bit digests. Each row is a document, also where ids
repeat; a null text is one empty line. Other columns stay as they are, and columns named
n_lines or n_dropped are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_batches, table, written

MIN_BITS, MAX_BITS = 2**20, 2**26
BITS_PER_DOC = 64
SLICES = 64
#: A task hands on its counts when it holds so many keys.
FLUSH_KEYS = 200_000
#: Frequent keys are broadcast up to this number; beyond it they are joined.
MAX_BROADCAST_KEYS = 300_000
SLICE_ROWS = 256
STRIP = b" \t\n\x0b\x0c\r"


def line_digests(raw: bytes, min_chars: int) -> tuple[list[bytes], list[bytes | None]]:
    """Lines of a text and the digest of each key; None for keys that are too short."""
    from xxhash import xxh3_128_digest

    lines = raw.split(b"\n")
    out: list[bytes | None] = []
    for line in lines:
        key = line.strip(STRIP).lower()
        long_enough = len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars)
        out.append(xxh3_128_digest(key) if long_enough else None)
    return lines, out


def _texts(batch, column: int) -> Iterator[bytes]:
    import pyarrow as pa

    col = batch.column(column).cast(pa.binary())
    for at in range(0, batch.num_rows, SLICE_ROWS):
        for x in col.slice(at, SLICE_ROWS).to_pylist():
            yield x or b""


def _places(digests, bits: int):
    import numpy as np

    both = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
    return (both & np.uint64(bits - 1)).astype(np.int64)


def twice_seen(docs: DataFrame, bits: int, min_chars: int) -> bytes:
    """The filter of hashes that at least two documents hold: bits / 8 bytes."""

    def build(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        once, twice, any_row = np.zeros(bits, bool), np.zeros(bits, bool), False

        def add(keys: list[bytes]) -> None:
            at = _places(keys, bits)
            _, first, n = np.unique(at, axis=0, return_index=True, return_counts=True)
            again = np.zeros(len(at), bool)
            again[first] = n > 1
            again |= once[at[:, 0]] & once[at[:, 1]]
            twice[at[again].ravel()] = True
            once[at.ravel()] = True

        for batch in batches:
            held: list[bytes] = []
            for raw in _texts(batch, 0):
                any_row = True
                held += {d for d in line_digests(raw, min_chars)[1] if d}
                if len(held) > 50_000:
                    add(held)
                    held = []
            if held:
                add(held)
        if any_row:
            size = bits // SLICES
            pack = lambda x, k: zlib.compress(np.packbits(x[k * size : (k + 1) * size]).tobytes(), 1)
            for k in range(SLICES):
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([pack(once, k)], pa.binary()), pa.array([pack(twice, k)], pa.binary())], ["part", "once", "twice"])

    def meet(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        held: dict[int, list] = {}
        for batch in batches:
            for k, o, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                o, t = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (o, t))
                if k in held:
                    held[k][1] |= t | (held[k][0] & o)
                    held[k][0] |= o
                else:
                    held[k] = [o.copy(), t.copy()]
        for k, (_, t) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([t.tobytes()], pa.binary())], ["part", "twice"])

    parts = map_batches(docs.select("text"), build, "part int, once binary, twice binary").repartition(SLICES, "part")
    found = {r.part: bytes(r.twice) for r in map_batches(parts, meet, "part int, twice binary").collect()}  # bits / 8 bytes at most
    return b"".join(found.get(k, bytes(bits // 8 // SLICES)) for k in range(SLICES))


def frequent_keys(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """digest, n_docs, first_id: keys that at least min_docs documents hold."""
    bits = MIN_BITS
    while bits < MAX_BITS and bits < BITS_PER_DOC * docs.count():
        bits *= 2
    seen = docs.sparkSession.sparkContext.broadcast(twice_seen(docs, bits, min_chars))

    def suspects(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        held: dict[bytes, list] = {}
        table = np.frombuffer(seen.value, np.uint8)

        def rows():
            kinds = (pa.binary(), pa.int64(), pa.int64())
            cols = [*held], [x[0] for x in held.values()], [x[1] for x in held.values()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["digest", "n_docs", "first_id"])

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for doc_id, raw in zip(ids, _texts(batch, 1), strict=True):
                own = [*{d for d in line_digests(raw, min_chars)[1] if d}]
                if not own:
                    continue
                at = _places(own, bits)
                hit = ((table[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=1)
                for i in np.flatnonzero(hit):
                    x = held.setdefault(own[i], [0, doc_id])
                    x[0] += 1
                    if doc_id is not None and (x[1] is None or doc_id < x[1]):
                        x[1] = doc_id
                if len(held) > FLUSH_KEYS:
                    yield rows()
                    held.clear()
        if held:
            yield rows()

    counted = map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), suspects, "digest binary, n_docs long, first_id long")
    return counted.groupBy("digest").agg(F.sum("n_docs").alias("n_docs"), F.min("first_id").alias("first_id")).filter(F.col("n_docs") >= min_docs)


def drop_frequent_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False, max_broadcast_keys: int = MAX_BROADCAST_KEYS) -> DataFrame:
    """docs with the lines of frequent keys gone, and n_lines (before) and n_dropped added.

    keep_first leaves each key's first line in the document of the smallest id that holds it.
    """
    docs = docs.drop("n_lines", "n_dropped")
    keys = written(frequent_keys(docs, min_docs, min_chars), "frequent-lines")
    schema = T.StructType([*docs.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    names = docs.columns
    joined = keys.count() > max_broadcast_keys
    common = None if joined else docs.sparkSession.sparkContext.broadcast({bytes(r.digest): r.first_id for r in keys.select("digest", "first_id").collect()})

    def apply(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            ids = batch.column(names.index("doc_id")).to_pylist()
            own = batch.column(len(names)).to_pylist() if joined else None
            texts, n_lines, n_dropped = [], [], []
            for k, (doc_id, raw) in enumerate(zip(ids, _texts(batch, names.index("text")), strict=True)):
                frequent = common.value if own is None else {bytes(x["digest"]): x["first_id"] for x in own[k] or ()}
                lines, digests = line_digests(raw, min_chars)
                kept, seen = [], set()
                for line, d in zip(lines, digests, strict=True):
                    if d is None or d not in frequent:
                        kept.append(line)
                    elif keep_first and frequent[d] == doc_id and d not in seen:
                        seen.add(d)
                        kept.append(line)
                texts.append(b"\n".join(kept) if len(kept) < len(lines) else raw)
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
            at = names.index("text")
            old = batch.column(at)
            null = old.is_null().to_pylist()
            text = pa.array([None if z else t for t, z in zip(texts, null, strict=True)], pa.binary()).cast(old.type)
            columns = [text if i == at else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], schema.names)

    if joined:
        free = f"held_{max(map(len, names)) * 'x'}"  # no column of docs has this name
        row_key = F.struct(F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("text"))

        def held(batches: Iterator) -> Iterator:
            import pyarrow as pa

            for batch in batches:
                pairs = [(i, d) for i, raw in enumerate(_texts(batch, 1)) for d in {d for d in line_digests(raw, min_chars)[1] if d}]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([p[0] for p in pairs], pa.int64())), pa.array([p[1] for p in pairs], pa.binary())], ["row", "digest"])

        pairs = map_batches(docs.select(row_key.alias("row"), "text"), held, "row struct<doc: bigint, text: bigint>, digest binary")
        lists = pairs.join(keys, "digest").groupBy("row").agg(F.collect_set(F.struct("digest", "first_id")).alias("keys"))
        docs = docs.withColumn(free, row_key)
        docs = docs.join(lists, docs[free].eqNullSafe(lists["row"]), "left").select(*(docs[f"`{c}`"] for c in names), lists["keys"].alias(free))
    return map_batches(docs, apply, schema)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_frequent_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM docs),
keyed AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
frequent AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10),
marked AS (SELECT k.*, f.key IS NOT NULL AS hit FROM keyed k LEFT JOIN frequent f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE hit) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT hit), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""
