"""Near-duplicate documents by one-permutation MinHash, exact links and their components.

Each document's set of 5-word shingles, hashed to 64 bits, is cut into BINS by its top bits; the
least hash of each bin is the signature. Empty bins copy from the first non-empty bin of a fixed
random order of their own (optimal densification). BANDS of ROWS bins hash to buckets.

Candidate edges are stars: in each bucket every member has an edge to the member of the smallest id,
so a bucket of n gives n - 1 edges. The components of these edges are families: two documents
that share a bucket are in one. Links are confirmed on full sets within families. First each member meets
the family's hub, its member of the smallest id. Members that the hub links are joined already and need not
meet each other; only the others meet all members but the hub, in blocks of bounded size two by two,
and each block pair gives a forest of its links, at most an edge a document. So no link between members that both differ from a
hub is lost, no pairs travel, and a large group of copies of one text costs one meeting a copy.
At similarity 0.85 a pair shares no bucket with a probability of (1 - 0.85^5)^25, under 1e-6; at 0.8 it is 5e-5.

Documents of equal sets are one node, so copies never meet in pairs. Texts without words, and null
texts, have empty sets and no links. Rows that repeat an id are all returned and count as one
document: all links of its texts are its own, so they join what each of them is linked with. Rows without an id
take their component from equal sets only. Other columns are left out
by ``near_duplicates``; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import key_filter, map_batches, may_hold, table, written

BINS, ROWS, BANDS = 128, 5, 25
SHINGLE = 5
#: Links have 100 * intersection >= PERCENT * union, unless a caller gives its own percent.
PERCENT = 85
#: About so many shingles, and documents, of a family make a block.
BLOCK_SHINGLES, BLOCK_DOCS = 150_000, 256
#: Members of a family that meet its hub in one part.
PART_DOCS = 512
#: Columns of a block's document-shingle matrix that are counted at once.
COLUMNS = 16_384
SEED = 20240501
SIGNATURES = "doc_id long, n_shingles long, same binary, bands array<long>"


_MADE: dict = {}


def _constants():
    """Multipliers of shingles and bands, salts of bands, probe orders and bin edges; made once a process."""
    import numpy as np

    if _MADE:
        return _MADE["all"]
    rng = np.random.default_rng(SEED)
    odd = rng.integers(0, 2**63, SHINGLE + ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
    probe = np.argsort(rng.random((BINS, BINS)), axis=1)
    _MADE["all"] = odd[:SHINGLE], odd[SHINGLE:], rng.integers(0, 2**63, BANDS, np.uint64), probe, np.arange(BINS, dtype=np.uint64) << np.uint64(64 - 7)
    return _MADE["all"]


def _mixed(x):
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes, n: int = SHINGLE):
    """Sorted distinct hashes of the n-word shingles; fewer words make one shingle."""
    import numpy as np
    from xxhash import xxh3_64_intdigest

    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    multipliers = _constants()[0]
    hashed = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    if len(words) < n:
        return _mixed((hashed * multipliers[: len(words)]).sum(keepdims=True, dtype=np.uint64) + np.uint64(len(words)))
    joint = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        joint += hashed[k : len(words) - n + 1 + k] * multipliers[k]
    return np.unique(_mixed(joint))


def signature(hashes):
    """The least hash of each bin, with empty bins filled; hashes are sorted, distinct and not none."""
    import numpy as np

    _, _, _, probe, edges = _constants()
    first = np.searchsorted(hashes, edges)
    full = np.append(first[1:], len(hashes)) > first
    source = probe[np.arange(BINS), full[probe].argmax(axis=1)]
    source[full] = np.flatnonzero(full)
    return hashes[first[source]]


def sign(docs: DataFrame) -> DataFrame:
    """SIGNATURES of doc_id and text; same is equal for equal sets only."""

    def rows(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from xxhash import xxh3_128_digest

        _, multipliers, salts, _, _ = _constants()
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.binary())
            for at in range(0, batch.num_rows, 512):
                sizes, same, bands = [], [], []
                for text in texts.slice(at, 512).to_pylist():
                    hashes = shingle_set(text or b"")
                    sizes.append(len(hashes))
                    if len(hashes):
                        values = signature(hashes)
                        same.append(xxh3_128_digest(hashes.tobytes()))
                        bands.append(_mixed((values[: BANDS * ROWS].reshape(BANDS, ROWS) * multipliers).sum(axis=1, dtype=np.uint64) + salts).view(np.int64))
                    else:
                        same.append(None)
                        bands.append(np.empty(0, np.int64))
                ends = np.cumsum([0, *map(len, bands)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(bands) if bands else np.empty(0, np.int64)))
                yield pa.RecordBatch.from_arrays([ids.slice(at, 512), pa.array(sizes, pa.int64()), pa.array(same, pa.binary()), lists], ["doc_id", "n_shingles", "same", "bands"])

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), rows, SIGNATURES)


def components(links: DataFrame) -> DataFrame:
    """id, component for each id in links (a, b): the smallest id reachable; ids that are a component's smallest are left out.

    Large and small stars in turn; each round is written to the shared folder.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), "edges")
    last = None
    while True:
        both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).union(edges.select("v", "u"))
        least = both.groupBy("x").agg(F.min("y").alias("y0")).select("x", F.least("x", "y0").alias("m"))
        large = both.join(least, "x").filter("y > x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "large-star")
        roots = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(roots, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(roots).filter("u > v").distinct()
        edges = written(small, "small-star")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == last:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
        last = now


def forest(ids: list[int], sets: list, cross: int | None = None, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Edges (a, b) that join all linked documents; with cross, of pairs of one before it and one from it on."""
    import numpy as np

    n = len(ids)
    sizes = np.array([len(x) for x in sets])
    shared = np.zeros((n, n), np.float32)
    _, column, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), sizes)
    often = df[column] > 1
    new = np.cumsum(df > 1) - 1
    row, column = row[often], new[column[often]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        lo, hi = np.searchsorted(column, (start, start + COLUMNS))
        held = np.zeros((n, int(column[hi - 1]) - start + 1), np.float32)
        held[row[lo:hi], column[lo:hi] - start] = 1
        shared += held @ held.T
    shared = shared.astype(np.float64)
    linked = 100 * shared >= percent * (sizes[:, None] + sizes[None, :] - shared)
    if cross is not None:
        linked[:cross, :cross] = linked[cross:, cross:] = False
    edges, seen = [], np.zeros(n, bool)
    for first in range(n):
        front = [] if seen[first] else [first]
        seen[first] = True
        while front:
            at = front.pop()
            for k in np.flatnonzero(linked[at] & ~seen).tolist():
                seen[k] = True
                edges.append((ids[at], ids[k]))
                front.append(k)
    return edges


def member_sets(members: DataFrame, docs: DataFrame) -> DataFrame:
    """members (rep, same, and other small columns) with the sorted hashes of their sets.

    A filter of the members' ids goes to the texts, so that only sets of members, and few others, are dealt out.
    """
    held = docs.sparkSession.sparkContext.broadcast(key_filter(members.select(F.xxhash64("rep").alias("key"))))

    def rows(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from xxhash import xxh3_128_digest

        for batch in batches:
            own = pa.table(batch).filter(pa.array(may_hold(held.value, batch.column(1).to_numpy()))).combine_chunks()
            texts = own.column(2).cast(pa.binary())
            for at in range(0, len(own), 512):
                hashes = [shingle_set(x or b"").tobytes() for x in texts.slice(at, 512).to_pylist()]
                yield pa.RecordBatch.from_arrays([own.column(0).slice(at, 512).combine_chunks(), pa.array([xxh3_128_digest(h) for h in hashes], pa.binary()), pa.array(hashes, pa.binary())], ["rep", "same", "hashes"])

    id_ = F.col("doc_id").cast("long")
    sets = map_batches(docs.filter(id_.isNotNull()).select(id_.alias("rep"), F.xxhash64(id_).alias("key"), "text"), rows, "rep long, same binary, hashes binary")
    small = [c for c in members.columns if c not in ("rep", "same")]
    # an id may have other texts; rows that repeat id and text are one
    return sets.join(members, ["rep", "same"]).groupBy("rep", "same").agg(*(F.first(c).alias(c) for c in small), F.first("hashes").alias("hashes"))


def only_held(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """rows without most of those whose columns on stand in no row of keys; for joins that follow, so that less is dealt out."""
    held = rows.sparkSession.sparkContext.broadcast(key_filter(keys.select(F.xxhash64(*on).alias("key"))))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            yield from pa.table(batch).filter(pa.array(may_hold(held.value, batch.column(0).to_numpy()))).to_batches()

    schema = rows.select(F.xxhash64(*on).alias("key"), "*").schema
    return map_batches(rows.select(F.xxhash64(*on).alias("key"), "*"), run, schema).drop("key")


def by_run(df: DataFrame, n: int, run: Callable) -> DataFrame:
    """Edges (a, b) from run(key, rows) for the rows that agree in the first n columns; df is dealt and sorted by these."""

    def rows(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def done():
            edges = run(at, held)
            return pa.RecordBatch.from_arrays([pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)], ["a", "b"])

        at, held = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:n] != at:
                    if len(held) > 1:
                        yield done()
                    at, held = row[:n], []
                held.append(row[n:])
        if len(held) > 1:
            yield done()

    return map_batches(df, rows, "a long, b long")


def hub_links(sets: DataFrame, percent: int) -> DataFrame:
    """Edges (hub, rep) of the members whose set links to the hub's; sets have is_hub and the number of parts of their family."""
    part = F.when(F.col("is_hub"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(F.expr("cast(pmod(xxhash64(rep, same), parts) as int)")))
    dealt = sets.select("family", F.explode(part).alias("part"), (~F.col("is_hub")).alias("later"), "rep", "hashes")
    dealt = dealt.repartition("family", "part").sortWithinPartitions("family", "part", "later")

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        name, hub = None, np.empty(0, np.uint64)
        for batch in batches:
            out: list[tuple[int, int]] = []
            hashes = batch.column(4)
            for k, (later, rep) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                own = np.frombuffer(hashes[k].as_py(), np.uint64)
                if not later:
                    name, hub = rep, own
                elif 100 * min(len(own), len(hub)) >= percent * max(len(own), len(hub)):  # else the sizes alone rule it out
                    at = np.minimum(np.searchsorted(hub, own), len(hub) - 1)
                    shared = int((hub[at] == own).sum())
                    if 100 * shared >= percent * (len(own) + len(hub) - shared):
                        out.append((name, rep))
            yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    return map_batches(dealt, run, "a long, b long")


def links(members: DataFrame, docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Edges (a, b) that join the linked documents of each family; members are (rep, family, n, same)."""
    hubs = members.groupBy("family").agg(F.min(F.struct("rep", "same")).alias("hub"), F.ceil(F.count("*") / PART_DOCS).cast("int").alias("parts"))
    placed = members.join(hubs, "family").withColumn("is_hub", F.struct("rep", "same") == F.col("hub"))
    sets = written(member_sets(written(placed, "members"), docs), "sets")
    first = written(hub_links(sets, percent), "hub-links")
    joined = first.select(F.col("b").alias("rep")).distinct().withColumn("met", F.lit(True))
    rest = sets.filter("not is_hub").select("rep", "same", "family", "n", (F.col("rep") == F.col("hub.rep")).alias("own")).join(joined, "rep", "left")
    rest = written(rest.select("rep", "same", "family", "n", (F.col("own") | F.col("met").isNotNull()).alias("linked")), "rest")
    blocks = F.greatest(F.ceil(F.sum("n") / BLOCK_SHINGLES), F.ceil(F.count("*") / BLOCK_DOCS)).cast("int")
    sizes = rest.groupBy("family", "linked").agg(blocks.alias("blocks"), F.count("*").alias("docs"))
    of = lambda column, linked, name: F.coalesce(F.max(F.when(F.col("linked") == linked, F.col(column))), F.lit(0)).alias(name)
    sizes = sizes.groupBy("family").agg(of("blocks", False, "open"), of("blocks", True, "closed"), of("docs", False, "open_docs"), of("docs", True, "closed_docs"))
    dealt = rest.join(sizes.filter("open_docs > 0 and open_docs + closed_docs > 1"), "family")
    # blocks of members that the hub does not link come first; the others meet only those
    dealt = dealt.withColumn("block", F.expr("cast(if(linked, open + pmod(xxhash64(rep, same), greatest(closed, 1)), pmod(xxhash64(rep, same), open)) as int)"))
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0, if(linked, open, open + closed) - 1)")))
    dealt = written(dealt.select("rep", "same", "family", "block", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q")), "blocks")
    met = dealt.join(only_held(sets.select("rep", "same", "hashes"), dealt, ["rep", "same"]), ["rep", "same"]).select("family", "p", "q", "block", "rep", "hashes")
    met = met.repartition("family", "p", "q").sortWithinPartitions("family", "p", "q", "block", "rep")

    def run(key, rows):
        import numpy as np

        _, p, q = key
        cross = None if p == q else sum(block == p for block, _, _ in rows)
        return forest([rep for _, rep, _ in rows], [np.frombuffer(raw, np.uint64) for _, _, raw in rows], cross, percent)

    return first.union(by_run(met, 3, run))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs (doc_id, text); links are of percent similarity or more."""
    signed = written(sign(docs), "signatures")
    groups = written(signed.filter("n_shingles > 0").groupBy("same").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("bands").alias("bands"), F.max("n_shingles").alias("n")), "equal-sets")
    nodes = groups.filter("rep is not null")
    dealt = nodes.select(F.explode("bands").alias("key"), "rep")
    hubs = dealt.groupBy("key").agg(F.min("rep").alias("hub"), F.count("*").alias("size")).filter("size > 1").select("key", "hub")
    families = components(dealt.join(hubs, "key").select(F.col("rep").alias("a"), F.col("hub").alias("b")).filter("a != b").distinct())
    placed = families.union(families.select("component", "component").distinct()).toDF("id", "family")
    members = nodes.select("rep", "n", "same").join(placed, nodes.rep == placed.id).select("rep", "family", "n", "same")
    copies = groups.select(F.col("same").alias("s"), "rep").filter("copies > 1")
    # an id of several texts joins the nodes of all of them
    ids = signed.filter("n_shingles > 0 and doc_id is not null").groupBy("doc_id").agg(F.min("same").alias("s0"), F.max("same").alias("s1")).filter("s0 != s1").select("doc_id")
    several = signed.filter("n_shingles > 0").join(ids, "doc_id").select("doc_id", F.col("same").alias("s")).distinct().join(copies, "s").filter("doc_id != rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    found = components(links(written(members, "families"), docs, percent).union(several))

    labelled = signed.select("doc_id", "n_shingles", "same").join(copies, F.col("same") == F.col("s"), "left").withColumn("rep", F.coalesce("rep", "doc_id"))
    labelled = labelled.join(found, labelled.rep == found.id, "left").withColumn("component_id", F.coalesce("component", "rep"))
    return labelled.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP3_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(len(w) - 4), lambda i: array_to_string(w[i + 1:i + 5], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT doc_id, doc_id AS root FROM d UNION SELECT b, root FROM reached JOIN ways ON doc_id = a WHERE root < b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.root AS component_id, d.doc_id = r.root AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT doc_id, min(root) AS root FROM reached GROUP BY doc_id) r ON r.doc_id = d.doc_id
"""
