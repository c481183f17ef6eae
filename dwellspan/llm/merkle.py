"""A Merkle manifest of a dataset: a hash tree for each group of rows, a tree over their roots, and a proof for each row.

Rows get an index within their group by a range partitioning and the counts of its parts. Blocks of up to 4,096
neighbouring hashes are hashed some levels up at once, so a table of N rows costs a shuffle for each twelve levels. All nodes stand in one
table, by group, level and position. For a proof each row explodes the coordinates of the siblings on its way up, which
follow from its index and the group's size alone; these are joined with the table of nodes, ordered and folded.
A node near the root is a sibling of half of all rows: coordinates above a block are therefore looked up once for each block, then once
for each block of blocks, and handed down, so that a node is asked for by 4,096 rows of a turn at most whatever the size of a group.

A null value is hashed as ``-``, so it differs from every text. Rows ascend by key within a group, null first, equal keys by leaf; rows equal
in all hashed columns have one leaf and stand one behind the other. A null group is a group of its own, before all others.
Texts of any length are hashed whole. An empty table gives an empty result. Columns that are not named are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

ARITY = 2
#: Most hashes of a block.
BLOCK = 4096
#: Levels of the deepest tree there can be.
MOST_LEVELS = 63


def node_hash(*parts: Column) -> Column:
    """H: lowercase hex SHA-256 of what parts give one behind the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value with its length in bytes before it, or ``-`` for null; no two rows give one sequence of fields."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    return node_hash(*map(field, values))


def group_key(group: Column) -> Column:
    """A group as a string that is never null and sorts as groups do: null first, then bytewise."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def _block_levels(arity: int) -> int:
    levels = 1
    while arity ** (levels + 1) <= BLOCK:
        levels += 1
    return levels


def _powers(arity: int) -> list[int]:
    return [arity**n for n in range(MOST_LEVELS) if arity**n < 2**62]


def _longs(values: Sequence[int]) -> str:
    return "array(" + ",".join(f"{v}L" for v in values) + ")"


def _levels(size: str, arity: int) -> str:
    """SQL: levels above the leaves of a tree of so many leaves."""
    return f"size(filter({_longs(_powers(arity))}, p -> p < {size}))"


def indexed(leaves: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows of grp and other columns with their index within grp, in this order, and its size; no group meets in one task."""
    dealt = leaves.withColumn("salt", F.monotonically_increasing_id())  # parts a hot run of equal rows
    keys = ["grp", *order, "salt"]
    sorted_ = written(dealt, "leaves").repartitionByRange(*keys).sortWithinPartitions(*keys).drop("salt")
    held = written(sorted_.withColumn("at", F.monotonically_increasing_id()), "indexed").withColumn("part", F.shiftright("at", 33))
    before = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = held.groupBy("grp", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    parts = parts.select("grp", "part", F.expr("first").alias("first"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("n").over(Window.partitionBy("grp")).alias("size"))
    return held.join(parts, ["grp", "part"]).withColumn("index", F.expr("at - first + before")).drop("at", "part", "first", "before")


def _rounds(found: DataFrame, arity: int) -> int:
    levels = found.agg(F.expr(_levels("max(size)", arity)).alias("n")).first().n or 0
    return max(1, -(-levels // _block_levels(arity)))


def nodes(leaves: DataFrame, arity: int = ARITY) -> tuple[list[DataFrame], int]:
    """All nodes, leaves included: tables of grp, size, level, position and hash (32 bytes), one for each turn of blocks, and the turns."""
    step, rounds, out = _block_levels(arity), _rounds(leaves, arity), []
    row = leaves.select("grp", "size", F.lit(0).alias("level"), F.col("index").alias("position"), F.unhex("leaf").alias("hash"))
    for turn in range(rounds):
        low = turn * step
        if turn:
            row = out[-1].where(F.col("level") == low)
        blocks = row.groupBy("grp", F.expr(f"position div {arity**step}").alias("block")).agg(
            F.max("size").alias("size"), F.transform(F.array_sort(F.collect_list(F.struct("position", "hash"))), lambda x: F.lower(F.hex(x.hash))).alias("base")
        )
        up = f"transform(sequence(0, (size(element_at(acc, -1)) - 1) div {arity}), j -> sha2(array_join(slice(element_at(acc, -1), j * {arity} + 1, {arity}), ''), 256))"
        steps = f"slice(array({','.join(map(str, range(step)))}), 1, greatest({_levels('size', arity)} - {low}, 0))"
        tree = F.expr(f"aggregate({steps}, array(base), (acc, n) -> concat(acc, array({up})))")
        laid = blocks.select("grp", "block", "size", F.posexplode(tree).alias("n", "hashes")).select("grp", "block", "size", "n", F.posexplode("hashes").alias("inside", "hash"))
        if turn:
            laid = laid.where("n > 0")  # the turn before has them
        width = f"element_at({_longs([arity ** (step - n) for n in range(step + 1)])}, n + 1)"
        out.append(written(laid.select("grp", "size", (F.col("n") + low).alias("level"), F.expr(f"block * {width} + inside").alias("position"), F.unhex("hash").alias("hash")), "nodes"))
    return out, rounds


def roots(trees: list[DataFrame], arity: int = ARITY) -> DataFrame:
    """grp and the hex root of its tree."""
    return _all(trees).where(F.expr(f"level = {_levels('size', arity)}")).select("grp", F.lower(F.hex("hash")).alias("root"))


def _all(trees: list[DataFrame]) -> DataFrame:
    out = trees[0]
    for one in trees[1:]:
        out = out.unionByName(one)
    return out


def coordinates(rows: DataFrame, low: int, arity: int) -> DataFrame:
    """For rows of grp, size and index, which are nodes of level low: level and position of each sibling on the way up through one block."""
    step, powers = _block_levels(arity), _longs(_powers(arity))
    levels = f"slice(array({','.join(str(low + n) for n in range(step))}), 1, greatest({_levels('size', arity)} - {low}, 0))"
    own = f"(index div element_at({powers}, level - {low} + 1))"
    most = f"((size - 1) div element_at({powers}, level + 1))"
    run = f"({own} div {arity} * {arity})"
    up = rows.select("grp", "size", "index", F.explode(F.expr(levels)).alias("level"))
    wanted = up.select("grp", "index", "level", F.expr(own).alias("own"), F.explode(F.expr(f"sequence({run}, least({run} + {arity - 1}, {most}))")).alias("position"))
    return wanted.where("position != own").drop("own")


def _looked_up(rows: DataFrame, trees: list[DataFrame], turn: int, arity: int) -> DataFrame:
    """grp, index and siblings within the block of each row that has any."""
    step = _block_levels(arity)
    wanted = coordinates(rows, turn * step, arity)
    known = trees[turn].select("grp", "level", "position", "hash")
    if turn:
        known = known.unionByName(trees[turn - 1].where(F.col("level") == turn * step).select("grp", "level", "position", "hash"))
    found = wanted.join(known, ["grp", "level", "position"])
    return found.groupBy("grp", "index").agg(F.array_sort(F.collect_list(F.struct("level", "position", "hash"))).alias("siblings"))


NO_SIBLINGS = "cast(array() as array<struct<level: int, position: bigint, hash: binary>>)"


def block_proofs(leaves: DataFrame, trees: list[DataFrame], arity: int = ARITY) -> DataFrame:
    """grp and block of leaves (index div block size) with the siblings above the block, by level; a row for each block."""
    step = _block_levels(arity)
    width = arity**step
    above = None
    for turn in reversed(range(1, len(trees) + 1)):
        own = leaves.select("grp", "size", F.expr(f"index div {width}").alias("index")).distinct() if turn == 1 else trees[turn - 1].where(F.col("level") == turn * step).select("grp", "size", F.col("position").alias("index"))
        siblings = F.expr(NO_SIBLINGS)
        if turn < len(trees):
            own = own.join(_looked_up(own, trees, turn, arity), ["grp", "index"], "left")
            siblings = F.coalesce("siblings", siblings)
        if above is not None:
            own = own.withColumn("block", F.expr(f"index div {width}")).join(above, ["grp", "block"], "left")
            siblings = F.concat(siblings, F.coalesce("above", F.expr(NO_SIBLINGS)))
        above = written(own.select("grp", F.col("index").alias("block"), siblings.alias("above")), "above")
    return above


def fold(leaf: Column, index: Column, size: Column, siblings: Column, arity: int = ARITY) -> Column:
    """The root that a hex leaf of this index and its siblings (level, position, hash) give in a tree of this size."""
    powers = F.expr(_longs(_powers(arity)))
    levels = F.slice(F.expr("array(" + ",".join(map(str, range(len(_powers(arity))))) + ")"), F.lit(1), F.size(F.filter(powers, lambda p: p < size)))

    def up(acc: Column, level: Column) -> Column:
        own = F.call_function("div", index, F.element_at(powers, level + 1))

        def side(keep) -> Column:
            return F.array_join(F.transform(F.filter(siblings, lambda s: (s.level == level) & keep(s.position, own)), lambda s: F.lower(F.hex(s.hash))), "")

        return node_hash(side(lambda a, b: a < b), acc, side(lambda a, b: a > b))

    return F.aggregate(levels, leaf, up)


def manifest(leaves: DataFrame, order: Sequence[str], keep: Sequence[str] = (), arity: int = ARITY) -> DataFrame:
    """Trees of rows of grp (``group_key``), leaf (hex), what orders them and columns to keep.

    Returns the columns to keep, grp, leaf, index and size of its group, siblings, subroot; group_index, groups and
    group_siblings, the same one level above; and root. ``fold`` of these gives subroot and root.
    """
    width = arity ** _block_levels(arity)
    rows = indexed(leaves.select("grp", "leaf", *dict.fromkeys([*order, *keep])), [*order, "leaf"])
    trees, _ = nodes(rows, arity)
    # the tree of trees
    subroots = written(roots(trees, arity), "subroots")
    groups = indexed(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), F.col("root").alias("leaf")), ["name"])
    tops, _ = nodes(groups, arity)
    top_paths = groups.join(_looked_up(groups, tops, 0, arity), ["grp", "index"], "left").withColumn("block", F.expr(f"index div {width}")).join(block_proofs(groups, tops, arity), ["grp", "block"], "left")
    whole = top_paths.join(roots(tops, arity), "grp").select(
        F.col("name").alias("grp"), F.col("leaf").alias("subroot"), F.col("index").alias("group_index"), F.col("size").alias("groups"),
        F.concat(F.coalesce("siblings", F.expr(NO_SIBLINGS)), F.coalesce("above", F.expr(NO_SIBLINGS))).alias("group_siblings"), "root",
    )
    blocks = block_proofs(rows, trees, arity).join(whole, "grp")
    found = rows.join(_looked_up(rows, trees, 0, arity), ["grp", "index"], "left").withColumn("block", F.expr(f"index div {width}")).join(blocks, ["grp", "block"])
    return found.select(
        *dict.fromkeys(keep), "grp", "leaf", "index", "size",
        F.concat(F.coalesce("siblings", F.expr(NO_SIBLINGS)), "above").alias("siblings"), "subroot", "group_index", "groups", "group_siblings", "root",
    )


def proof_hash(siblings: Column, group_siblings: Column) -> Column:
    """H of all siblings of a row, up to the root."""
    return F.sha2(F.array_join(F.transform(F.concat(siblings, group_siblings), lambda s: F.lower(F.hex(s.hash))), "").cast("binary"), 256)


def folded_root(leaf: Column, arity: int = ARITY) -> Column:
    """The root that a leaf gives by the columns of ``manifest``."""
    subroot = fold(leaf, F.col("index"), F.col("size"), F.col("siblings"), arity)
    return fold(subroot, F.col("group_index"), F.col("groups"), F.col("group_siblings"), arity)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    doc_id, n_chars = F.col("doc_id"), F.col("n_chars")
    tampered = F.when(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 0, n_chars.cast("decimal(20,0)") + 1).otherwise(n_chars.cast("decimal(20,0)"))
    leaves = docs.select(
        group_key(F.col("lang")).alias("grp"), "doc_id", leaf_hash(doc_id, F.col("source"), F.col("lang"), n_chars, F.col("text")).alias("leaf"),
        leaf_hash(doc_id, F.col("source"), F.col("lang"), tampered, F.col("text")).alias("told"),
    )
    found = manifest(leaves, ["doc_id"], ["doc_id", "told"])
    folded = found.select("doc_id", "leaf", "subroot", "root", proof_hash(F.col("siblings"), F.col("group_siblings")).alias("proof_sha256"), folded_root(F.col("told")).alias("folded_root"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def _field_sql(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR)::VARCHAR || ':' || ({value})::VARCHAR, '-')"


def _leaf_sql(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_field_sql, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


#: CRC-32 of the decimal doc_id, bit by bit.
_CRC_SQL = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
  lambda ch: list_transform([0, 1, 2, 3, 4, 5, 6, 7], lambda k: ((ascii(ch) >> k) & 1)::BIGINT)))), lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295)"""

OP12_SQL = f"""
WITH RECURSIVE hashed AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || lang, '') AS grp, {_leaf_sql("n_chars")} AS leaf,
    CASE WHEN {_CRC_SQL} % 7 = 0 THEN {_leaf_sql("n_chars::HUGEINT + 1")} ELSE {_leaf_sql("n_chars")} END AS told
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY grp) AS n FROM hashed),
nodes AS (
  SELECT grp, 0 AS level, idx AS pos, leaf AS hash, n FROM leaves
  UNION ALL
  SELECT grp, level + 1, pos // 2, sha256(string_agg(hash, '' ORDER BY pos)), (any_value(n) + 1) // 2 FROM nodes WHERE n > 1 GROUP BY grp, level, pos // 2),
subroots AS (SELECT grp, hash AS subroot, row_number() OVER (ORDER BY grp) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, idx AS pos, subroot AS hash, n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(hash, '' ORDER BY pos)), (any_value(n) + 1) // 2 FROM tops WHERE n > 1 GROUP BY level, pos // 2),
below AS (
  SELECT l.rid, v.level AS step, (l.idx >> v.level) % 2 = 0 AS is_left, s.hash
  FROM leaves l JOIN (SELECT DISTINCT grp, level FROM nodes WHERE n > 1) v ON v.grp = l.grp
  LEFT JOIN nodes s ON s.grp = l.grp AND s.level = v.level AND s.pos = xor(l.idx >> v.level, 1)),
above AS (
  SELECT l.rid, 100 + v.level AS step, (g.idx >> v.level) % 2 = 0 AS is_left, s.hash
  FROM leaves l JOIN subroots g ON g.grp = l.grp CROSS JOIN (SELECT DISTINCT level FROM tops WHERE n > 1) v
  LEFT JOIN tops s ON s.level = v.level AND s.pos = xor(g.idx >> v.level, 1)),
steps AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY step) AS k FROM (FROM below UNION ALL FROM above)),
proofs AS (SELECT rid, sha256(coalesce(string_agg(hash, '' ORDER BY k), '')) AS proof_sha256, max(k) AS last FROM steps GROUP BY rid),
folds AS (
  SELECT rid, 0 AS k, told AS acc FROM leaves
  UNION ALL
  SELECT f.rid, f.k + 1, sha256(CASE WHEN s.is_left THEN f.acc || coalesce(s.hash, '') ELSE s.hash || f.acc END) FROM folds f JOIN steps s ON s.rid = f.rid AND s.k = f.k + 1)
SELECT l.doc_id, l.leaf, g.subroot, r.hash AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256, f.acc AS folded_root, f.acc = r.hash AS verified
FROM leaves l JOIN subroots g ON g.grp = l.grp CROSS JOIN (SELECT hash FROM tops WHERE n = 1) r
LEFT JOIN proofs p ON p.rid = l.rid JOIN folds f ON f.rid = l.rid AND f.k = coalesce(p.last, 0)
"""
