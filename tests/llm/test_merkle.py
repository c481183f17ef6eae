import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from dwellspan.llm import merkle
from dwellspan.llm.merkle import OP12_SQL, coordinates, field, fold, folded_root, group_key, indexed, leaf_hash, manifest, nodes, op12_merkle_manifest, proof_hash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def _levels(leaves, arity):
    out = [leaves]
    while len(out[-1]) > 1:
        below = out[-1]
        out.append([_h(*below[k : k + arity]) for k in range(0, len(below), arity)])
    return out


def _siblings(levels, at, arity):
    out = []
    for below in levels[:-1]:
        run = at // arity * arity
        out += [h for k, h in enumerate(below[run : run + arity], run) if k != at]
        at //= arity
    return out


def _folded(leaf, levels, at, arity):
    for below in levels[:-1]:
        run = at // arity * arity
        leaf = _h(*below[run:at], leaf, *below[at + 1 : run + arity])
        at //= arity
    return leaf


def _leaf(row, more=0):
    n = row["n_chars"]
    values = (row["doc_id"], row["source"], row["lang"], None if n is None else n + more, row["text"])
    return _h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def _expected(rows, arity=2):
    """Plain Python over all rows."""
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, _leaf(r)))
    trees = {g: _levels([_leaf(r) for r in groups[g]], arity) for g in order}
    top = _levels([trees[g][-1][0] for g in order], arity)
    out = []
    for k, g in enumerate(order):
        for at, r in enumerate(groups[g]):
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            root = _folded(_folded(_leaf(r, int(hit)), trees[g], at, arity), top, k, arity)
            proof = _h(*_siblings(trees[g], at, arity), *_siblings(top, k, arity))
            out.append((r["doc_id"], _leaf(r), trees[g][-1][0], top[-1][0], proof, root, root == top[-1][0]))
    return sorted(out, key=str)


def _query(spark, rows, tmp_path):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    return sorted((tuple(r) for r in op12_merkle_manifest(spark, str(tmp_path)).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


@pytest.mark.parametrize("sizes", [[], [1], [2], [3], [1, 1], [7, 1, 16], [33, 5, 1, 1, 2], [200]])
@pytest.mark.parametrize("block", [4, 4096])
def test_any_shape_of_tree(spark, tmp_path, monkeypatch, sizes, block):
    monkeypatch.setattr(merkle, "BLOCK", block)
    langs = [None, "", "en", "é", "z"]
    rows = [{"doc_id": 1000 * g + i, "text": f"t{i}é", "lang": langs[g], "source": "s" if i % 3 else None, "n_chars": i if i % 4 else None} for g, n in enumerate(sizes) for i in range(n)]
    assert _query(spark, rows, tmp_path) == _expected(rows)


def test_nulls_repeats_and_long_texts(spark, tmp_path):
    row = {"doc_id": 5, "text": "same", "lang": "en", "source": "a", "n_chars": 4}
    rows = [row] * 9 + [{**row, "doc_id": None}, {**row, "doc_id": None, "text": None}, {**row, "text": "-"}, {**row, "text": None}, {**row, "text": ""}, {**row, "text": "x" * 10**6}, {**row, "doc_id": -3, "n_chars": 2**63 - 1}, dict.fromkeys(row)]
    rows += [{**row, "doc_id": 7, "text": chr(97 + k)} for k in range(6)]  # one id, many texts
    assert _query(spark, rows, tmp_path) == _expected(rows)


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_other_arities_give_each_leaf_its_root(spark, monkeypatch, arity):
    monkeypatch.setattr(merkle, "BLOCK", 9)
    df = spark.range(120).select(F.col("id").alias("k"), group_key(F.col("id") % 4).alias("grp"), F.lit(1).alias("block"), F.lit("").alias("siblings")).withColumn("leaf", leaf_hash(F.col("k")))
    found = manifest(df, ["k"], ["k"], arity).select("k", "grp", "leaf", "root", proof_hash(F.col("siblings"), F.col("group_siblings")).alias("proof"), folded_root(F.col("leaf"), arity).alias("folded"), folded_root(leaf_hash(F.lit("no")), arity).alias("forged")).collect()
    trees = [_levels([_h(f"{len(str(k))}:{k}") for k in range(g, 120, 4)], arity) for g in range(4)]
    top = _levels([t[-1][0] for t in trees], arity)
    assert len(found) == 120 and all(r.folded == r.root == top[-1][0] != r.forged for r in found)
    for r in found:
        assert r.proof == _h(*_siblings(trees[r.k % 4], r.k // 4, arity), *_siblings(top, r.k % 4, arity))


def test_hot_group_and_hot_rows_are_indexed_over_many_tasks(spark):
    df = spark.range(4000).select(F.lit("=en").alias("grp"), F.lit(7).alias("k"), leaf_hash(F.lit(1)).alias("leaf"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else a table this small becomes one task
    try:
        held = indexed(df, ["k", "leaf"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r["index"] for r in held.collect()) == list(range(4000)) and held.first()["size"] == 4000
    files = {p.rsplit("/", 1)[1]: n for p, n in df.sparkSession.read.parquet(*{f.rsplit("/", 1)[0] for f in held.inputFiles()}).groupBy(F.input_file_name()).count().collect()}
    assert len(files) > 2 and max(files.values()) < 2400


def test_no_node_is_asked_for_by_more_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK", 16)
    rows = indexed(spark.range(1000).select(F.lit("").alias("grp"), F.col("id").alias("k"), leaf_hash(F.col("id")).alias("leaf")), ["k"])
    wanted = coordinates(rows, 0, 2)
    assert wanted.groupBy("level", "position").count().agg(F.max("count")).first()[0] <= 8
    trees, turns = nodes(rows)
    assert turns == 3 and sum(t.count() for t in trees) == sum(len(x) for x in _levels(["0"] * 1000, 2))


def test_field_parts_and_fold_of_one(spark):
    row = spark.range(1).select(field(F.lit("é")), field(F.lit(None).cast("string")), field(F.lit(-12)), fold(F.lit("ab"), F.lit(0), F.lit(1), F.expr(merkle.NO_SIBLINGS))).first()
    assert tuple(row) == ("2:é", "-", "3:-12", "ab")


def test_op12_equals_sql_and_brute_force(spark, sf_dir, same):
    same(op12_merkle_manifest, OP12_SQL)
    docs = [r.asDict() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = op12_merkle_manifest(spark, sf_dir)
    assert dict(got.dtypes) == {"doc_id": "bigint", "leaf": "string", "subroot": "string", "root": "string", "proof_sha256": "string", "folded_root": "string", "verified": "boolean"}
    assert sorted((tuple(r) for r in got.collect()), key=str) == _expected(docs)
