import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from suturestar.llm import merkle as m


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def _proofs(digests, arity):
    """The top of a list of digests, and for each the siblings of every level as (before, behind)."""
    paths, at, level = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(level) > 1:
        for k, i in enumerate(at):
            first = i - i % arity
            paths[k].append((level[first:i], level[i + 1 : first + arity]))
            at[k] = i // arity
        level = [_h(*level[i : i + arity]) for i in range(0, len(level), arity)]
    return (level[0] if level else None), paths


def _brute(rows, arity=8):
    """rows (doc_id, source, lang, n_chars, text) to the expected query result."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    leaf = {r: _h(*map(_field, r)) for r in rows}
    own = {x: sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is not None, r[0] or 0, leaf[r])) for x in langs}
    trees = {x: _proofs([leaf[r] for r in own[x]], arity) for x in langs}
    root, above = _proofs([trees[x][0] for x in langs], arity)
    out = []
    for x, up in zip(langs, above):
        for r, path in zip(own[x], trees[x][1]):
            path = path + up
            low = r[4] and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[4])
            touched = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            top = _h(*map(_field, (*r[:4], low if r[4] is not None else None))) if touched else leaf[r]
            for before, behind in path:
                top = _h(*before, top, *behind)
            proof = _h(*[h for before, behind in path for h in before + behind])
            out.append((r[0], leaf[r], trees[x][0], root, proof, top, top == root))
    return sorted(out, key=repr)


def _query(spark, rows, tmp_path):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    df.withColumn("leaf", F.lit(1)).withColumn("path", F.lit("x")).write.parquet(f"{tmp_path}/documents.parquet")
    got = m.op12_merkle_manifest(spark, str(tmp_path))
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in got.select(columns).collect()), key=repr)


def test_equals_plain_trees_with_odd_rows(spark, tmp_path):
    rng, rows = random.Random(3), []
    for i in rng.sample(range(5000), 150):
        rows.append((i, rng.choice(["s", None]), rng.choice(["en", "en", "en", "de", "é"]), rng.choice([5, None]), rng.choice(["Ab Ä", "", None, "lower", f"T{i}"])))
    rows += [(7001, "s", None, 1, "A"), (7001, "t", None, 1, "B"), (7001, "t", None, 1, "B"), (None, "s", "en", 2, "Z"), (7002, "s", "alone", 3, "X" * 3_000_000), (7003, "-", "", None, "é中")]
    assert _query(spark, rows, tmp_path) == _brute(rows)


@pytest.mark.parametrize("n", [0, 1, 8, 9, 65])
def test_sizes_around_full_runs(spark, tmp_path, n):
    rows = [(i, "s", "en", 1, f"Text {i}") for i in range(n)]
    assert _query(spark, rows, tmp_path) == _brute(rows)


@pytest.mark.parametrize("arity", [2, 3])
def test_other_arities(spark, arity):
    """Binary runs find their siblings by XOR."""
    df = spark.range(21).select(F.lit("=x").alias("g"), F.col("id"), m.digest(F.col("id").cast("string")).alias("leaf"))
    top, paths = _proofs([_h(str(i)) for i in range(21)], arity)
    for r in m.manifest(df, arity).select("id", F.hex("root").alias("root"), m.siblings(F.col("path")).alias("s"), F.hex(m.folded(F.col("leaf"), F.col("path"))).alias("f")).collect():
        assert r.root.lower() == top == r.f.lower()
        assert r.s == "".join(h for before, behind in paths[r.id] for h in before + behind)


def test_a_level_meets_its_run_by_equality(spark):
    nodes = spark.range(20).select(F.lit("g").alias("g"), F.col("id").alias("i"), F.lit(20).alias("n"), m.digest(F.col("id").cast("string")).alias("h"))
    plan = m._runs(nodes, 8)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Window" not in plan
    assert {(r.i, r.slot) for r in m._runs(nodes, 8).collect()} == {(i, i % 8) for i in range(20)}
