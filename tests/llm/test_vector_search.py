import numpy as np
import pytest
from pyspark.sql import functions as F

from suturestar.llm import vector_search as vs


def _brute(rows, k, every):
    kept = [(i, np.floor(256 * np.array(v, float)).astype(np.int64)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, q in kept:
        if i % every == 0:
            scored = sorted((-int(q @ v), j) for j, v in kept if j != i and len(v) == len(q))[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    base = rng.normal(0, 0.3, (400, 12)).round(2)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[5][1]) for i in range(40)]  # ties
    rows += [(2000, None), (2005, []), (2010, [float("nan")] * 12), (2015, [None] + [0.1] * 11), (2020, [float("inf")] * 12), (None, [0.1] * 12)]
    rows += [(3000 + i, [float(x) for x in rng.normal(0, 0.3, 3)]) for i in range(20)]  # another length
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = vs.top_k(df, F.col("id") % 5 == 0, "vec_id", "embedding")
    assert sorted(map(tuple, got.collect())) == _brute(rows, 5, 5)


def test_few_vectors_and_none(spark):
    df = spark.createDataFrame([(0, [0.5, 0.5]), (1, [0.25, 0.5])], "vec_id long, embedding array<double>")
    got = vs.top_k(df, F.col("id") % 5 == 0, "vec_id", "embedding")
    assert [tuple(r) for r in got.collect()] == [(0, 1, 1, 128 * 64 + 128 * 128)]
    assert vs.top_k(df.limit(0), F.col("id") % 5 == 0, "vec_id", "embedding").count() == 0


def test_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(vs, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(0, 0.3, (120, 8)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, vs.top_k(df, F.col("id") % 3 == 0, "vec_id", "embedding").collect())) == _brute(rows, 5, 3)
