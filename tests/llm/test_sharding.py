import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from suturestar.llm import sharding


def _check(rows, shards=8):
    """Gapless slots; bytes as near as the largest row that could not be cut allows."""
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    assert set(by) <= set(range(shards))
    for part in by.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
    total, most = sum(r.size for r in rows), max(r.size for r in rows)
    for s in range(shards):
        assert abs(sum(r.size for r in by[s]) - total / shards) <= most + total / shards * sharding.TOLERANCE
    return by


@pytest.mark.parametrize(("n", "hot"), [(400, 0), (400, 150), (9, 0), (300, 299)])
def test_sizes_slots_and_groups(spark, n, hot):
    rng = random.Random(n + hot)
    rows = [(i, "hot text of some length" if i < hot else "x" * rng.randint(0, 50) + str(i % 97)) for i in range(n)]
    rng.shuffle(rows)
    out = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert len(out) == n and {r.doc_id: r.size for r in out} == {i: len(t) + 1 for i, t in rows}
    _check(out)


def test_small_groups_stay_whole(spark):
    rows = [(i, f"text {i % 12000} of a group") for i in range(24000)]
    out = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    where = defaultdict(set)
    for r in out:
        where[r.text].add(r.shard)
    assert all(len(s) == 1 for s in where.values())
    _check(out)


def test_query_on_the_driver_table(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = sharding.op9_histogram_shards(spark, sf_dir).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {i: (len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in texts.items()}
    _check(rows)


def test_odd_rows(spark, odd_documents):
    out = sharding.shard(odd_documents.withColumn("shard", F.lit("mine")).withColumn("slot", F.lit(1)))
    assert out.columns == [*odd_documents.columns, "size", "shard", "slot"]
    rows = out.collect()
    assert len(rows) == odd_documents.count() and {r.size for r in rows if r.text is None} == {1}
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert sharding.shard(odd_documents.limit(0)).count() == 0


def test_one_exchange_and_no_python(spark, sf_dir):
    plan = sharding.op9_histogram_shards(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\bExchange\b", plan)) == 1 and not re.search("Python|Pandas|Arrow", plan)
