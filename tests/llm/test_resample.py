import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from suturestar.llm import resample as rs

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _features(text, longest=1):
    w = re.findall("[0-9a-z\x80-\U0010ffff]+", (text or "").translate(LOW))
    return len(w), [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def _brute(docs, target, buckets=10000, longest=1, percent=10):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s, t = (Counter(bucket(f) for x in texts for f in _features(x, longest)[1]) for texts in ([x for _, x in docs], target))
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets)))) for b in range(buckets)]
    rows = []
    for i, text in docs:
        n, f = _features(text, longest)
        weight = sum(gain[bucket(x)] for x in f)
        h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
        score = None if i is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, n, len(f), weight, score, None])
    fit = sorted((r for r in rows if r[1] >= 20 and r[0] is not None), key=lambda r: (-r[4], r[0]))
    for rank, r in enumerate(fit[: percent * len(fit) // 100], 1):
        r[5] = rank
    return sorted((tuple(r) for r in rows), key=repr)


def _run(spark, docs, target, percent=10, **how):
    columns = "id long, text string"
    df, wanted = spark.createDataFrame(docs, columns), spark.createDataFrame([(None, x) for x in target], columns)
    keys = {k: how.pop(k) for k in ("segment_rows", "samples") if k in how}
    out = rs.drawn(rs.with_score(rs.weighed(df.repartition(5), wanted, **how)), percent, **keys)
    return sorted((tuple(r) for r in out.select("id", "words", "features", "weight", "score", "rank").collect()), key=repr)


def _corpus(rng, n):
    words = [f"w{i}" for i in range(300)] + ["é", "中文", "Zed", "x-y", "a_b"]
    docs = [(i, " ".join(rng.choices(words, k=rng.choice([0, 3, 19, 20, 21, 60])))) for i in range(n)]
    return docs + [(9001, None), (9002, ""), (None, "word " * 30)], [" ".join(rng.choices(words[:40], k=30)) for _ in range(10)] + [None, ""]


@pytest.mark.parametrize(("segment_rows", "samples"), [(1 << 19, 1 << 17), (7, 40), (1, 10_000)])
def test_equals_plain_ranking(spark, segment_rows, samples):
    docs, target = _corpus(random.Random(4), 250)
    assert _run(spark, docs, target, segment_rows=segment_rows, samples=samples) == _brute(docs, target)


def test_longer_features_and_all_drawn(spark):
    docs, target = _corpus(random.Random(5), 60)
    assert _run(spark, docs, target, 100, longest=3, buckets=997, segment_rows=9) == _brute(docs, target, 997, 3, 100)


def test_pieces_of_a_long_text(monkeypatch):
    monkeypatch.setattr(rs, "PIECE", 13)
    rng = random.Random(6)
    for _ in range(50):
        text = " ".join(rng.choices(["alpha", "Béta", "c", "d,e", "x" * 40], k=rng.randint(0, 60)))
        for longest in (1, 2, 4):
            n, got = rs.feature_buckets(text.encode(), 5000, longest, rs._Checksums())
            words, want = _features(text, longest)
            assert n == words and Counter(got.tolist()) == Counter(zlib.crc32(f.encode()) % 5000 for f in want)


def test_repeated_rows_spread_over_segments(spark):
    """One row that makes up half of all rows is ranked row by row, in several segments."""
    docs = [(5, "same " * 25)] * 200 + [(i, f"word{i} " * 25) for i in range(100, 300)]
    got = _run(spark, docs, ["same"], 50, segment_rows=20, samples=2000)
    assert sorted(r[5] for r in got if r[5]) == list(range(1, 201))
    scores = {r[5]: r[4] for r in got if r[5]}
    assert [scores[i] for i in range(1, 201)] == sorted(scores.values(), reverse=True)


def test_odd_rows(spark, odd_documents):
    odd = odd_documents.select(F.col("doc_id").alias("id"), "text", F.lit(1).alias("words"), F.lit(2).alias("rank"))
    out = rs.drawn(rs.with_score(rs.weighed(odd, odd.limit(0))))
    assert out.count() == 9 and out.filter("rank IS NOT NULL").count() == 0
    assert rs.drawn(rs.with_score(rs.weighed(odd.limit(0), odd))).count() == 0


def test_only_reached_segments_are_exchanged(spark):
    docs, target = _corpus(random.Random(7), 200)
    columns = "id long, text string"
    out = rs.drawn(rs.with_score(rs.weighed(spark.createDataFrame(docs, columns), spark.createDataFrame([(None, x) for x in target], columns))), segment_rows=5)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
