import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from suturestar.llm import quality as q
from suturestar.llm.frames import read


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    scored = q.op5_pu_quality(spark, sf_dir).join(labels, "doc_id").filter("held_out AND quality IS NOT NULL").toPandas()
    good, bad = scored[scored.quality == 1].score.to_numpy(), scored[scored.quality == 0].score.to_numpy()
    assert len(bad) > 3 and (good[:, None] > bad[None, :]).mean() > 0.95
    assert (scored.predicted == scored.quality).mean() > 0.93
    assert scored.score.between(0, 1).all() and docs.count() == 1000


def test_labels_of_held_out_rows_change_nothing(spark, sf_dir):
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    flipped = labels.withColumn("quality", F.when(q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = q.fit(docs, labels), q.fit(docs, flipped)
    assert np.array_equal(a.weight, b.weight) and a.prior == b.prior


def test_the_risk_separates_without_negative_labels():
    rng = np.random.default_rng(0)
    shift = np.zeros(q.SIZE)
    shift[:5] = 4
    positive = rng.normal(0, 1, (4000, q.SIZE))
    unlabelled = np.concatenate((rng.normal(0, 1, (7000, q.SIZE)), rng.normal(0, 1, (3000, q.SIZE)) + shift))
    m = q.train(positive, unlabelled, 0.7)
    assert m.score(rng.normal(0, 1, (500, q.SIZE))).mean() > 0.8
    assert m.score(rng.normal(0, 1, (500, q.SIZE)) + shift).mean() < 0.25


def test_odd_rows(spark, odd_documents):
    labels = spark.createDataFrame([(1, 1), (2, None), (3, 1), (None, 1), (77, 1), (4, 0), (5, 1), (8, 1)], "doc_id long, quality int")
    model = q.fit(odd_documents, labels)
    rows = odd_documents.select("doc_id", q.scored(F.col("text"), model).alias("s")).collect()
    assert len(rows) == odd_documents.count() and all(0 <= r.s <= 1 for r in rows)
    nothing = q.fit(odd_documents, labels.limit(0))
    assert {r.s for r in odd_documents.select(q.scored(F.col("text"), nothing).alias("s")).collect()} == {0.5}
    assert odd_documents.limit(0).select(q.scored(F.col("text"), model)).count() == 0


def test_a_batch_is_scored_in_slices():
    """A batch's texts are never all Python strings at once, and slices change no feature."""
    texts = [None, "", *[f"Word {i} " * 2_000 for i in range(600)], "end"]
    batch = pa.array(texts, pa.string())
    tracemalloc.start()
    x = q.matrix(batch)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert batch.nbytes > 10 << 20 and peak < x.nbytes + (8 << 20)
    assert x.tobytes() == np.array([q.features(t) for t in texts], np.float32).tobytes()
