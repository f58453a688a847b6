"""Text quality by positive-unlabelled learning.

Trusted positives are labelled good; the web text around them is unlabelled.  A logistic model f minimises the
non-negative unbiased risk

    prior * E_positive[loss(f)] + max(0, E_unlabelled[loss(-f)] - prior * E_positive[loss(-f)])

where the prior, the share of good text, is estimated as the share of good ones among the labels of the training
folds (one added to either side).  Labels of bad text serve nothing else.  When the bracket turns negative on a step,
the step climbs out of it instead, which is what keeps the model from explaining unlabelled text as all bad.

Features come from the text alone: shares of letters, signs and repeats, and hashed byte pairs.  Training uses at
most `positives` labelled rows and about `unlabelled` documents, drawn by a hash of their ids; scoring covers all.

Null and empty texts get the score of an empty text.  Without a positive label every score is 0.5.  Labels that are
null, or whose document is missing, are ignored; a document with several labels counts as often.  Repeated rows are
scored alike.  Columns named like an output column are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from suturestar.llm.frames import read, sliced

POSITIVES = 6_000
UNLABELLED = 12_000
FOLDS = 5
STEPS = 500
RATE = 0.03
DECAY = 1e-4
KEEP = 0.3
SIGNS = b"!#$%&*|\"=.,;:-_/<>()[]{}@?'+"
PAIRS = 256
SLICE = 1 << 20
DENSE = 14 + len(SIGNS)
SIZE = DENSE + PAIRS


def features(text: str | None) -> np.ndarray:
    """What the model sees of a text."""
    out = np.zeros(SIZE, np.float32)
    raw = (text or "").encode("utf-8", "replace")
    words = (text or "").split()
    if not words:
        out[0] = 1
        return out
    data = np.frombuffer(raw, np.uint8)
    n, m = len(data), len(words)
    count = np.bincount(data, minlength=256)
    upper, lower, high = count[65:91].sum(), count[97:123].sum(), count[128:].sum()
    lines = text.split("\n")
    often = Counter(words)
    out[1:14] = (
        np.log1p(m) / 10,
        upper / (upper + lower + 1),
        count[48:58].sum() / n,
        high / n,
        count[10] / m,
        count[32] / n,
        n / m / 10,
        len(often) / m,
        np.log(len(often)) / np.log(m + 1),
        max(often.values()) / m,
        sum(map(eq, words, words[1:])) / m,
        1 - len(set(lines)) / len(lines),
        sum(w.isupper() for w in often) / len(often),
    )
    out[14:DENSE] = np.sqrt(count[list(SIGNS)] / m)
    if n > 1:
        code = (data[:-1].astype(np.uint16) << 8) | data[1:]
        pairs = np.bincount((code * np.uint16(40503)) >> 8, minlength=PAIRS)
        out[DENSE:] = pairs / np.linalg.norm(pairs)
    return out


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    bias: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = x - self.mean
        z /= self.scale
        z = z @ self.weight + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def nothing() -> Model:
    return Model(np.zeros(SIZE), np.ones(SIZE), np.zeros(SIZE), 0.0, 0.5)


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = STEPS) -> Model:
    """Minimise the non-negative risk by full-batch Adam."""
    if not len(positive) or not len(unlabelled):
        return nothing()
    both = np.concatenate((positive, unlabelled)).astype(np.float64)
    mean, scale = both.mean(0), both.std(0) + 1e-3
    p, u = (positive - mean) / scale, (unlabelled - mean) / scale
    # A column of ones carries the bias, which does not decay.
    p, u = (np.hstack((x, np.ones((len(x), 1)))) for x in (p, u))
    w = np.zeros(p.shape[1])
    w[-1] = np.log(prior / (1 - prior))
    decay = np.append(np.full(len(w) - 1, DECAY), 0)
    m1, m2 = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        zp, zu = np.clip(p @ w, -30, 30), np.clip(u @ w, -30, 30)
        sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
        as_bad = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        bad_slope = su @ u / len(u) - prior * (sp @ p) / len(p)
        good_slope = prior * ((sp - 1) @ p) / len(p)
        slope = (good_slope + bad_slope if as_bad >= 0 else -bad_slope) + decay * w
        m1, m2 = 0.9 * m1 + 0.1 * slope, 0.999 * m2 + 0.001 * slope**2
        w = w - RATE * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.999**t)) + 1e-8)
    return Model(mean, scale, w[:-1], float(w[-1]), prior)


def held_out(id_: Column) -> Column:
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def matrix(texts: pa.Array) -> np.ndarray:
    """The features of a batch's texts, of which about SLICE bytes are Python strings at a time."""
    x = np.empty((len(texts), SIZE), np.float32)
    at = 0
    for part in sliced([pa.RecordBatch.from_arrays([texts], names=["text"])], SLICE, "text"):
        for t in part.column("text").to_pylist():
            x[at] = features(t)
            at += 1
    return x


def _blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [row.tobytes() for row in matrix(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["x"])


def _collected(df: DataFrame) -> np.ndarray:
    """Features of a bounded sample, on the driver."""
    rows = df.mapInArrow(_blobs, "x binary").toArrow()["x"].to_pylist()
    return np.frombuffer(b"".join(rows), np.float32).reshape(len(rows), SIZE)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    positives: int = POSITIVES,
    unlabelled: int = UNLABELLED,
    id_: str = "doc_id",
    text: str = "text",
) -> Model:
    marks = labels.select(F.col("doc_id").alias("id"), "quality").filter("id IS NOT NULL AND quality IS NOT NULL")
    marks = marks.filter(~held_out(F.col("id")))
    seen = marks.agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good")).first()
    if not seen.good:
        return nothing()
    order = F.xxhash64("id", F.lit(1))
    trusted = marks.filter("quality = 1").select("id").orderBy(order, "id").limit(positives)
    texts = docs.select(F.col(id_).alias("id"), F.col(text).alias("text"))
    # `trusted` has at most `positives` ids, which bounds the broadcast.
    positive = texts.join(F.broadcast(trusted), "id").select("text")
    share = min(1.0, unlabelled / max(1, docs.count()))
    around = texts.filter(~held_out(F.col("id"))).filter(F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1 << 20)) < share * (1 << 20))
    return train(_collected(positive), _collected(around.select("text")), (seen.good + 1) / (seen.n + 2))


def scored(text: Column, model: Model) -> Column:
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(matrix(texts)))

    return score(text)


def op5_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, read(spark, sf_dir, "labels"))
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), scored(F.col("text"), model).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= KEEP).cast("int"))
