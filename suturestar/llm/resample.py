"""Importance resampling towards a target distribution, with exact ranks by regular sampling.

Features of a text are its runs of up to `longest` consecutive words, hashed into buckets.  A bucket's gain is the
rounded log ratio of its smoothed shares in the target and in the corpus; a document weighs the sum of its features'
gains and draws a Gumbel value from its id, so the highest scores are a weighted sample without replacement.

Array-scored weights: one pass over the texts writes each document's buckets as an array and counts them; scoring then is
one look-up of the array in the vector of gains.  Counts cover all documents and all target texts.

Ranks by regular sampling: each partition sorts its documents into a run.  Every k-th document of every run is a sample
(k grows with the corpus, so that at most 2 * SAMPLES are collected), regular samples give the splitters, and splitters cut
all runs into segments of about SEGMENT_ROWS.  Counts per segment, summed up in order, give each segment's first rank;
then segments that the draw reaches are exchanged and ordered where they arrive.  The order is (score, id, place in the runs),
which never ties, so rows that repeat spread over segments too.

Words are runs of 0-9, a-z and characters beyond ASCII, with A-Z lowered.  Null and empty texts have no features, weigh 0
and are not drawn (fewer than LEAST_WORDS words).  Texts of any length are read in pieces of PIECE bytes.  A row without an
id has no draw value: its score and rank are null, and it counts among neither the N nor the drawn; its features count in
the corpus.  Rows that repeat an id are ranked each.  Empty tables give an empty result or, as a target, gains against a
uniform one.  Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from suturestar.llm.frames import kept, read, sliced

BUCKETS = 10_000
LONGEST = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
SAMPLES = 1 << 17
SEGMENT_ROWS = 1 << 19
PIECE = 1 << 20
SLICE_BYTES = 8 << 20
KNOWN_WORDS = 200_000
KNOWN_LENGTH = 32
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
GAP = re.compile(rb"[^0-9a-z\x80-\xff]")
FEATURES = "id long, words long, buckets array<int>, counts array<long>"
SCORED = "id long, words long, features long, weight long"


class _Checksums(dict):
    """Checksums of words; frequent short ones are remembered."""

    def __missing__(self, word: bytes) -> int:
        value = zlib.crc32(word)
        if len(word) <= KNOWN_LENGTH and len(self) < KNOWN_WORDS:
            self[word] = value
        return value


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text cut between words."""
    at = 0
    while at < len(text):
        gap = GAP.search(text, at + PIECE)
        end = gap.start() if gap else len(text)
        yield text[at:end]
        at = end


def feature_buckets(text: bytes | None, buckets: int, longest: int, known: dict[bytes, int]) -> tuple[int, np.ndarray]:
    """The number of words of a text (UTF-8) and the buckets of all its features."""
    n, out, last = 0, [], []
    for piece in _pieces((text or b"").lower()):
        words = WORD.findall(piece)
        n += len(words)
        out.append(np.fromiter(map(known.__getitem__, words), np.uint32, len(words)))
        if longest > 1:
            # A run's checksum goes on from that of the run without its last word.
            line, fresh = last + words, len(last)
            sums = [known[w] for w in line]
            for size in range(2, longest + 1):
                sums = [zlib.crc32(b" " + w, s) for s, w in zip(sums, line[size - 1 :])]
                out.append(np.array(sums[max(0, fresh - size + 1) :], np.uint32))
            last = line[-(longest - 1) :]
    found = np.concatenate(out) if out else np.empty(0, np.uint32)
    return n, (found % np.uint32(buckets)).astype(np.int32)


def _featured(buckets: int, longest: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for every text, and one with the partition's count of every bucket."""
    known, total = _Checksums(), np.zeros(buckets, np.int64)
    names = ["id", "words", "buckets", "counts"]
    for batch in sliced(batches, SLICE_BYTES, "text"):
        words, found = [], []
        for text in batch.column("text").cast(pa.binary()).to_pylist():
            n, b = feature_buckets(text, buckets, longest, known)
            words.append(n)
            found.append(b)
        flat = np.concatenate(found)
        total += np.bincount(flat, minlength=buckets)
        ends = np.concatenate(([0], np.cumsum([len(b) for b in found]))).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(words, pa.int64()), lists, pa.nulls(len(words), pa.list_(pa.int64()))], names=names)
    row = [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.list_(pa.int32())), pa.array([total.tolist()], pa.list_(pa.int64()))]
    yield pa.RecordBatch.from_arrays(row, names=names)


def featured(texts: DataFrame, buckets: int, longest: int) -> DataFrame:
    """Columns id and text to FEATURES."""
    return kept(texts.mapInArrow(lambda it: _featured(buckets, longest, it), FEATURES), "features")


def bucket_counts(features: DataFrame, buckets: int) -> np.ndarray:
    rows = features.filter("counts IS NOT NULL").select(F.posexplode("counts").alias("bucket", "n")).groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r.bucket] = r.n
    return out


def gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed shares, rounded down."""
    k = len(corpus)
    all_target, all_corpus = float(int(target.sum()) + k), float(int(corpus.sum()) + k)
    return np.array([math.floor(1000 * math.log((t + 1.0) * all_corpus / ((s + 1.0) * all_target))) for t, s in zip(target.tolist(), corpus.tolist())], np.int64)


def _weighed(gain, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("buckets")
        ends = lists.offsets.to_numpy()
        values = lists.values.to_numpy(zero_copy_only=False)
        running = np.concatenate(([0], np.cumsum(gain.value[values])))
        columns = [batch.column("id"), batch.column("words"), pa.array(np.diff(ends).astype(np.int64)), pa.array(running[ends[1:]] - running[ends[:-1]])]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "words", "features", "weight"])


def weighed(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """`docs` (id, text) as SCORED: features and weight of every row against the texts of `target`."""
    features = featured(docs, buckets, longest)
    wanted = featured(target, buckets, longest)
    gain = docs.sparkSession.sparkContext.broadcast(gains(bucket_counts(wanted, buckets), bucket_counts(features, buckets)))
    rows = features.filter("buckets IS NOT NULL").select("id", "words", "buckets")
    return rows.mapInArrow(lambda it: _weighed(gain, it), SCORED)


def with_score(rows: DataFrame, seed: int = SEED) -> DataFrame:
    """Weight plus a Gumbel value in thousandths, which the id and the seed fix; null without an id."""
    start = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256), 1, 8)
    share = (F.conv(start, 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return rows.withColumn("score", F.col("weight") + F.floor(F.lit(-1000.0) * F.log(-F.log(share))))


def _cut(splitters, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in ("score", "id", "at")))
        segment = [bisect_right(splitters.value, (-score, id_, at)) for score, id_, at in keys]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(segment, pa.int32())], names=[*batch.schema.names, "segment"])


def drawn(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, segment_rows: int = SEGMENT_ROWS, samples: int = SAMPLES) -> DataFrame:
    """All rows with `rank` from 1 for the highest `percent` scores of the documents long enough, ties to smaller ids."""
    spark = scored.sparkSession
    can = F.col("score").isNotNull() & (F.col("words") >= least_words)
    keys = [F.desc("score"), F.asc("id")]
    scored = kept(scored, "scored")
    runs = kept(scored.filter(can).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id()), "sorted-runs")
    total = runs.count()
    wanted = percent * total // 100

    every = max(1, total // samples)
    regular = runs.filter((F.col("at") % (1 << 33)) % every == every // 2).select("score", "id", "at").collect()
    regular = sorted((-r.score, r.id, r.at) for r in regular)
    parts = max(1, min(-(-total // segment_rows), len(regular)))
    sent = spark.sparkContext.broadcast(sorted({regular[len(regular) * i // parts] for i in range(1, parts)}))
    cut = kept(runs.mapInArrow(lambda it: _cut(sent, it), f"{SCORED}, score long, at long, segment int"), "segments")

    sizes = {r.segment: r["count"] for r in cut.groupBy("segment").count().collect()}
    before, at = [], 0
    for segment in range(len(sent.value) + 1):
        before.append(at)
        at += sizes.get(segment, 0)
    reached = sum(b < wanted for b in before)
    place = F.expr("row_number() OVER (PARTITION BY segment ORDER BY score DESC, id, at)")
    first = F.expr(f"array({', '.join(f'{b}L' for b in before)})")[F.col("segment")]
    moved = cut.filter(F.col("segment") < reached).repartitionById(max(1, reached), F.col("segment")).withColumn("rank", (first + place).cast("long"))
    none = F.lit(None).cast("long").alias("rank")
    columns = ["id", "words", "features", "weight", "score"]
    ranked = moved.select(*columns, F.when(F.col("rank") <= wanted, F.col("rank")).alias("rank"))
    return ranked.unionByName(cut.filter(F.col("segment") >= reached).select(*columns, none)).unionByName(scored.filter(~can).select(*columns, none))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("id"), "text")
    target = read(spark, sf_dir, "benchmark").select(F.lit(None).cast("long").alias("id"), "text")
    out = drawn(with_score(weighed(docs, target)))
    return out.select(F.col("id").alias("doc_id"), F.col("features").alias("n_features"), "weight", "score", "rank")


# DuckDB has no crc32, so its table comes from the polynomial.
OP11_SQL = r"""
WITH crc AS (
  SELECT list(v ORDER BY b) AS entry
  FROM (SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(b))
), words AS (
  SELECT TRUE AS mine, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM documents
  UNION ALL
  SELECT FALSE, NULL, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark
), vocabulary AS (
  SELECT w, list_transform(range(1, 2 * octet_length(encode(w)), 2), lambda i: CAST('0x' || substr(hex(encode(w)), i, 2) AS BIGINT)) AS bytes FROM (SELECT DISTINCT w FROM words)
), hashed AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, x: xor(c >> 8, entry[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket FROM vocabulary, crc
), features AS (
  SELECT mine, doc_id, bucket FROM words JOIN hashed USING (w)
), totals AS (
  SELECT COUNT(*) FILTER (mine) AS all_s, COUNT(*) FILTER (NOT mine) AS all_t FROM features
), shares AS (
  SELECT bucket, COUNT(*) FILTER (mine) AS s, COUNT(*) FILTER (NOT mine) AS t FROM features GROUP BY bucket
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * CAST(all_s + 10000 AS DOUBLE) / (CAST(s + 1 AS DOUBLE) * CAST(all_t + 10000 AS DOUBLE)))) AS BIGINT) AS gain FROM shares, totals
), weights AS (
  SELECT doc_id, COUNT(*) AS n_features, CAST(SUM(gain) AS BIGINT) AS weight FROM features JOIN gains USING (bucket) WHERE mine GROUP BY doc_id
), scored AS (
  SELECT d.doc_id, COALESCE(n_features, 0) AS n_features, COALESCE(weight, 0) AS weight,
    COALESCE(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM documents d LEFT JOIN weights USING (doc_id)
), ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, COUNT(*) OVER () AS n FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, r AS rank FROM scored LEFT JOIN (SELECT * FROM ranked WHERE r <= 10 * n // 100) USING (doc_id)
"""
