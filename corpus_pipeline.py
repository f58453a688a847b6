"""From raw documents to token ids: quality, near duplicates, benchmark leaks, personal data, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and reread as the next
one's input.  All but the last return the columns of documents.  Every stage's decisions take effect on all rows:

* quality: documents scored below 0.3 go.  The classifier learns from the labels of sf_dir.
* near_duplicates: of documents that shared word shingles connect, the one with the smallest id stays.  Rows that
  repeat an id are documents of their own: unlinked ones all stay, of linked ones the set of shingles with the
  smallest key, and of rows with equal sets the one with the smallest text.  Rows without an id are no duplicates, rows
  without words only of rows with the same id and text.
* decontamination: documents that hold a benchmark item go.
* personal_data: spans are replaced by their kind in brackets.
* encoding: adds token ids (`ids`), their number (`n_tokens`) and the text they decode to (`decoded`); input columns of
  these names are replaced.  A null text has no ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from suturestar.llm import pii
from suturestar.llm.bpe import encoded
from suturestar.llm.decontaminate import decontaminated
from suturestar.llm.frames import discard, fresh, importable, kept, read
from suturestar.llm.ngram_join import class_key, first_classes, maybe_in
from suturestar.llm.quality import KEEP, fit, scored
from suturestar.session import scratch

# SQL has no classifier; the tests compare each stage with plain Python.
ORACLE_SQL = None
# What op3 takes for a part of a word.
WORD = r"[^\x20\x09-\x0D]"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    score = fresh("score")
    model = fit(docs, read(spark, sf_dir, "labels"))
    return docs.withColumn(score, scored(F.col("text"), model)).filter(F.col(score) >= KEEP).drop(score)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose id is first and in doubt are keyed and compared with the first classes; those not in doubt stay as they are."""
    importable(spark)
    place, key = fresh("place"), fresh("class")
    firsts, doubtful = first_classes(docs)
    id_ = F.col("doc_id").cast("long")
    doubt, first = (maybe_in(ids, ids.count(), id_) for ids in (doubtful, firsts.select("doc_id")))
    has_words = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    worded = docs.filter(F.col("doc_id").isNotNull() & has_words)
    unsure = kept(worded.filter(doubt & first), "unsure")
    keyed = unsure.withColumn(key, class_key(F.col("text")))
    one = F.row_number().over(Window.partitionBy("doc_id", key).orderBy("text"))
    best = keyed.withColumn(place, one).filter(F.col(place) == 1).join(firsts.withColumnRenamed("class", key), ["doc_id", key])
    stay = kept(best.select(*docs.columns), "stay")
    discard(firsts, doubtful, unsure)
    wordless = docs.filter(F.col("doc_id").isNotNull() & ~has_words).dropDuplicates(["doc_id", "text"])
    return worded.filter(~doubt).unionByName(stay).unionByName(wordless).unionByName(docs.filter("doc_id IS NULL"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return decontaminated(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs, pii.fit(docs))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return encoded(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicate),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
