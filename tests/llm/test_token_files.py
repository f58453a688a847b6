import zlib

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from suturestar.llm import token_files as tf
from suturestar.llm.bpe import default_vocabulary


def test_the_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 50, 5000):
        h = np.unique(rng.integers(0, 2**64, n, np.uint64))
        sizes, bits = tf.build_hash(h)
        assert sorted(tf.slots(h, sizes, bits)) == list(range(len(h)))
        other = rng.integers(0, 2**64, 300, np.uint64)
        slot = tf.slots(other, sizes, bits)
        assert ((slot >= -1) & (slot < max(1, len(h)))).all()


def test_digest(spark, sf_dir):
    library = Tokenizer.from_file(default_vocabulary())
    docs = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in tf.op10_hash_indexed_ids(spark, sf_dir).collect()}
    start = 0
    for d in docs:
        ids = [*library.encode(d.text, add_special_tokens=False).ids, 2]
        assert got[d.doc_id] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_odd_rows_small_shards_and_keys(spark, odd_documents, tmp_path, monkeypatch):
    monkeypatch.setattr(tf, "KEYS_PER_BUCKET", 2)
    folder = str(tmp_path / "files")
    tf.write(odd_documents, folder)
    asked = spark.createDataFrame([(1,), (2,), (2,), (3,), (4,), (None,), (6,), (-1,)], "key long")
    rows = tf.lookup(spark, folder, asked).select("key", "start", (F.octet_length("ids") / 4).cast("int").alias("n")).collect()
    found = sorted((r.start, r.key, r.n) for r in rows)
    assert [k for _, k, _ in found] == [None, 1, 2, 2, 3, 4]
    assert [n for _, k, n in found if k in (3, 4)] == [1, 1]
    library = Tokenizer.from_file(default_vocabulary())
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids) + 1
    first = count("no id here at all but words")
    assert [s for s, k, _ in found][:3] == [0, first, first + count("alpha beta gamma delta epsilon zeta eta theta")]
    tf.write(odd_documents.limit(0), folder + "-empty")
    assert tf.lookup(spark, folder + "-empty", asked).count() == 0


def test_copies_of_an_id(spark, tmp_path):
    docs = spark.range(40).select(F.lit(7).alias("doc_id"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"))
    folder = str(tmp_path / "copies")
    tf.write(docs.unionByName(spark.sql("select 8 as doc_id, 'x' as text")), folder)
    got = tf.lookup(spark, folder, spark.sql("select 7L as key"))
    assert got.count() == 40 and got.select("start").distinct().count() == 40
