import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from tokenizers import Tokenizer

from suturestar.llm import bpe

ODD = [
    "", "  ", None, "a<|endoftext|>b <|startoftext|>", "aaaaaaaaaaaa aaa", "abababab", "İstanbul ΣΑΣ ς", "don't I'll we've 'sx ''s",
    "1234 ½ ² 三百", "é ́x", "\x1c a\x1db", " x　y\x85z", "ﬁ 🤗🤗👩‍👩‍👧", "<|endoftext", "a\x00b", "﻿abc", "ẞß straße", "x" * 5000,
    "각", "a​b", "<|ENDOFTEXT|>", "�", "\U00018f0bċy\U0001ec22",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_vocabulary())


def _random(rng):
    if rng.random() < 0.6:
        return "".join(rng.choice("ab cth'sr\té́Σ中9.,\x1f ıİ<|>") for _ in range(rng.randint(0, 40)))
    return "".join(chr(rng.choice([rng.randrange(32, 0x300), rng.randrange(0x300, 0x3000), rng.randrange(0x10000, 0x1FFFF)])) for _ in range(rng.randint(0, 20)))


@pytest.mark.parametrize("by_library", [False, True])
def test_equals_the_library(library, by_library):
    rng = random.Random(1)
    texts = ODD + [_random(rng) for _ in range(2500)]
    encoder = bpe.Encoder(bpe.default_vocabulary(), by_library)
    for text, ids in zip(texts, encoder.encode(texts)):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert ids.tolist() == want, text
        assert " ".join(map(encoder.vocabulary.token.__getitem__, ids)) == library.decode(want, skip_special_tokens=False)


def test_small_slices_and_a_small_table(library, monkeypatch):
    monkeypatch.setattr(bpe, "SLICE", 50)
    monkeypatch.setattr(bpe, "KEPT_PIECES", 20)
    rng = random.Random(2)
    texts = [_random(rng) for _ in range(300)]
    for text, ids in zip(texts, bpe.Encoder(bpe.default_vocabulary()).encode(texts)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_columns(spark, library, odd_documents):
    df = odd_documents.withColumn("ids", bpe.encode(F.col("text"))).withColumn("back", bpe.decode(F.col("ids")))
    rows = df.collect()
    assert len(rows) == odd_documents.count()
    for r in rows:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == want and r.back == library.decode(want, skip_special_tokens=False)
    assert odd_documents.limit(0).select(bpe.encode(F.col("text"))).count() == 0


def test_digest(spark, sf_dir, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in bpe.op8_pair_index_bpe(spark, sf_dir).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_encoded_in_one_pass_of_slices(spark, library, monkeypatch):
    """Odd and very long texts, and columns named like the new ones."""
    monkeypatch.setattr(bpe, "SMALL_SLICE", 1000)
    rng = random.Random(3)
    long = " ".join(f"w{rng.randrange(5000)}x" for _ in range(700_000))
    texts = [*ODD, *[_random(rng) for _ in range(200)], long]
    df = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    out = bpe.encoded(df.repartition(3))
    assert out.columns == ["doc_id", "text", "ids", "n_tokens", "decoded"]
    for r in out.collect():
        want = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == want and r.n_tokens == len(want)
        assert r.decoded == library.decode(want, skip_special_tokens=False)
    assert bpe.encoded(df.limit(0)).count() == 0


def test_pieces_are_normalised_in_one_call():
    """One call of the library's normaliser for all pieces that need it, with the same result as one each."""
    vocabulary = bpe.Encoder(bpe.default_vocabulary()).vocabulary
    pieces = ["Plain", "\u00c4pfel", "e\u0301t\u00e9", "\u0301x", "\u03a3\u0391\u03a3", "\u0130", "a\x1cB\u00e9", "\u1e9e", "x" * 300 + "\u00e9"]
    alone = [vocabulary.normalize(p) for p in pieces]
    calls, plain = [], vocabulary.normalize
    vocabulary.normalize = lambda text: calls.append(text) or plain(text)
    assert vocabulary.normalized(pieces) == alone and len(calls) == 1
    assert vocabulary.normalized([]) == [] == vocabulary.normalized(["A"])[1:]


def test_names_are_joined_as_python_joins_them(monkeypatch):
    monkeypatch.setattr(bpe, "NAMES", 4)
    tokens = ["a</w>", "", "\u00e9", "long name"]
    ids = [np.array(x, np.uint32) for x in ([0, 1, 2], [], [3], [1], [2, 2, 2, 2, 2, 0], [])]
    want = [" ".join(tokens[i] for i in x) for x in ids]
    assert bpe.joined(pa.array(tokens), ids).to_pylist() == want and bpe.joined(pa.array(tokens), []).to_pylist() == []


def test_a_partition_leaves_no_table_behind():
    """Workers outlive a stage; what the encoder kept between slices must not."""
    pieces = bpe.small_encoder(bpe.default_vocabulary())
    docs = pa.RecordBatch.from_arrays([pa.array([f"word{i} other{i}" for i in range(50)])], names=["text"])

    class Rows:
        columns, schema = ["text"], StructType([StructField("text", StringType())])
        select = lambda self, *_: self
        mapInArrow = lambda self, run, _: list(run(iter([docs])))

    (out,) = bpe.encoded(Rows())
    assert out.num_rows == 50 and len(pieces.seen) == 0 == len(pieces.flat)
