import random

import pytest

from suturestar.llm import token_counts as tc

PIECES = ["a", "b", " ", "  ", "\n", "'", "ll", "'s", "re", "é", "1", "22", ".", "!!", "\t", "the ", "don't", " x", "中", "🤗", "\r\n"]


@pytest.fixture(scope="module")
def counter():
    return tc.Counter(tc.default_vocabulary())


def _text(rng, most):
    return "".join(rng.choice(PIECES) for _ in range(rng.randint(0, most)))


@pytest.mark.parametrize("leaf", [1, 2, 3, 8, 64])
def test_edits_equal_counting_anew(counter, monkeypatch, leaf):
    monkeypatch.setattr(tc, "LEAF", leaf)
    rng = random.Random(leaf)
    for _ in range(300):
        text = _text(rng, 60)
        tree = tc.Tree(counter, text)
        for _ in range(8):
            pos, n, ins = rng.randint(0, len(text) + 2), rng.choice([0, 0, 1, 2, 5, 30]), _text(rng, rng.choice([0, 1, 2, 10]))
            at = min(pos, len(text))
            text = text[:at] + ins + text[at + n :]
            tree.edit(pos, n, ins)
            assert tree.text() == text and tree.n_chars() == len(text)
            assert tree.n_tokens() == len(counter.encoding.encode_ordinary(text))


def test_an_edit_encodes_a_small_part(counter):
    tree = tc.Tree(counter, "some ordinary words of a longer text, " * 5000)
    tree.edit(90_000, 10, "changed")
    assert tree.encoded < 10


def test_documents_and_edits(spark, odd_documents):
    edits = spark.createDataFrame(
        [(1, 2, 0, 5, "ALPHA"), (1, 1, 10_000, 3, " end"), (2, 1, None, None, None), (3, 1, 0, 0, "new"), (99, 1, 0, 0, "x"), (None, 1, 0, 0, "y"), (8, 1, -5, -5, "z")],
        "doc_id long, seq int, pos int, n_del int, ins string",
    )
    count = lambda t: len(tc.counter(tc.default_vocabulary()).encoding.encode_ordinary(t))
    rows = tc.counts_after_edits(odd_documents, edits).collect()
    assert len(rows) == odd_documents.count()
    got = {r.doc_id: r for r in rows}
    assert got[1].n_tokens == count("ALPHA beta gamma delta epsilon zeta eta theta end") and got[1].n_edits == 2
    assert got[3].n_tokens == count("new") and got[3].n_tokens_before == 0
    assert [r.n_edits for r in rows if r.doc_id == 2] == [1, 1]
    assert got[4].n_tokens == 0 and got[None].n_edits == 0
    assert got[8].n_tokens == count("ztie é 中文 🤗 <|endoftext|> a@b.com")
    assert tc.counts_after_edits(odd_documents.limit(0), edits).count() == 0


def test_revision_equals_plain_slicing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(80)
    edits = {}
    for r in tc.revision(docs).collect():
        edits.setdefault(r.doc_id, []).append(r)
    got = {r.doc_id: r for r in tc.counts_after_edits(docs, tc.revision(docs)).collect()}
    encode = tc.counter(tc.default_vocabulary()).encoding.encode_ordinary
    for d in docs.collect():
        text = d.text
        for e in sorted(edits[d.doc_id], key=lambda e: e.seq):
            at = min(e.pos, len(text))
            text = text[:at] + e.ins + text[at + e.n_del :]
        assert (got[d.doc_id].n_chars, got[d.doc_id].n_tokens) == (len(text), len(encode(text)))
