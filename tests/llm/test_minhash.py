import random
import re

import numpy as np
import pytest

from suturestar.llm import minhash as mh

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return {tuple(w[i : i + 2]) for i in range(len(w) - 1)} if len(w) >= 2 else ({tuple(w)} if w else set())


def _brute(rows):
    sets = {i: _set(t) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i), top(i) == i) for i in ids}


def _result(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect() if r.doc_id is not None}


def _corpus(rng, copies, edits):
    words = [f"w{i}" for i in range(2000)]
    line = " ".join(rng.choices(words, k=14))
    rows = [" ".join(rng.choices(words, k=rng.randint(1, 90))) + " " + (line if i % 3 == 0 else "") for i in range(60)]
    base = rng.choices(words, k=70)
    for _ in range(copies):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        rows.append(" ".join(copy))
    for _ in range(60):
        short = rng.choices(words, k=rng.randint(2, 7))
        rows += [" ".join(short), " ".join(short + rng.choices(words, k=1))]
    rows += [rows[0], rows[0].upper(), "Short text", "short  TEXT", "", "\t \n", None]
    rng.shuffle(rows)
    return list(enumerate(rows)) + [(None, rows[0])]


@pytest.mark.parametrize(("edits", "heavy"), [(4, 1000), (8, 5), (12, 1000)])
def test_equals_brute_force(spark, monkeypatch, edits, heavy):
    """With more edits most copies are unlinked and buckets stay open for several rounds."""
    monkeypatch.setattr(mh, "HEAVY_ROWS", heavy)
    rows = _corpus(random.Random(edits), 80, edits)
    got = mh.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert got.count() == len(rows)
    assert _result(got) == _brute(rows)


def test_odd_rows(spark, odd_documents):
    got = mh.near_duplicates(odd_documents)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"] and got.count() == 9
    rows = {(r.doc_id, r.component_id, r.kept) for r in got.collect()}
    assert {(1, 1, True), (2, 1, False), (3, 3, True), (None, None, True)} <= rows
    assert mh.near_duplicates(odd_documents.limit(0)).count() == 0


def test_signatures_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(7)
    for size in (1, 2, 5, 20, 100, 600, 3000):
        seen = []
        for _ in range(60):
            s = np.unique(rng.integers(0, 2**64, size, np.uint64))
            more = rng.integers(0, 2**64, max(1, size // 4), np.uint64)
            t = np.unique(np.concatenate((s, more)))
            seen.append((mh.signature(s) == mh.signature(t)).mean() - len(s) / len(t))
        assert abs(np.mean(seen)) < 0.04


def test_sets_at_the_threshold_share_a_bucket():
    rng = np.random.default_rng(8)
    for size in (4, 8, 40, 400, 4000):
        for _ in range(300):
            t = np.unique(rng.integers(0, 2**64, size + size // 4, np.uint64))
            s = np.sort(rng.choice(t, -(-len(t) * 4 // 5), False))
            assert (mh.band_keys(s) == mh.band_keys(t)).any()


def test_a_star_bounds_the_candidates(spark):
    """A bucket of 500 classes gives at most 2 candidates a class in the first round."""
    bits = [f"0L AS bits{i}" for i in range(mh.SKETCH_BITS // 64)]
    members = spark.range(500).selectExpr("1L AS band", "500L AS size", "id AS turn", "id AS class", "id AS root", "9L AS n", *bits)
    edges, rest = mh.star(members, 2, 500)
    assert 498 <= edges.count() <= 2 * 500 and rest.count() == 498


def test_bits_refuse_no_link_and_most_others(spark):
    rng = np.random.default_rng(9)
    rows, linked = [], []
    for k in range(400):
        size = int(rng.integers(1, 300))
        x = np.unique(rng.integers(0, 2**64, size, np.uint64))
        share = 0.5 if k % 2 else rng.uniform(0.8, 1)
        y = np.unique(np.concatenate((x[: int(np.ceil(len(x) * share))], rng.integers(0, 2**64, int(len(x) * (1 - share)), np.uint64))))
        both = len(np.intersect1d(x, y))
        linked.append(100 * both >= 80 * (len(x) + len(y) - both))
        rows.append((k, [len(x), *mh.sketch_bits(x).tolist()], [len(y), *mh.sketch_bits(y).tolist()]))
    df = spark.createDataFrame(rows, "k int, p array<long>, q array<long>")

    def side(c):
        names = ["n", *[f"bits{i}" for i in range(mh.SKETCH_BITS // 64)]]
        return df.select("k", *[df[c][i].alias(n) for i, n in enumerate(names)])

    may = {r.k for r in side("p").alias("x").join(side("q").alias("y"), "k").filter(mh.may_link("x", "y")).collect()}
    assert {k for k, yes in enumerate(linked) if yes} <= may
    assert len(may) < sum(linked) + 60


def test_a_task_leaves_out_what_its_links_connect():
    """All pairs of 30 close texts and 2 far ones: one link less than close texts, and these all connected."""
    import pyarrow as pa

    texts = [" ".join(f"w{i}" for i in range(100)) + f" end{k}" for k in range(30)] + ["far away", "somewhere else"]
    pairs = [(a, b) for a in range(32) for b in range(a)]
    columns = [pa.array(c) for c in zip(*[(a, b, texts[a], texts[b]) for a, b in pairs])]
    batch = pa.RecordBatch.from_arrays(columns, names=["a", "b", "text_a", "text_b"])
    links = [tuple(r.values()) for out in mh._confirmed(2, iter([batch])) for r in out.to_pylist()]
    reached = {0}
    for _ in links:
        reached |= {x for link in links if set(link) & reached for x in link}
    assert len(links) == 29 and reached == set(range(30))
