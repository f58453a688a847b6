import glob
import os
import random
import re
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from suturestar.llm import ngram_join as nj
from suturestar.llm.components import components
from suturestar.llm.frames import kept
from suturestar.llm.shingles import shingle_sets

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


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
    return {i: (len(sets[i]), top(i)) for i in ids}


def _corpus(rng, copies):
    words = [f"w{i}" for i in range(3000)]
    line = " ".join(rng.choices(words, k=14))
    rows = []
    for i in range(60):
        rows.append(" ".join(rng.choices(words, k=rng.randint(1, 90))) + " " + (line if i % 3 == 0 else ""))
    base = rng.choices(words, k=70)
    for _ in range(copies):
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        rows.append(" ".join(copy))
    rows += [rows[0], rows[0].upper(), "Short text", "short  TEXT", "", "\t \n", None]
    order = list(range(len(rows)))
    rng.shuffle(order)
    return [(i, rows[k]) for i, k in enumerate(order)] + [(None, rows[0])]


@pytest.mark.parametrize(("small", "block", "threshold"), [(32, 1024, None), (3, 16, 1), (3, 16, 10**9)])
def test_equals_brute_force(spark, monkeypatch, small, block, threshold):
    """Also with shingles of few classes compared in blocks, with and without leader rounds."""
    monkeypatch.setattr(nj, "SMALL", small)
    monkeypatch.setattr(nj, "BLOCK", block)
    if threshold is not None:
        across = nj._pairs_across
        monkeypatch.setattr(nj, "_pairs_across", lambda p: across(p) * 10**6 if threshold == 1 else 0)
    rows = _corpus(random.Random(small), 60)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = nj.near_duplicates(df).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == _brute(rows)
    assert [r.component_id for r in got if r.doc_id is None] == [None]


@pytest.mark.parametrize("longer", ["{} extra", "extra {}"])
def test_a_pair_needs_the_smaller_number_of_matches(spark, longer):
    """The longer text asks for two matches and shares one posting; its partner asks for one."""
    text = "one two three four five six seven eight"
    rows = [(1, text), (2, longer.format(text)), (3, "nothing like the others in any of its words at all")]
    assert _brute(rows)[2] == (5, 1)
    got = nj.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == _brute(rows)


def test_short_texts_equal_brute_force(spark):
    """Texts of a few words with words added or cut off at the ends."""
    rng, rows = random.Random(8), []
    for i in range(150):
        base = [f"v{i}x{k}" for k in range(rng.randint(5, 30))]
        rows.append(base)
        rows += [[f"y{i}x{k}x{j}" for j in range(rng.randint(0, 2))] + base + [f"z{i}x{k}x{j}" for j in range(rng.randint(0, 2))] for k in range(rng.randint(1, 2))]
    rng.shuffle(rows)
    rows = [(i, " ".join(w)) for i, w in enumerate(rows)]
    got = nj.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == _brute(rows)


def test_odd_rows(spark, odd_documents):
    got = nj.near_duplicates(odd_documents)
    assert got.columns == ["doc_id", "n_shingles", "component_id"] and got.count() == odd_documents.count()
    assert {(r.doc_id, r.component_id) for r in got.collect() if r.doc_id in (1, 2, 3)} == {(1, 1), (2, 1), (3, 3)}
    assert nj.near_duplicates(odd_documents.limit(0)).count() == 0


def test_repeated_values_are_found_in_place():
    rng = np.random.default_rng(3)
    for n in (0, 1, 3, 4, 5, 40, 1000):
        values = rng.integers(0, n // 3 + 1, n).astype(np.uint64)
        token, count = np.unique(values, return_counts=True)
        found, often = nj.repeated(values.copy(), 4)
        assert found.tolist() == token[count >= 4].tolist() and often.tolist() == count[count >= 4].tolist()


def test_frequent_shingles_are_counted_in_little_memory():
    texts = [" ".join(f"w{i}x{k}" for k in range(3000)) for i in range(160)]
    batch = pa.RecordBatch.from_pydict({"id": list(range(160)), "text": texts})
    sketch = nj._sketch(iter([batch]))
    next(sketch)
    tracemalloc.start()
    list(sketch)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # All shingles once, as half of a sort of its own and the places that repeat.
    assert peak < 2 * 8 * 160 * 2996


def test_no_task_keys_rows_and_takes_the_own_ones(spark, monkeypatch):
    """Both in one task would hold two Python workers, as after a broadcast of the classes asked for."""
    plans, write = {}, nj.kept

    def kept_(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(nj, "kept", kept_)
    nj.near_duplicates(spark.createDataFrame(_corpus(random.Random(4), 5), "doc_id long, text string"))
    own, keyed = (m.start() for m in re.finditer("MapInArrow", plans["texts"]))
    assert re.findall(r"\w+Join|Exchange", plans["texts"][own:keyed]) == ["SortMergeJoin", "Exchange"]


def test_prefixes_share_enough_at_the_threshold():
    rng = np.random.default_rng(5)
    tokens = np.sort(rng.integers(0, 2**64, 50, np.uint64))
    counts = rng.integers(4, 1000, 50).astype(float)
    for _ in range(300):
        n = int(rng.integers(1, 80))
        x = np.unique(np.concatenate((rng.integers(0, 2**64, n, np.uint64), rng.choice(tokens, 6, False))))
        keep = nj.least_overlap(len(x))
        y = np.unique(np.concatenate((rng.choice(x, keep, False), rng.integers(0, 2**64, int(rng.integers(0, len(x) // 5 + 1)), np.uint64))))
        both = len(np.intersect1d(x, y))
        if 100 * both >= 80 * (len(x) + len(y) - both):
            (a, _, m), (b, _, k) = nj.prefix(x, tokens, counts), nj.prefix(y, tokens, counts)
            assert len(np.intersect1d(a, b)) >= min(m, k)
            first = [t[: len(s) - nj.least_overlap(len(s)) + 1] for t, s in ((a, x), (b, y))]
            assert len(np.intersect1d(*first)) >= 1


def test_bitmaps_never_refuse_a_pair_at_the_threshold():
    rng = np.random.default_rng(6)
    for _ in range(300):
        x = np.unique(rng.integers(0, 2**64, int(rng.integers(1, 300)), np.uint64))
        y = np.unique(np.concatenate((rng.choice(x, max(1, int(len(x) * rng.random())), False), rng.integers(0, 2**64, 20, np.uint64))))
        a, b = (np.frombuffer(nj.bitmap(s), np.uint8) for s in (x, y))
        assert nj.most_overlap(len(x), a, b) >= len(np.intersect1d(x, y))
        assert nj.most_overlap(len(y), b, a) >= len(np.intersect1d(x, y))


def test_shingle_sets_are_exact_and_independent_of_neighbours():
    rng = random.Random(9)
    texts = ["".join(rng.choice("ab AB\t\n\x0b é中") for _ in range(rng.randint(0, 60))) for _ in range(400)]
    sets = shingle_sets([t.encode() for t in texts])
    for t, s in zip(texts, sets):
        assert len(s) == len(_set(t)) and (s == shingle_sets([t.encode()])[0]).all()
    seen = {}
    for t, s in zip(texts, sets):
        assert seen.setdefault(s.tobytes(), _set(t)) == _set(t)


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(7, 7)]
    root = list(range(400))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in edges:
        a, b = top(u), top(v)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: top(x) for x in range(400) if top(x) != x}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_bit_tables_pass_all_that_is_wanted_and_few_others(spark):
    wanted = spark.createDataFrame([(7 * i << 26,) for i in range(2000)], "id long")
    bits = nj.BitTable(wanted, 2000)
    places = spark.createDataFrame([(i << 26,) for i in range(14000)], "id long").select("id", bits.place("id").alias("at")).collect()
    may = bits.test()(pa.array([p.at for p in places])).to_pylist()
    passed = {p.id for p, m in zip(places, may) if m}
    assert passed >= {r.id for r in wanted.collect()} and len(passed) < 3000
    assert not any(nj.BitTable(wanted.limit(0), 0).test()(pa.array(range(100))).to_pylist())


def test_only_texts_of_near_pairs_move(spark, monkeypatch):
    """Texts that share shingles of their prefixes, but with nobody enough, are not sent to the verification."""
    rng, rows, written = random.Random(4), [], {}
    for i in range(200):
        rows.append(" ".join(f"{'common' if k < 30 else f'w{i}'}x{k}" for k in range(100)))
    rows += [" ".join(f"copy{j}x{k}" for k in range(100)) + f" end{n}" for j in range(3) for n in range(2)]
    rng.shuffle(rows)
    kept = nj.kept

    def count(df, name):
        out = kept(df, name)
        written.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(nj, "kept", count)
    rows = list(enumerate(rows))
    got = nj.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == _brute(rows)
    assert 6 <= max(written["asked"]) < 60


def test_a_written_table_leaves_no_shuffle_files(spark):
    def files():
        folders = (spark.conf.get("spark.local.dir", "/tmp"), os.environ.get("SPARK_LOCAL_DIRS", "/tmp"))
        return {f for d in folders for f in glob.glob(f"{d}/**/blockmgr-*/*/shuffle_*.data", recursive=True)}

    df = spark.range(50000).repartition(4, "id")
    before = files()
    df.collect()
    assert files() - before
    before = files()
    written = kept(df, "rows")
    end = time.time() + 20
    while left := files() - before:
        assert time.time() < end, left
        time.sleep(0.2)
    assert written.count() == 50000


def _written(monkeypatch, module, look):
    """What `look` gives for every table that the module writes, by name."""
    seen, write = {}, module.kept

    def kept_(df, name):
        out = write(df, name)
        seen.setdefault(name, []).append(look(out))
        return out

    monkeypatch.setattr(module, "kept", kept_)
    return seen


def test_copies_of_rows_cost_no_postings(spark, monkeypatch):
    """Copies under other ids lie in other tasks, each of which would send the same postings."""
    seen = _written(monkeypatch, nj, lambda df: (df.count(), df.select("token", "class").distinct().count()) if "token" in df.columns else None)
    base = [(i, t) for i, t in _corpus(random.Random(11), 30) if i is not None]
    rows = [(i + k * 1000, t) for k in range(6) for i, t in base] + base[:20]
    got = nj.near_duplicates(spark.createDataFrame(spark.sparkContext.parallelize(rows, 7), "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == _brute(rows[: 6 * len(base)])
    (count, distinct), *_ = seen["postings"]
    assert count == distinct > 0


def test_blocks_take_turns(spark, monkeypatch):
    """A shingle of many classes sends each text to every block it meets; a turn sends some of them."""
    monkeypatch.setattr(nj, "SMALL", 3)
    monkeypatch.setattr(nj, "BLOCK", 8)
    monkeypatch.setattr(nj, "_pairs_across", lambda p: 0)
    monkeypatch.setattr(nj, "LEAST_SENT", 40)
    seen = _written(monkeypatch, nj, lambda df: df.count())
    rows = [r for r in _corpus(random.Random(3), 60) if r[0] is not None]
    got = nj.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == _brute(rows)
    assert len(seen["links"]) > 3


def test_tables_on_the_way_are_removed(spark):
    folder = f"{spark.conf.get('spark.checkpoint.dir')}/suturestar"
    before = set(glob.glob(f"{folder}/*"))
    rows = _corpus(random.Random(5), 40)
    got = nj.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    left = {os.path.basename(p).split("-")[0] for p in set(glob.glob(f"{folder}/*")) - before if glob.glob(f"{p}/*.parquet")}
    assert left <= {"shingles", "roots", "merged"} and got.count() == len(rows)
