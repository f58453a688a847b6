"""Each stage on its own input, against plain Python."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as cp
from suturestar.llm import decontaminate, ngram_join, pii, quality
from suturestar.llm.bpe import default_vocabulary


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of every stage, as the driver runs them."""
    sf_dir = "/root/testdata/sf0.001"
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, stage in cp.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        after = spark.read.parquet(path)
        out[name] = (docs, after)
        docs = after
    return out


def test_stage_order_and_columns(stages):
    assert list(stages) == ["quality", "near_duplicates", "decontamination", "personal_data", "encoding"]
    for name, (before, after) in stages.items():
        assert after.columns[: len(before.columns)] == before.columns
        assert name == "encoding" or after.columns == before.columns


def _ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_quality_stage(spark, sf_dir, stages):
    before, after = stages["quality"]
    model = quality.fit(before, quality.read(spark, sf_dir, "labels"))
    want = {r.doc_id for r in before.collect() if model.score(quality.features(r.text)[None])[0] >= 0.3}
    assert _ids(after) == want and 0 < len(want) < before.count()


def test_near_duplicate_stage(stages):
    before, after = stages["near_duplicates"]
    root = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(before).collect()}
    assert _ids(after) == set(root.values()) and len(set(root.values())) < len(root)


def test_decontamination_stage(spark, sf_dir, stages):
    before, after = stages["decontamination"]
    items = [" " + " ".join(decontaminate.words(r.text)) + " " for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaked = {r.doc_id for r in before.collect() if any(i in " " + " ".join(decontaminate.words(r.text)) + " " for i in items)}
    assert leaked and _ids(after) == _ids(before) - leaked


def test_personal_data_stage(stages):
    before, after = stages["personal_data"]
    model = pii.fit(before)
    new = {r.doc_id: r.text for r in after.collect()}
    changed = 0
    for r in pii.spans(before, model).collect():
        text, at, parts = r.text, 0, []
        for s in sorted(r.spans, key=lambda s: (s.start, s.end)):
            if s.start >= at:
                parts += [text[at : s.start], f"[{s.kind.upper()}]"]
            at = max(at, s.end)
        want = "".join(parts) + text[at:]
        changed += want != text
        assert new[r.doc_id] == want
    assert changed and len(new) == before.count()


def test_encoding_stage(stages):
    before, after = stages["encoding"]
    assert after.count() == before.count()
    library = Tokenizer.from_file(default_vocabulary())
    for r in after.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids)
        assert r.decoded == library.decode(ids, skip_special_tokens=False)


def test_odd_rows_pass_every_stage(spark, sf_dir, tmp_path):
    rows = [(1, "alpha beta gamma delta epsilon zeta"), (2, "alpha beta gamma delta epsilon zeta"), (2, "alpha beta gamma delta epsilon zeta"), (3, None), (4, ""), (None, "no id"), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", "text", F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"), F.length("text").cast("long").alias("n_chars"))
    for frame in (docs, docs.limit(0)):
        for name, stage in cp.STAGES[1:]:
            frame = stage(spark, frame, sf_dir)
        assert {"ids", "n_tokens"} <= set(frame.columns)
        kept = sorted((r.doc_id is None, r.doc_id or 0) for r in frame.collect())
        assert kept in ([], [(False, 1), (False, 3), (False, 4), (True, 0), (True, 0)])


def test_rows_of_one_id_are_duplicates_only_if_linked(spark, sf_dir):
    a, b = "alpha beta gamma delta epsilon zeta eta theta", "one two three four five six seven eight nine ten"
    rows = [(1, a), (1, b), (1, a), (1, a + " iota"), (2, a.upper()), (3, b + " eleven"), (4, None), (4, ""), (4, None), (4, "\t")]
    got = [(r.doc_id, r.text) for r in cp.near_duplicate(spark, spark.createDataFrame(rows, "doc_id long, text string"), sf_dir).collect()]
    assert sorted(r for r in got if r[0] == 4 and r[1] is not None) == [(4, ""), (4, "\t")] and got.count((4, None)) == 1
    worded = [r for r in got if r[0] != 4]
    assert len(worded) == 2 and (1, b) in worded and {(1, a), (1, a + " iota")} & set(worded)


def test_near_duplicates_key_texts_once(spark, sf_dir):
    """A second evaluation takes a second Python worker of each task."""
    rows = [(1, "alpha beta gamma delta epsilon zeta"), (2, "one two three four five six seven"), (3, "")]
    df = cp.near_duplicate(spark, spark.createDataFrame(rows, "doc_id long, text string"), sf_dir)
    assert df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert df.count() == 3


def test_run(spark, sf_dir, stages):
    assert _ids(cp.run(spark, sf_dir)) == _ids(stages["encoding"][1])


def test_only_rows_in_doubt_are_keyed_and_moved(spark, sf_dir, monkeypatch):
    """Rows that surely stay, and copies that surely go, are not compared with the first classes."""
    written, write = {}, cp.kept

    def kept(df, name):
        out = write(df, name)
        written[name] = out.count()
        return out

    monkeypatch.setattr(cp, "kept", kept)
    base = [(i, f"one{i} two{i} three{i} four{i} five{i} six{i}") for i in range(300)]
    rows = base + [(i + 1000, t) for i, t in base] + base[:5]
    got = cp.near_duplicate(spark, spark.createDataFrame(rows, "doc_id long, text string"), sf_dir).collect()
    assert sorted((r.doc_id, r.text) for r in got) == base
    assert 5 <= written["stay"] < 40 and 10 <= written["unsure"] < 60
