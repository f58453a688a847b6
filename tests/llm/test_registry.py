"""Every dealt query runs on the smallest tables, is well formed, and equals its SQL where it has one."""

import pytest

import __spark_entry__ as entry
from suturestar.llm import queries as llm
from tests.compare import compare, oracle_connection

COLUMNS = {
    "op2": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    "op3": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op5": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op6": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op7": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string"},
    "op8": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op9": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op10": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op11": {"doc_id": "bigint", "n_features": "bigint", "weight": "bigint", "score": "bigint", "rank": "bigint"},
    "op12": {"doc_id": "bigint", "leaf": "string", "subroot": "string", "root": "string", "proof_sha256": "string", "folded_root": "string", "verified": "boolean"},
    "op13": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
}
ONE_ROW_EACH = {"op3": "documents", "op4": "documents", "op5": "documents", "op6": "pages", "op7": "documents", "op8": "documents", "op9": "documents", "op10": "documents", "op11": "documents", "op12": "documents", "op13": "documents"}


def test_all_operators_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in llm.queries()} == {f"op{i}" for i in range(1, 14)}
    assert set(llm.queries()) | {"pipeline"} <= names


@pytest.mark.parametrize("name", sorted(llm.queries()))
def test_columns_and_rows(spark, sf_dir, name):
    df = llm.queries()[name](spark, sf_dir)
    op = name.split("_")[0]
    types = dict(df.dtypes)
    for column, kind in COLUMNS.get(op, {}).items():
        assert types[column] == kind
    if op in ONE_ROW_EACH:
        assert df.count() == spark.read.parquet(f"{sf_dir}/{ONE_ROW_EACH[op]}.parquet").count()


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_matches_sql(spark, sf_dir, name):
    assert compare(spark, oracle_connection(sf_dir), llm.queries()[name], llm.oracle_sql()[name], sf_dir) is None
