"""The registered queries of this package, and their oracle SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from suturestar.llm.bpe import op8_pair_index_bpe
from suturestar.llm.decontaminate import op1_wand_decontamination
from suturestar.llm.frames import importable
from suturestar.llm.html_text import op6_recurrent_html_text
from suturestar.llm.merkle import OP12_SQL, op12_merkle_manifest
from suturestar.llm.minhash import OP13_SQL, op13_minhash_near_dedup
from suturestar.llm.ngram_join import OP3_SQL, op3_adaptive_prefix_join
from suturestar.llm.pii import op7_weak_supervision_pii
from suturestar.llm.quality import op5_pu_quality
from suturestar.llm.resample import OP11_SQL, op11_importance_resampling
from suturestar.llm.sharding import op9_histogram_shards
from suturestar.llm.token_counts import op4_edit_aware_token_counts
from suturestar.llm.token_files import op10_hash_indexed_ids
from suturestar.llm.vector_search import OP2_SQL, op2_va_file_top_k

Query = Callable[[SparkSession, str], DataFrame]
QUERIES = (
    op1_wand_decontamination,
    op2_va_file_top_k,
    op3_adaptive_prefix_join,
    op4_edit_aware_token_counts,
    op5_pu_quality,
    op6_recurrent_html_text,
    op7_weak_supervision_pii,
    op8_pair_index_bpe,
    op9_histogram_shards,
    op10_hash_indexed_ids,
    op11_importance_resampling,
    op12_merkle_manifest,
    op13_minhash_near_dedup,
)


def _ready(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    return {f.__name__: _ready(f) for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_va_file_top_k": OP2_SQL,
        "op3_adaptive_prefix_join": OP3_SQL,
        "op11_importance_resampling": OP11_SQL,
        "op12_merkle_manifest": OP12_SQL,
        "op13_minhash_near_dedup": OP13_SQL,
    }
