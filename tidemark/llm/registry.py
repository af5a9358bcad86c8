"""The registered queries of this subpackage and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    op1_source_mix,
    op10_pii,
    op11_chunked_bpe,
    op12_vector_codes,
    op13_fill_in_middle,
    op2_ngram_join,
    op3_byte_bpe,
    op4_huffman_ids,
    op5_language_spans,
    op6_exact_dedup,
    op7_suffix_dedup,
    op8_kd_topk,
    op9_toxicity,
)

MODULES = (
    op1_source_mix,
    op2_ngram_join,
    op3_byte_bpe,
    op4_huffman_ids,
    op5_language_spans,
    op6_exact_dedup,
    op7_suffix_dedup,
    op8_kd_topk,
    op9_toxicity,
    op10_pii,
    op11_chunked_bpe,
    op12_vector_codes,
    op13_fill_in_middle,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {m.NAME: m.query for m in MODULES} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {m.NAME: m.ORACLE_SQL for m in MODULES if m.ORACLE_SQL}
