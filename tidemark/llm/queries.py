"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from tidemark.llm.alignment import op12_alignment
from tidemark.llm.common import table
from tidemark.llm.decontaminate import OP7_SQL, op7_benchmark_decontamination
from tidemark.llm.exact_dedup import OP10_SQL, op10_exact_dedup
from tidemark.llm.language import op9_language_id
from tidemark.llm.packing import op1_best_fit_packing
from tidemark.llm.pii import op2_pii
from tidemark.llm.quality import op3_quality_classifier
from tidemark.llm.secrets import op4_secret_scan
from tidemark.llm.shards import op5_sharding
from tidemark.llm.simhash import op8_simhash_near_dedup
from tidemark.llm.token_counts import op6_token_counts
from tidemark.llm.token_files import op13_token_files
from tidemark.llm.vector_codes import OP11_SQL, op11_vector_codes

LLM_QUERIES = {
    "op1_best_fit_packing": lambda spark, d: op1_best_fit_packing(table(spark, d, "documents")),
    "op2_pii": lambda spark, d: op2_pii(table(spark, d, "documents")),
    "op3_quality_classifier": lambda spark, d: op3_quality_classifier(
        table(spark, d, "documents"), table(spark, d, "labels")),
    "op4_secret_scan": lambda spark, d: op4_secret_scan(table(spark, d, "documents")),
    "op5_sharding": lambda spark, d: op5_sharding(table(spark, d, "documents")),
    "op6_token_counts": lambda spark, d: op6_token_counts(table(spark, d, "documents")),
    "op7_benchmark_decontamination": lambda spark, d: op7_benchmark_decontamination(
        table(spark, d, "documents"), table(spark, d, "benchmark")),
    "op8_simhash_near_dedup": lambda spark, d: op8_simhash_near_dedup(table(spark, d, "documents")),
    "op9_language_id": lambda spark, d: op9_language_id(table(spark, d, "documents")),
    "op10_exact_dedup": lambda spark, d: op10_exact_dedup(table(spark, d, "documents")),
    "op11_vector_codes": lambda spark, d: op11_vector_codes(table(spark, d, "embeddings")),
    "op12_alignment": lambda spark, d: op12_alignment(table(spark, d, "documents")),
    "op13_token_files": lambda spark, d: op13_token_files(table(spark, d, "documents")),
}

LLM_SQL = {
    "op7_benchmark_decontamination": OP7_SQL,
    "op10_exact_dedup": OP10_SQL,
    "op11_vector_codes": OP11_SQL,
}
