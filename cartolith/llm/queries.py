"""The registered queries of this subpackage and their DuckDB equivalents."""

from __future__ import annotations

from .bpe import op11_bpe_round_trip
from .chat import OP10_SQL, op10_chat_formatting
from .decontamination import OP8_SQL, op8_benchmark_decontamination
from .embeddings import op1_embedding_near_dedup
from .html import op9_html_extraction
from .merkle import OP13_SQL, op13_merkle_manifest
from .minhash import op7_minhash_near_dedup
from .mixing import OP4_SQL, op4_source_mixing
from .quality import op5_quality_classifier
from .resampling import OP12_SQL, op12_importance_resampling
from .substrings import op2_substring_dedup
from .suffixes import op6_suffix_array_dedup
from .toxicity import op3_toxicity

QUERIES = {
    "op1_embedding_near_dedup": op1_embedding_near_dedup,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_source_mixing": op4_source_mixing,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_suffix_array_dedup": op6_suffix_array_dedup,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_html_extraction": op9_html_extraction,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_bpe_round_trip": op11_bpe_round_trip,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_merkle_manifest": op13_merkle_manifest,
}
ORACLE_SQL = {
    "op4_source_mixing": OP4_SQL,
    "op8_benchmark_decontamination": OP8_SQL,
    "op10_chat_formatting": OP10_SQL,
    "op12_importance_resampling": OP12_SQL,
    "op13_merkle_manifest": OP13_SQL,
}
