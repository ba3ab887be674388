"""The queries of this subpackage and, where SQL can state them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe import op4_byte_level_bpe
from .chat import op10_chat_formatting
from .clustering import OP11_SQL, op11_centroid_clustering
from .divergence import OP13_SQL, op13_source_divergence
from .html_text import op9_html_extraction
from .line_dedup import OP5_SQL, op5_line_dedup
from .ngram_join import op1_ngram_jaccard_join
from .packing import op3_packing
from .quality import op2_quality_rules
from .quality_classifier import op12_quality_classifier
from .substring_dedup import op7_suffix_array_dedup
from .url_reputation import OP8_SQL, op8_url_filter
from .vector_search import op6_vector_search

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_quality_rules": op2_quality_rules,
    "op3_packing": op3_packing,
    "op4_byte_level_bpe": op4_byte_level_bpe,
    "op5_line_dedup": op5_line_dedup,
    "op6_vector_search": op6_vector_search,
    "op7_suffix_array_dedup": op7_suffix_array_dedup,
    "op8_url_filter": op8_url_filter,
    "op9_html_extraction": op9_html_extraction,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_quality_classifier": op12_quality_classifier,
    "op13_source_divergence": op13_source_divergence,
}
ORACLE_SQL: dict[str, str] = {"op5_line_dedup": OP5_SQL, "op8_url_filter": OP8_SQL, "op11_centroid_clustering": OP11_SQL, "op13_source_divergence": OP13_SQL}
