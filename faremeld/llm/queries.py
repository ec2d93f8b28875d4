"""The operators' queries over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from faremeld.llm import chat_format, collocation, mixing, secret_scan, url_filter
from faremeld.llm.chat_format import op7_chat_format
from faremeld.llm.collocation import op12_phrase_collocations
from faremeld.llm.embedding_dedup import op1_embedding_dedup
from faremeld.llm.language import op8_language_id
from faremeld.llm.media import op2_media_columns
from faremeld.llm.mixing import op6_mix_sources
from faremeld.llm.near_dup import op10_probminhash_near_dup
from faremeld.llm.packing import op5_best_fit_packing
from faremeld.llm.pii import op4_pii
from faremeld.llm.secret_scan import op3_secret_scan
from faremeld.llm.spelling import op13_spelling_variants
from faremeld.llm.token_prefix import op11_prefix_token_counts
from faremeld.llm.url_filter import op9_url_filter


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_embedding_dedup, op2_media_columns, op3_secret_scan, op4_pii, op5_best_fit_packing, op6_mix_sources, op7_chat_format, op8_language_id, op9_url_filter, op10_probminhash_near_dup, op11_prefix_token_counts, op12_phrase_collocations, op13_spelling_variants)
    return {f.__name__: f for f in found}


def all_sql() -> dict[str, str]:
    return {
        op3_secret_scan.__name__: secret_scan.oracle(),
        op6_mix_sources.__name__: mixing.oracle(),
        op7_chat_format.__name__: chat_format.oracle(),
        op9_url_filter.__name__: url_filter.oracle(),
        op12_phrase_collocations.__name__: collocation.oracle(),
    }
