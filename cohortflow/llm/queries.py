"""The queries of this subpackage, by name, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortflow.llm.bpe import op1_bpe_round_trip
from cohortflow.llm.fingerprints import op13_order_minhash
from cohortflow.llm.html import op10_html_text
from cohortflow.llm.langid import op8_language_id
from cohortflow.llm.lexical import ORACLE as RANKED_SEARCH_ORACLE
from cohortflow.llm.lexical import op12_ranked_search
from cohortflow.llm.minhash import op2_minhash_near_dedup
from cohortflow.llm.packing import op4_best_fit_packing
from cohortflow.llm.pii import op5_pii
from cohortflow.llm.prefix_trie import ORACLE as PREFIX_TRIE_ORACLE
from cohortflow.llm.prefix_trie import op11_prefix_trie
from cohortflow.llm.quality import op3_quality_rules
from cohortflow.llm.secrets import op9_secret_scan
from cohortflow.llm.substrings import op7_substring_dedup
from cohortflow.llm.topk import ORACLE as TOP_K_ORACLE
from cohortflow.llm.topk import op6_exact_top_k

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_bpe_round_trip, op2_minhash_near_dedup, op3_quality_rules, op4_best_fit_packing, op5_pii, op6_exact_top_k, op7_substring_dedup,
        op8_language_id, op9_secret_scan, op10_html_text, op11_prefix_trie, op12_ranked_search, op13_order_minhash)}
ORACLES: dict[str, str] = {"op6_exact_top_k": TOP_K_ORACLE, "op11_prefix_trie": PREFIX_TRIE_ORACLE, "op12_ranked_search": RANKED_SEARCH_ORACLE}
