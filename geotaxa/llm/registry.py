"""Queries and DuckDB oracles of this subpackage, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from geotaxa.llm import (
    conversation_trie,
    edit_embedding,
    filter_audit,
    hidden_markov,
    hyper_language,
    license_scan,
    personal_data,
    prefix_free,
    qgram_leaks,
    quality_net,
    raking,
    secret_crf,
    superminhash,
)

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_edit_fingerprint": edit_embedding.op1_edit_fingerprint,
        "op2_raking": raking.op2_raking,
        "op3_hyper_language": hyper_language.op3_hyper_language,
        "op4_prefix_free": prefix_free.op4_prefix_free,
        "op5_hidden_markov": hidden_markov.op5_hidden_markov,
        "op6_superminhash": superminhash.op6_superminhash,
        "op7_quality_net": quality_net.op7_quality_net,
        "op8_license_scan": license_scan.op8_license_scan,
        "op9_qgram_leaks": qgram_leaks.op9_qgram_leaks,
        "op10_secret_scan": secret_crf.op10_secret_scan,
        "op11_filter_audit": filter_audit.op11_filter_audit,
        "op12_personal_data": personal_data.op12_personal_data,
        "op13_conversation_trie": conversation_trie.op13_conversation_trie,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_raking": raking.oracle_sql(),
        "op8_license_scan": license_scan.oracle_sql(),
        "op11_filter_audit": filter_audit.oracle_sql(),
        "op13_conversation_trie": conversation_trie.oracle_sql(),
    }
