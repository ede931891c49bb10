"""Registered queries of the corpus operators and their SQL twins."""

from __future__ import annotations

from courtside.llm import (
    bagminhash, ctw, hard_negatives, hash_forest, langid, license_scan, mixing, packing, prefix_trie, quality_mil, topk,
    toxicity, url_filter)

QUERIES = {
    "op1_quality_mil": quality_mil.op1_quality_mil,
    "op2_bagminhash": bagminhash.op2_bagminhash,
    "op3_mixing": mixing.op3_mixing,
    "op4_topk": topk.op4_topk,
    "op5_ctw": ctw.op5_ctw,
    "op6_license_scan": license_scan.op6_license_scan,
    "op7_packing": packing.op7_packing,
    "op8_langid": langid.op8_langid,
    "op9_hash_forest": hash_forest.op9_hash_forest,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_url_filter": url_filter.op12_url_filter,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
}

ORACLE_SQL = {
    "op4_topk": topk.ORACLE_SQL,
    "op6_license_scan": license_scan.oracle_sql(),
    "op11_hard_negatives": hard_negatives.ORACLE_SQL,
    "op12_url_filter": url_filter.ORACLE_SQL,
    "op13_prefix_trie": prefix_trie.ORACLE_SQL,
}
