"""Queries over the dealt operators, and their DuckDB statements where SQL can say them."""

from __future__ import annotations

from txnscore.llm import (bpe, chat, crosstoken, fingerprint, langid, license, packing, partenum, periodic, quality, substring,
                          toxicity, warc)

QUERIES = {
    "op1_conv_toxicity": toxicity.op1,
    "op2_segmentation_langid": langid.op2,
    "op3_warc_dictionary": warc.op3,
    "op4_partenum_jaccard_join": partenum.op4,
    "op5_consistent_parsing": fingerprint.op5,
    "op6_quality_rules": quality.op6,
    "op7_bpe_trie": bpe.op7,
    "op8_chat_formatting": chat.op8,
    "op10_automaton_substring_dedup": substring.op10,
    "op9_cutting_stock_packing": packing.op9,
    "op11_suffix_tree_runs": periodic.op11,
    "op12_license_set_join": license.op12,
    "op13_merge_path_alignment": crosstoken.op13,
}
ORACLE = {
    "op3_warc_dictionary": warc.SQL,
    "op4_partenum_jaccard_join": partenum.SQL,
    "op6_quality_rules": quality.SQL,
    "op8_chat_formatting": chat.SQL,
    "op10_automaton_substring_dedup": substring.SQL,
    "op12_license_set_join": license.SQL,
}
