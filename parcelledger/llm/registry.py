"""The text operators as queries over the sample tables, with SQL where SQL can state them."""

from __future__ import annotations

from parcelledger.llm import (
    byte_bpe,
    chat_tree,
    decontamination,
    divergence,
    exact_dedup,
    jaccard_join,
    line_dedup,
    pii,
    secrets,
    token_counts,
    toxicity,
    url_rules,
    whitening,
)

QUERIES = {
    "op1_decontamination": decontamination.op1,
    "op2_toxicity": toxicity.op2,
    "op3_token_counts": token_counts.op3,
    "op4_pii": pii.op4,
    "op5_line_dedup": line_dedup.op5,
    "op6_url_filter": url_rules.op6,
    "op7_byte_bpe": byte_bpe.op7,
    "op8_jaccard_join": jaccard_join.op8,
    "op9_secrets": secrets.op9,
    "op10_exact_dedup": exact_dedup.op10,
    "op11_chat_tree": chat_tree.op11,
    "op12_source_divergence": divergence.op12,
    "op13_whitening": whitening.op13,
}

ORACLES = {"op10_exact_dedup": exact_dedup.SQL, "op12_source_divergence": divergence.SQL}
