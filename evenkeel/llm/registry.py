"""The queries of this subpackage and their SQL."""

from evenkeel.llm import (
    q_conversations,
    q_exact_dedup,
    q_host_reputation,
    q_language,
    q_lattice,
    q_mixing,
    q_ngram_join,
    q_packing,
    q_quality,
    q_records,
    q_secrets,
    q_toxicity,
    q_whitening,
)

QUERIES = {
    "op1_ngram_join": q_ngram_join.op1_ngram_join,
    "op2_language": q_language.op2_language,
    "op3_token_records": q_records.op3_token_records,
    "op4_secrets": q_secrets.op4_secrets,
    "op5_lattice_scores": q_lattice.op5_lattice_scores,
    "op6_quality": q_quality.op6_quality,
    "op7_mixing": q_mixing.op7_mixing,
    "op8_packing": q_packing.op8_packing,
    "op9_exact_dedup": q_exact_dedup.op9_exact_dedup,
    "op10_toxicity": q_toxicity.op10_toxicity,
    "op11_whitening": q_whitening.op11_whitening,
    "op12_conversations": q_conversations.op12_conversations,
    "op13_url_filter": q_host_reputation.op13_url_filter,
}

ORACLE_SQL = {
    "op1_ngram_join": q_ngram_join.ORACLE,
    "op6_quality": q_quality.ORACLE,
    "op9_exact_dedup": q_exact_dedup.ORACLE,
    "op13_url_filter": q_host_reputation.ORACLE,
}
