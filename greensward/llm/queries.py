"""The queries over the corpus tables and their DuckDB SQL."""

from greensward.llm import alignment, embedding_dedup, line_dedup, lm_scoring, mixing, ngram_join, packing, pii, quality_model, quality_rules, token_archive, token_counts, whitening

QUERIES = {
    "op1_ngram_join": ngram_join.op1_ngram_join,
    "op2_quality_rules": quality_rules.op2_quality_rules,
    "op3_packing": packing.op3_packing,
    "op4_token_archive": token_archive.op4_token_archive,
    "op5_embedding_dedup": embedding_dedup.op5_embedding_dedup,
    "op6_line_dedup": line_dedup.op6_line_dedup,
    "op7_mixing": mixing.op7_mixing,
    "op8_pii": pii.op8_pii,
    "op9_token_counts": token_counts.op9_token_counts,
    "op10_quality_model": quality_model.op10_quality_model,
    "op11_alignment": alignment.op11_alignment,
    "op12_lm_scoring": lm_scoring.op12_lm_scoring,
    "op13_whitening": whitening.op13_whitening,
}
SQL = {
    "op6_line_dedup": line_dedup.OP6_SQL,
    "op7_mixing": mixing.OP7_SQL,
}
