"""The queries of this subpackage and, where SQL can say them, their DuckDB twins."""

from __future__ import annotations

from ledgerlake.llm import ann, bpe, decontaminate, hard_negatives, jaccard, licenses, line_dedup, lm, pii, spelling, tokens, toxicity, warc

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_pii": pii.op2_pii,
    "op3_license_scan": licenses.op3_license_scan,
    "op4_token_counts": tokens.op4_token_counts,
    "op5_warc": warc.op5_warc,
    "op6_lm_scores": lm.op6_lm_scores,
    "op7_decontamination": decontaminate.op7_decontamination,
    "op8_ngram_jaccard_join": jaccard.op8_ngram_jaccard_join,
    "op9_bpe": bpe.op9_bpe,
    "op10_ann": ann.op10_ann,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_spelling_variants": spelling.op12_spelling_variants,
    "op13_line_dedup": line_dedup.op13_line_dedup,
}

ORACLE_SQL = {
    "op5_warc": warc.ORACLE,
    "op8_ngram_jaccard_join": jaccard.ORACLE,
    "op11_hard_negatives": hard_negatives.ORACLE,
    "op12_spelling_variants": spelling.ORACLE,
    "op13_line_dedup": line_dedup.ORACLE,
}
