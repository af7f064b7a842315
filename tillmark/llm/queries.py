"""One query per text operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from tillmark.llm import html, langid, ledger, merkle, minhash, mixing, naming, negatives, pieces, pii, simhash, toxicity, winnow

LLM_REGISTRY = {
    "op1_mixture": mixing.op1_mixture,
    "op2_exact_dedup": naming.op2_exact_dedup,
    "op3_main_text": html.op3_main_text,
    "op4_secret_scan": ledger.op4_secret_scan,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_simhash": simhash.op6_simhash,
    "op7_fingerprints": winnow.op7_fingerprints,
    "op8_personal_data": pii.op8_personal_data,
    "op9_language": langid.op9_language,
    "op10_sentencepiece": pieces.op10_sentencepiece,
    "op11_hard_negatives": negatives.op11_hard_negatives,
    "op12_minhash": minhash.op12_minhash,
    "op13_merkle_manifest": merkle.op13_merkle_manifest,
}

LLM_ORACLES = {
    "op2_exact_dedup": naming.OP2_SQL,
    "op4_secret_scan": ledger.OP4_SQL,
    "op11_hard_negatives": negatives.OP11_SQL,
    "op12_minhash": minhash.OP12_SQL,
    "op13_merkle_manifest": merkle.OP13_SQL,
}
