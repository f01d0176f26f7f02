"""Registered queries of this subpackage and their DuckDB equivalents."""

from __future__ import annotations

from quire.llm import (bpe, credentials, dialogue, langid, pii, shards, simhash, sketch, tokens, toxicity, warc,
                       whiten, winnow)

QUERIES = {
    "op1_language": langid.op1_language,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_surrogates": pii.op3_surrogates,
    "op4_token_counts": tokens.op4_token_counts,
    "op5_shards": shards.op5_shards,
    "op6_byte_bpe": bpe.op6_byte_bpe,
    "op7_fingerprints": sketch.op7_fingerprints,
    "op8_decontamination": winnow.op8_decontamination,
    "op9_warc": warc.op9_warc,
    "op10_simhash": simhash.op10_simhash,
    "op11_secrets": credentials.op11_secrets,
    "op12_whitening": whiten.op12_whitening,
    "op13_conversations": dialogue.op13_conversations,
}

ORACLE: dict[str, str] = {
    "op5_shards": shards.OP5_SQL,
    "op8_decontamination": winnow.OP8_SQL,
    "op9_warc": warc.OP9_SQL,
    "op13_conversations": dialogue.OP13_SQL,
}
