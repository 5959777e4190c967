"""The registered queries of this folder."""

from __future__ import annotations

from likeness.llm import alignment, curriculum, decontamination, embedding_dedup, language, merkle, oracles, piece_codec, quality_classifier, quality_rules, secrets, sharding, simhash, token_counts

QUERIES = {
    "op1_token_counts": token_counts.op1,
    "op2_language_id": language.op2,
    "op3_piece_codec": piece_codec.op3,
    "op4_simhash_near_dedup": simhash.op4,
    "op5_quality_rules": quality_rules.op5,
    "op6_secret_scan": secrets.op6,
    "op7_embedding_near_dedup": embedding_dedup.op7,
    "op8_quality_classifier": quality_classifier.op8,
    "op9_curriculum_mix": curriculum.op9,
    "op10_sharding": sharding.op10,
    "op11_decontamination": decontamination.op11,
    "op12_token_alignment": alignment.op12,
    "op13_merkle_manifest": merkle.op13,
}
ORACLE: dict[str, str] = {"op11_decontamination": oracles.DECONTAMINATION, "op13_merkle_manifest": oracles.MERKLE}
