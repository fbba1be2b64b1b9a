"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from folioflow.llm import ann, brown, chat, decontaminate, exponion, language, merkle, ngram_join, packing, quality, secrets, sharding, toxicity

QUERIES = {
    "op1_pack_documents": packing.query,
    "op2_quality_rules": quality.query,
    "op3_language_id": language.query,
    "op4_balanced_shards": sharding.query,
    "op5_chat_format": chat.query,
    "op6_decontaminate": decontaminate.query,
    "op7_toxicity": toxicity.query,
    "op8_secret_scan": secrets.query,
    "op9_ngram_jaccard": ngram_join.query,
    "op10_brown_lm": brown.query,
    "op11_ivf_pq_search": ann.query,
    "op12_merkle_manifest": merkle.query,
    "op13_vector_codes": exponion.query,
}

ORACLE_SQL: dict[str, str] = {
    "op5_chat_format": chat.ORACLE_SQL,
    "op6_decontaminate": decontaminate.ORACLE_SQL,
    "op9_ngram_jaccard": ngram_join.ORACLE_SQL,
    "op12_merkle_manifest": merkle.ORACLE_SQL,
    "op13_vector_codes": exponion.ORACLE_SQL,
}
