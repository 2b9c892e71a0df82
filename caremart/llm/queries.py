"""The queries of this subpackage and their SQL, by name."""

from __future__ import annotations

import corpus_pipeline
from caremart.llm import (
    alignment,
    bpe,
    chosen_path,
    embedding_dedup,
    html_text,
    language,
    lexical_search,
    line_dedup,
    mixing,
    quality,
    simhash,
    substring_dedup,
    target_ratio,
)


def queries() -> dict:
    return {
        "op1_embedding_near_dedup": embedding_dedup.op1_embedding_near_dedup,
        "op2_html_text": html_text.op2_html_text,
        "op3_quality_classifier": quality.op3_quality_classifier,
        "op4_mix_sources": mixing.op4_mix_sources,
        "op5_simhash": simhash.op5_simhash,
        "op6_substring_dedup": substring_dedup.op6_substring_dedup,
        "op7_language_id": language.op7_language_id,
        "op8_byte_bpe": bpe.op8_byte_bpe,
        "op9_minhash_near_dedup": chosen_path.op9_minhash_near_dedup,
        "op10_line_dedup": line_dedup.op10_line_dedup,
        "op11_token_alignment": alignment.op11_token_alignment,
        "op12_lexical_search": lexical_search.op12_lexical_search,
        "op13_quality_rules": target_ratio.op13_quality_rules,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    """Operators that SQL cannot express have none; tests hold them against brute force."""
    return {
        "op1_embedding_near_dedup": embedding_dedup.OP1_SQL,
        "op4_mix_sources": mixing.OP4_SQL,
        "op10_line_dedup": line_dedup.OP10_SQL,
        "op12_lexical_search": lexical_search.OP12_SQL,
    }
