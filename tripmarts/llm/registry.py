"""The registered corpus queries, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tripmarts.llm import (
    bpe, chat, hardnegatives, hmm, langid, lexical, mixing, neardup_vectors, quality, repeats, secrets, simhash, urllists,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "pipeline": corpus_pipeline.run,
        "op1_embedding_neardup": neardup_vectors.op1_embedding_neardup,
        "op2_url_lists": urllists.op2_url_lists,
        "op3_lm_scores": hmm.op3_lm_scores,
        "op4_repeated_passages": repeats.op4_repeated_passages,
        "op5_byte_bpe": bpe.op5_byte_bpe,
        "op6_language_id": langid.op6_language_id,
        "op7_chat_format": chat.op7_chat_format,
        "op8_mixing": mixing.op8_mixing,
        "op9_quality_rules": quality.op9_quality_rules,
        "op10_simhash": simhash.op10_simhash,
        "op11_hard_negatives": hardnegatives.op11_hard_negatives,
        "op12_secrets": secrets.op12_secrets,
        "op13_lexical_search": lexical.op13_lexical_search,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_url_lists": urllists.OP2_SQL,
        "op7_chat_format": chat.OP7_SQL,
        "op8_mixing": mixing.OP8_SQL,
        "op9_quality_rules": quality.OP9_SQL,
        "op11_hard_negatives": hardnegatives.OP11_SQL,
        "op13_lexical_search": lexical.OP13_SQL,
    }
