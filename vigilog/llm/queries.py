"""The operators' registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vigilog.llm import audit, language, licences, mixing, pieces, privacy, quality, repetition, secrets, sharding, simhash, vectors, whitening

Query = Callable[[SparkSession, str], DataFrame]


def all_queries() -> dict[str, Query]:
    return {
        "op1_quality": quality.query,
        "op2_pii": privacy.query,
        "op3_vectors": vectors.query,
        "op4_repetition": repetition.query,
        "op5_secrets": secrets.query,
        "op6_sharding": sharding.query,
        "op7_simhash": simhash.query,
        "op8_sentencepiece": pieces.query,
        "op9_language_id": language.query,
        "op10_mixing": mixing.query,
        "op11_whitening": whitening.query,
        "op12_licences": licences.query,
        "op13_audit": audit.query,
    }


def checks() -> dict[str, str]:
    """SQL checks; operators that SQL cannot express are tested against brute force."""
    return {
        "op3_vectors": vectors.oracle(),
        "op4_repetition": repetition.oracle(),
        "op5_secrets": secrets.oracle(),
        "op6_sharding": sharding.oracle(),
        "op10_mixing": mixing.oracle(),
        "op12_licences": licences.oracle(),
        "op13_audit": audit.oracle(),
    }
