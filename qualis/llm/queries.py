"""Registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from qualis.llm import align, chunks, exact, linededup, lmscore, mixing, neardup, packing, piecebpe, pseudonyms, quality, search, secrets

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": packing.query,
    "op2_secrets": secrets.query,
    "op3_exact_dedup": exact.query,
    "op4_line_dedup": linededup.query,
    "op5_quality": quality.query,
    "op6_pseudonyms": pseudonyms.query,
    "op7_near_dedup": neardup.query,
    "op8_mixing": mixing.query,
    "op9_lm_scores": lmscore.query,
    "op10_substring_dedup": chunks.query,
    "op11_alignment": align.query,
    "op12_sentencepiece": piecebpe.query,
    "op13_search": search.query,
}

ORACLES: dict[str, str] = {
    "op2_secrets": secrets.ORACLE,
    "op3_exact_dedup": exact.ORACLE,
    "op4_line_dedup": linededup.ORACLE,
    "op13_search": search.ORACLE,
}
