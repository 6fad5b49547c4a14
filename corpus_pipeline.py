"""From documents to packed training sequences: filter, dedup, mix and pack.

Each stage takes (spark, docs, sf_dir) and works on all rows its
predecessor kept; columns of any other name stay as they are (see
``qualis.llm.stages``).  ``run`` writes every stage's rows as a table in the
shared folder, so a lost executor costs that stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qualis.llm import mixing, packing, stages  # noqa: F401
from qualis.llm.common import saved, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned decision list reject.

    Null and empty texts are rejected, repeated rows judged alike, null ids
    judged like others; an empty table gives no rows; extra columns are kept.
    """
    return stages.quality_stage(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier line; n_chars, where there is one, follows the text.

    Documents left without words go, null texts too; rows that agree in id
    and text keep the same lines; an empty table gives no rows; extra columns
    are kept.
    """
    return stages.line_stage(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate class: of the smallest id (null only if all are) the text of the smallest hash.

    Of repeated rows one stays, the null and empty texts are one class; an
    empty table gives no rows; extra columns are kept.
    """
    return stages.near_stage(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it.

    Documents without words go; the null source is a source; like rows share
    their copies evenly; an empty table gives no rows; extra columns are kept.
    """
    return stages.mixing_stage(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of 2048; null texts are id 1 alone, repeated rows are packed each, an empty table gives no rows."""
    import public_tokenizers

    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "segment")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]

#: The learned rules, the signatures, the pivotal choice and the packing are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
