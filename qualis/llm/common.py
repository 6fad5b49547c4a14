"""Helpers the operators share: input columns, words, row blocks, shared storage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qualis.session import scratch_dir

#: A word is a maximal run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a few longs that a partition of a small table holds.
ROWS_A_PARTITION = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, under fixed names; a null text is empty.

    Selecting first keeps any other column of ``docs`` (whatever its name)
    out of the operator and out of the scan.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(docs, text_col).alias("text"))


def text_of(docs: DataFrame, text_col: str = "text") -> Column:
    return F.coalesce(docs[text_col].cast("string"), F.lit(""))


def few(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of at most about ``rows`` short rows, in no more partitions than they need.

    A step over a small table then neither starts a task nor leaves a shuffle file per shuffle partition.
    """
    return df.coalesce(rows // ROWS_A_PARTITION + 1)


def checkpointed(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Cut the lineage in the folder that ``spark.checkpoint.dir`` names (shared, survives executors).

    ``rows``: about how many short rows there are at most; few rows get few partitions.
    """
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or scratch_dir(spark, "checkpoints"))
    return (df if rows is None else few(df, rows)).checkpoint(eager=True)


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: compact, read back with column pruning."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a batch that are Python objects at a time, besides the block being gathered.
SLICE = 64


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut to SLICE rows; memory that Arrow no longer needs is given back in between."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            yield batch.slice(start, SLICE)
        del batch
        pa.default_memory_pool().release_unused()


def blocks(batches: Iterable[pa.RecordBatch], size_col: str = "text", max_chars: int = 2_000_000) -> Iterator[dict[str, list]]:
    """Arrow batches as column lists of about ``max_chars`` of text (by whole slices of rows)."""
    columns: dict[str, list] = {}
    chars = 0
    for part in slices(batches):
        own = {n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)}
        size = sum(map(len, own[size_col]))
        if columns and chars + size > max_chars:
            yield columns
            columns, chars = {}, 0
        columns = {n: columns.get(n, []) + v for n, v in own.items()}
        chars += size
    if columns:
        yield columns
