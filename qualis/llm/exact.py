"""Exact deduplication over a sharded cuckoo index of live digests.

Digests are dealt to shards by their own bits.  A task first merges the
digests of the rows it scans (so a text with very many copies reaches its
shard once per task, not once per row); each shard then inserts them into
its cuckoo index, where a verified hit merges with the live entry and a miss
adds one.  The index can be kept as a table, one row per shard, and take
later insertions and deletions.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualis.llm.common import id_and_text, table
from qualis.llm.cuckoo import CuckooIndex

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Digests a task merges before it passes them on.
MERGE_ROWS = 200_000
GROUPS = pa.schema([("digest", pa.binary()), ("keep_id", pa.int64()), ("group_size", pa.int64())])


def normalised(text: Column) -> Column:
    """Texts are equal when identical after lower-casing A-Z only."""
    return F.translate(text, UPPER, LOWER)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return id_and_text(docs, id_col, text_col).select("doc_id", F.unhex(F.sha2(F.encode(normalised(F.col("text")), "UTF-8"), 256)).alias("digest"))


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def _larger(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else max(a, b)


def _batch(items: list[tuple]) -> pa.RecordBatch:
    columns = zip(*items) if items else ([],) * len(GROUPS)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, GROUPS.types)], schema=GROUPS)


def _merge_scanned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, digest) rows to one row per digest and stretch of the scan."""
    seen: dict[bytes, tuple] = {}
    for doc_id, digest in _rows(batches):
        keep, n = seen.get(digest, (None, 0))
        seen[digest] = _larger(keep, doc_id), n + 1
        if len(seen) >= MERGE_ROWS:
            yield _batch([(d, *v) for d, v in seen.items()])
            seen.clear()
    yield _batch([(d, *v) for d, v in seen.items()])


def _into_index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard: insert every digest into its cuckoo index; hits merge with the live entry."""
    index = CuckooIndex()
    for digest, keep_id, n in _rows(batches):
        live = index.get(digest)
        index.put(digest, (keep_id, n) if live is None else (_larger(live[0], keep_id), live[1] + n))
    found = [(d, *v) for d, v in index.items()]
    for i in range(0, len(found), 50_000):
        yield _batch(found[i:i + 50_000])


def groups(rows: DataFrame) -> DataFrame:
    """(doc_id, digest) rows to one row per digest: keep_id (the largest id) and group_size."""
    kind = "digest binary, keep_id long, group_size long"
    shards = rows.select("doc_id", "digest").mapInArrow(_merge_scanned, kind).repartition("digest")
    return shards.mapInArrow(_into_index, kind)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of texts that are equal after lower-casing A-Z, the row with the largest
    id stays.  A null text is an empty text.  A null id is smaller than any
    other; rows that share both text and id are one document listed several
    times, so they are kept or dropped together.  An empty table gives no
    rows.
    """
    rows = digests(docs, id_col, text_col)
    labelled = rows.join(groups(rows), "digest")  # a hot digest's rows are split by AQE
    return labelled.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                           F.lower(F.hex("digest")).alias("text_sha256"))


def build_index(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index as a table: shard, entries, state.  Choose shards so that a shard's digests fit a task."""
    empty = docs.sparkSession.createDataFrame([], "shard int, entries long, state binary")
    return update_index(empty, digests(docs, id_col, text_col).withColumn("live", F.lit(True)), shards)


def update_index(index: DataFrame, changes: DataFrame, shards: int) -> DataFrame:
    """Apply changes (doc_id, digest, live) to an index table of the same number of shards.

    live = true inserts the document, false deletes it: its digest goes when
    its last document does.  Documents of a digest are counted, and the
    largest live id is not known after deletions, so keep_id is the largest
    id ever inserted since the digest last came alive.  Deletions of digests
    that are not live have no effect; within one call, insertions come first.
    """
    per_digest = changes.groupBy("digest").agg(F.max(F.when(F.col("live"), F.col("doc_id"))).alias("keep_id"),
                                               F.count_if("live").alias("added"), F.count_if(~F.col("live")).alias("removed"))
    keyed = per_digest.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int"))

    def apply(old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        shard = int((new if len(new) else old)["shard"].iloc[0])
        index = CuckooIndex.load(old["state"].iloc[0]) if len(old) else CuckooIndex()
        for digest, keep_id, added, removed in zip(new["digest"], new["keep_id"], new["added"], new["removed"]):
            digest, keep_id = bytes(digest), None if pd.isna(keep_id) else int(keep_id)
            live = index.get(digest)
            n = int(added) - int(removed) + (live[1] if live else 0)
            if n > 0:
                index.put(digest, (_larger(live[0], keep_id) if live else keep_id, n))
            elif live:
                index.delete(digest)
        return pd.DataFrame({"shard": [shard], "entries": [index.n], "state": [index.dump()]})

    kind = "shard int, entries long, state binary"
    return index.groupBy("shard").cogroup(keyed.groupBy("shard")).applyInPandas(apply, kind)


def lookup(index: DataFrame, rows: DataFrame, shards: int) -> DataFrame:
    """The live entry of each distinct digest of ``rows`` (digest): digest, keep_id, group_size; none if not live."""
    keyed = rows.select("digest").distinct().withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int"))

    def find(old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        index = CuckooIndex.load(old["state"].iloc[0]) if len(old) else CuckooIndex()
        hits = [(bytes(d), *v) for d in new["digest"] if (v := index.get(bytes(d))) is not None]
        return pd.DataFrame(hits, columns=["digest", "keep_id", "group_size"]).astype({"keep_id": "Int64", "group_size": "Int64"})

    return index.groupBy("shard").cogroup(keyed.groupBy("shard")).applyInPandas(find, "digest binary, keep_id long, group_size long")


def query(spark, sf_dir: str) -> DataFrame:
    """op3: all documents, whole texts."""
    return dedup(table(spark, sf_dir, "documents"))


ORACLE = """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, text_sha256
FROM t WINDOW same AS (PARTITION BY text_sha256)
"""
