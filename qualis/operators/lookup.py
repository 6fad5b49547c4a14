"""Fact-to-dimension lookup (left equi-join, N:1).

``md5(CAST(a AS STRING)) = md5(CAST(b AS STRING))`` holds exactly when
the two text forms are equal, so the lookup joins on the natural id
(``bigint``; an integral float id compares as its integer) and takes
the dimension's key column.  No hash is computed per fact row, the join
key is a fixed-width long, and the predicate is visible to Catalyst.

Broadcast is decided from a *measured* size: a dimension whose exact
row count is known (it was written or checkpointed, and counted) and is
at most ``DIM_BROADCAST_MAX_ROWS`` is broadcast, so the fact is never
shuffled for it.  A dimension of unknown or larger size is joined
without a hint: a shuffle join (AQE may still demote it to a broadcast
at runtime, and splits skewed fact partitions).  A static plan cannot
size an aggregated dimension (its estimate is the size of its inputs),
which is why the count is taken explicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualis.functions.keys import whole_id

# Largest dimension (rows) that is broadcast to every executor.  A row is
# an id plus a 32-character key, about 100 bytes in the hashed relation,
# so the bound keeps a broadcast near 100 MB.
DIM_BROADCAST_MAX_ROWS = 1_000_000


def broadcastable(rows: int | None) -> bool:
    return rows is not None and rows <= DIM_BROADCAST_MAX_ROWS


def lookup(fact: DataFrame, fact_id: str, dim: DataFrame, dim_id: str, dim_key: str,
           out: str | None = None, dim_rows: int | None = None) -> DataFrame:
    """Add ``out`` (default ``dim_key``) = the dimension key of ``fact[fact_id]``, NULL if absent.

    The dimension must be unique on ``dim_id`` (every dimension here is
    grouped by it), so the fact's row count never changes.  Where the join
    shuffles, fact rows without an id go past it, so that they never meet
    in one task.
    """
    out = out or dim_key
    tmp = f"__lk_{out}"
    dtype = fact.schema[fact_id].dataType
    d = dim.select(F.col(dim_id).cast("bigint").alias(tmp), F.col(dim_key).alias(out))
    f = fact.withColumn(tmp, whole_id(fact_id, dtype))
    if broadcastable(dim_rows):
        return f.join(F.broadcast(d), tmp, "left").drop(tmp)
    found = f.filter(F.col(tmp).isNotNull()).join(d, tmp, "left").drop(tmp)
    without = f.filter(F.col(tmp).isNull()).drop(tmp).withColumn(out, F.lit(None).cast(dim.schema[dim_key].dataType))
    return found.unionByName(without)
