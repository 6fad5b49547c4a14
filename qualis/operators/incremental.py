"""Incremental-load operators: high-water mark, new-key load, keyed upsert, column sync.

All are lazy DataFrame plans.  Scalars about the target (its maximum
time, whether it is empty or holds a NULL key) are uncorrelated scalar
subqueries (``DataFrame.scalar()``), evaluated once per query on the
executors; no row of either table passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from qualis.functions.keys import packed
from qualis.functions.times import EMPTY_WATERMARK_TS, ts_literal
from qualis.operators.lookup import broadcastable


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def watermark(target: DataFrame, ts_col: str = "updated_at") -> Column:
    """``IFNULL(MAX(target.ts), '1900-01-01')`` as a scalar-subquery column."""
    return target.agg(F.coalesce(F.max(ts_col), ts_literal(EMPTY_WATERMARK_TS))).scalar()


def since_watermark(source: DataFrame, target: DataFrame, ts_col: str = "updated_at",
                    source_ts: Column | str | None = None, mark: str | None = None) -> DataFrame:
    """Rows of ``source`` strictly newer than the target's high-water mark.

    Rows equal to the mark are skipped, rows older are lost and a NULL
    time never passes (three-valued ``>``).  ``mark`` is the target's
    maximum as recorded when it was written (``""``: no time at all); it
    replaces the scan of the target's time column.
    """
    ts = _c(source_ts) if source_ts is not None else F.col(ts_col)
    if mark is not None:
        return source.filter(ts > ts_literal(mark or EMPTY_WATERMARK_TS))
    return source.filter(ts > watermark(target, ts_col))


def only_new_keys(source: DataFrame, target: DataFrame, source_key: Column | str,
                  target_key: Column | str | None = None) -> DataFrame:
    """``WHERE key NOT IN (SELECT key FROM target)`` with SQL NULL semantics.

    Empty target: every row passes, NULL keys included.  Target holding a
    NULL key: nothing passes.  Otherwise rows with a non-NULL key absent
    from the target pass.  Runs as a plain (shuffle or AQE-broadcast)
    left anti join plus a scalar mode, never as a nested-loop join.  Rows
    with a NULL key go past the join, so they never meet in one task.
    """
    skey = _c(source_key)
    tkey = _c(target_key if target_key is not None else source_key)
    tk = target.select(tkey.alias("__nk"))
    n_all, n_key = F.count(F.lit(1)), F.count("__nk")
    mode = tk.agg(F.when(n_all == 0, F.lit(0)).when(n_key < n_all, F.lit(1)).otherwise(F.lit(2))).scalar()
    cols = source.columns
    rows = source.withColumn("__nk", skey)
    keyed, unkeyed = rows.filter(F.col("__nk").isNotNull()), rows.filter(F.col("__nk").isNull())
    kept = keyed.join(tk.filter(F.col("__nk").isNotNull()), "__nk", "left_anti").filter(mode != 1)
    return kept.select(*cols).unionByName(unkeyed.filter(mode == 0).select(*cols))


class StoredKeys:
    """A warehouse table as the target of a new-key load: its writes know its null keys, its parts have key filters."""

    #: A source of more than this share of the table's rows is compared with all keys at once.
    FILTER_SHARE = 0.25

    def __init__(self, warehouse, table: str, key: str):
        self.warehouse, self.table, self.key = warehouse, table, key

    def only_new(self, source: DataFrame, key: Column) -> DataFrame:
        """As ``only_new_keys`` with ``key`` against the table's key column.

        Whether the table is empty or holds a NULL key is known without a
        scan.  A source that is small beside the table is compared with the
        parts that may hold one of its keys, by their key filters.
        """
        rows, nulls = self.warehouse.rows(self.table), self.warehouse.null_keys(self.table, self.key)
        if nulls is None:
            return only_new_keys(source, self.warehouse.read(self.table), key, self.key)
        if rows == 0:
            return source
        if nulls:
            return source.filter(F.lit(False))
        keyed = source.filter(key.isNotNull())
        n = source.count()
        if n <= self.FILTER_SHARE * rows:
            held = self.warehouse.held_keys(self.table, keyed.select(key.alias(self.key)).distinct(), self.key, broadcastable(n))
        else:
            held = self.warehouse.read(self.table, columns=[self.key])
        held = held.select(F.col(self.key).alias("__held"))
        if keyed.select(key).schema[0].dataType == StringType():
            key, held = packed(key), held.select(packed("__held").alias("__held"))
        # the key is an expression of the join, not a column: a shuffle carries the rows without it
        return keyed.join(held, key == F.col("__held"), "left_anti")


def new_rows_only(source: DataFrame, target, source_key: Column, target_key: Column | None, stored_key: Column) -> DataFrame:
    """New-key load against a DataFrame (by its natural key) or a stored table (by its key column)."""
    if isinstance(target, StoredKeys):
        return target.only_new(source, stored_key)
    return only_new_keys(source, target, source_key, target_key)


def upsert(target: DataFrame, new_rows: DataFrame, key: str, check_duplicates: bool = True,
           new_rows_count: int | None = None) -> DataFrame:
    """Keyed merge: a matched target row is replaced, other new rows are inserted.

    The target first takes the new rows' columns (``sync_columns``).
    NULL keys never match, so they are inserted every time (as in MERGE).
    Two new rows matching one target row are an error.  With
    ``check_duplicates`` the plan carries that check lazily: a scalar
    subquery counts such keys (an aggregate over the new rows semi-joined
    to the target) and any row of the result raises if it is non-zero.

    ``new_rows_count`` (measured) lets a small batch's keys be broadcast:
    the target, usually far larger, is then read once map-side and never
    shuffled to replace a few rows.
    """
    target = sync_columns(target, new_rows.schema)
    small = broadcastable(new_rows_count)
    guard = None
    if check_duplicates:
        dup_keys = (new_rows.filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1")
                    .select(key))
        if small:
            dup = target.select(key).join(F.broadcast(dup_keys), key).select(key).distinct()
        else:
            dup = dup_keys.join(target.select(key), key, "left_semi")
        n_dup = dup.agg(F.count(F.lit(1))).scalar()
        guard = F.when(n_dup > 0, F.raise_error(
            F.lit(f"upsert: several new rows match one target row on {key}"))).otherwise(F.lit(True))
    keys = new_rows.select(key).filter(F.col(key).isNotNull())
    if small:
        keys = F.broadcast(keys)
    kept = target.join(keys, key, "left_anti")
    out = kept.unionByName(new_rows)
    return out if guard is None else out.filter(guard)


def sync_columns(target: DataFrame, source_schema) -> DataFrame:
    """``on_schema_change='sync_all_columns'``: the target takes the source's columns.

    Columns new in the source appear as typed NULLs for existing rows;
    columns absent from the source are dropped; a column whose type changed
    is cast to the source's type (a value that the cast cannot hold is an
    error).  Column order follows the source.
    """
    have = {f.name: f.dataType for f in target.schema.fields}

    def column(f) -> Column:
        if f.name not in have:
            return F.lit(None).cast(f.dataType).alias(f.name)
        return F.col(f.name) if have[f.name] == f.dataType else F.col(f.name).cast(f.dataType).alias(f.name)
    return target.select(*[column(f) for f in source_schema.fields])
