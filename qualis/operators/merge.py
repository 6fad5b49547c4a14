"""Keyed, change-conditional MERGE of a source batch into a target table.

Semantics of ``MERGE T USING S ON T.k = S.k WHEN MATCHED AND <changed>
THEN UPDATE SET <all but keep columns> WHEN NOT MATCHED THEN INSERT``:

* matched and changed: every column except the key and ``keep`` columns
  takes the source value;
* matched and not changed: the target row stays;
* source rows without a target row: inserted (NULL keys never match, so
  they are always inserted, duplicates included);
* target rows without a source row: kept;
* "changed" is ``a <> b OR ...`` under three-valued logic: a NULL on
  either side is not a change;
* two source rows updating one target row: an error (checked lazily);
  several target rows of one key are each updated.

The target's key, change and keep columns are joined once with the
batch's keys and change columns.  That table of matches (about as many
rows as the batch) is cut off by a checkpoint and says all the rest:
which target rows go, which source rows replace them, which are new.
The target is then read once as a whole and loses the rows that are
replaced; no other column of the batch is ever broadcast.  NULL keys can
never match, so NULL-key rows bypass the joins entirely; a NULL key
holding a third of a batch therefore never lands in one join task.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualis.session import materialize

# Rows of a batch up to which its keys are broadcast.  A merge broadcasts four
# tables of up to so many rows, and the driver holds each as hashed rows and
# as what it sends, some 300 bytes a row.
BATCH_BROADCAST_MAX_ROWS = 100_000


def _all(conditions):
    return reduce(lambda a, b: a & b, conditions)


@dataclass(frozen=True)
class Merge:
    """What a batch does to a target.

    ``changed``: per target row that changes its key, change and keep columns
    (``__t_*``, ``__keep_*``); ``updated``: the rows that take their places;
    ``inserted``: new rows; ``stays(rows)``: those of some target rows that
    stay; ``guard``: a condition that raises if two source rows update one
    target row.
    """

    changed: DataFrame
    updated: DataFrame
    inserted: DataFrame
    stays: Callable[[DataFrame], DataFrame]
    guard: Column


def plan_merge(target: DataFrame, source: DataFrame, key: str, change_cols: tuple[str, ...],
               keep_cols: tuple[str, ...] = (), source_rows: int | None = None) -> Merge:
    """See the module docstring.  ``source_rows`` (measured) lets the keys
    and change columns of a small batch be broadcast, so the target is read
    map-side and never shuffled.  Those of a larger batch, or of one that was
    not measured, are joined by sorting: AQE would broadcast them by their
    compressed bytes, and many times as many meet on the driver."""
    cols = target.columns
    source = source.select(*cols)
    small = source_rows is not None and source_rows <= BATCH_BROADCAST_MAX_ROWS

    def side(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if small else df.hint("merge")

    s_keyed = source.filter(F.col(key).isNotNull())
    # what decides: one row per key and change columns of the batch, with its number of rows
    deciding = s_keyed.groupBy(F.col(key).alias("__k"), *[F.col(c).alias(f"__s_{c}") for c in change_cols]).agg(
        F.count(F.lit(1)).alias("__n"))
    narrow = target.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("__tk"), *[F.col(c).alias(f"__t_{c}") for c in change_cols],
        *[F.col(c).alias(f"__keep_{c}") for c in keep_cols])
    differs = reduce(lambda a, b: a | b, [F.col(f"__t_{c}") != F.col(f"__s_{c}") for c in change_cols])
    matches = materialize(narrow.join(side(deciding), F.col("__tk") == F.col("__k")).drop("__tk")
                          .withColumn("__changed", F.coalesce(differs, F.lit(False))))
    changed = matches.filter("__changed")

    t_state = ["__k", *[f"__t_{c}" for c in change_cols]]
    s_state = [f"__s_{c}" for c in change_cols]
    # source rows that would update a target row in the same state
    updates = changed.groupBy(*t_state, *s_state).agg(F.max("__n").alias("__n")).groupBy(*t_state).agg(
        F.sum("__n").alias("__n"))
    n_multi = updates.filter("__n > 1").agg(F.count(F.lit(1))).scalar()
    guard = F.when(n_multi > 0, F.raise_error(
        F.lit(f"merge: several source rows update one target row on {key}"))).otherwise(F.lit(True))

    replaced = changed.select(*t_state).distinct()

    def stays(rows: DataFrame) -> DataFrame:
        keyed = rows.filter(F.col(key).isNotNull()).join(
            side(replaced), _all([F.col(key) == F.col("__k"),
                                  *[F.col(c).eqNullSafe(F.col(f"__t_{c}")) for c in change_cols]]), "left_anti")
        return keyed.unionByName(rows.filter(F.col(key).isNull()))

    updated = s_keyed.join(
        side(changed.select("__k", *s_state, *[f"__keep_{c}" for c in keep_cols])),
        _all([F.col(key) == F.col("__k"),
              *[F.col(c).eqNullSafe(F.col(f"__s_{c}")) for c in change_cols]])).select(
        *[F.col(f"__keep_{c}").alias(c) if c in keep_cols else F.col(c) for c in cols])
    existing = matches.select("__k").distinct()
    inserted = s_keyed.join(side(existing), F.col(key) == F.col("__k"), "left_anti").unionByName(source.filter(F.col(key).isNull()))
    return Merge(changed, updated, inserted, stays, guard)


def merge_when_changed(target: DataFrame, source: DataFrame, key: str,
                       change_cols: tuple[str, ...], keep_cols: tuple[str, ...] = (),
                       source_rows: int | None = None) -> DataFrame:
    """The whole target after the MERGE."""
    m = plan_merge(target, source, key, change_cols, keep_cols, source_rows)
    return m.stays(target).unionByName(m.updated).unionByName(m.inserted).filter(m.guard)


# The subscription export's merge key, change columns and
# the columns an update never touches.
SUBSCRIPTION_KEY = "subscription_id"
SUBSCRIPTION_CHANGE_COLUMNS = ("subscription_updated_at", "customer_updated_at")
SUBSCRIPTION_KEEP_COLUMNS = ("dt_customer_signup_date",)


def merge_subscriptions(target: DataFrame, source: DataFrame, source_rows: int | None = None) -> DataFrame:
    return merge_when_changed(target, source, SUBSCRIPTION_KEY, SUBSCRIPTION_CHANGE_COLUMNS,
                              SUBSCRIPTION_KEEP_COLUMNS, source_rows)
