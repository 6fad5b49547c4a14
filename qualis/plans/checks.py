"""Data checks on the marts: not_null, unique, relationships.

Each check yields one row ``(table_name, check_name, column_name,
failures)``; the suite is their union (30 rows).  In the suite, the
not-null checks of a table, its relationships to parents of measured
small size and its uniqueness fold into a single scan, grouped by the
unique key (partially before the shuffle); a relationship to any other
parent is one left anti join of the non-NULL child keys against the
parent keys.
Only counts leave the executors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualis.operators.lookup import broadcastable

# The declared checks of the marts.
NOT_NULL = (
    ("dim_team", "team_key"), ("dim_payment", "payment_key"), ("dim_user", "user_key"),
    ("dim_rating_category", "rating_category_key"), ("fact_autoqa_reviews", "autoqa_review_key"),
    ("fact_autoqa_ratings", "autoqa_rating_key"), ("fact_autoqa_root_cause", "autoqa_root_cause_key"),
    ("fact_manual_reviews", "manual_review_key"), ("fact_manual_ratings", "manual_rating_key"),
    ("fact_conversations", "conversation_key"),
)
UNIQUE = NOT_NULL[:-1]
RELATIONSHIPS = (
    ("fact_autoqa_reviews", "payment_key", "dim_payment", "payment_key"),
    ("fact_autoqa_reviews", "team_key", "dim_team", "team_key"),
    ("fact_autoqa_reviews", "reviewee_key", "dim_user", "user_key"),
    ("fact_autoqa_ratings", "rating_category_key", "dim_rating_category", "rating_category_key"),
    ("fact_manual_reviews", "payment_key", "dim_payment", "payment_key"),
    ("fact_manual_reviews", "team_key", "dim_team", "team_key"),
    ("fact_manual_reviews", "reviewer_key", "dim_user", "user_key"),
    ("fact_manual_reviews", "reviewee_key", "dim_user", "user_key"),
    ("fact_manual_ratings", "rating_category_key", "dim_rating_category", "rating_category_key"),
    ("fact_conversations", "payment_key", "dim_payment", "payment_key"),
    ("fact_conversations", "assignee_key", "dim_user", "user_key"),
)


def _row(df: DataFrame, table: str, check: str, column: str, failures) -> DataFrame:
    return df.agg(failures.cast("bigint").alias("failures")).select(
        F.lit(table).alias("table_name"), F.lit(check).alias("check_name"),
        F.lit(column).alias("column_name"), "failures")


def not_null_checks(marts: dict[str, DataFrame]) -> DataFrame:
    by_table: dict[str, list[str]] = {}
    for table, column in NOT_NULL:
        by_table.setdefault(table, []).append(column)
    parts = []
    for table, columns in by_table.items():
        counts = marts[table].agg(*[
            F.count(F.when(F.col(c).isNull(), 1)).cast("bigint").alias(c) for c in columns])
        stacked = counts.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in columns])).alias("r"))
        parts.append(stacked.select(F.lit(table).alias("table_name"), F.lit("not_null").alias("check_name"),
                                    "r.column_name", "r.failures"))
    return reduce(DataFrame.unionByName, parts)


def unique_checks(marts: dict[str, DataFrame]) -> DataFrame:
    parts = []
    for table, column in UNIQUE:
        dup = (marts[table].filter(F.col(column).isNotNull()).groupBy(column).count()
               .filter(F.col("count") > 1))
        parts.append(_row(dup, table, "unique", column, F.count(F.lit(1))))
    return reduce(DataFrame.unionByName, parts)


def relationship_checks(marts: dict[str, DataFrame], parent_rows: dict[str, int] | None = None,
                        relationships=RELATIONSHIPS) -> DataFrame:
    """Orphan child keys per declared relationship.

    ``parent_rows`` (exact row counts of parent tables, when known) lets a
    small parent be broadcast; otherwise the anti join shuffles both sides.
    """
    parts = []
    rows = parent_rows or {}
    for child, column, parent, field in relationships:
        keys = marts[child].select(F.col(column).alias("__k")).filter(F.col("__k").isNotNull())
        parent_keys = marts[parent].select(F.col(field).alias("__k"))
        if broadcastable(rows.get(parent)):
            parent_keys = F.broadcast(parent_keys)
        orphans = keys.join(parent_keys, "__k", "left_anti")
        parts.append(_row(orphans, child, "relationships", column, F.count(F.lit(1))))
    return reduce(DataFrame.unionByName, parts)


def scan_checks(marts: dict[str, DataFrame], parent_rows: dict[str, int]) -> DataFrame:
    """The not-null, uniqueness and relationship checks of each table by one scan of it.

    Parents of measured small size are broadcast and joined at once, which
    leaves each child row with a flag per relationship; relationships to
    other parents are checked on their own.  A table with a unique key is
    grouped by it, with the failures of a key's rows beside their number, so
    a table that is costly to compute is computed once.
    """
    small = [r for r in RELATIONSHIPS if broadcastable(parent_rows.get(r[2]))]
    unique = dict(UNIQUE)
    parts = []
    for table in dict.fromkeys(t for t, _ in NOT_NULL):
        df, failed = marts[table], []
        for _, column in (c for c in NOT_NULL if c[0] == table):
            failed.append(("not_null", column, F.col(column).isNull()))
        for i, (_, column, parent, field) in enumerate(r for r in small if r[0] == table):
            keys = marts[parent].select(F.col(field).alias(f"__p{i}")).distinct()
            df = df.join(F.broadcast(keys), F.col(column) == F.col(f"__p{i}"), "left")
            failed.append(("relationships", column, F.col(column).isNotNull() & F.col(f"__p{i}").isNull()))
        counts = [F.count(F.when(is_failed, 1)).alias(f"__n{i}") for i, (_, _, is_failed) in enumerate(failed)]
        if table in unique:
            key = unique[table]
            by_key = df.groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__rows"), *counts)
            counts = [F.coalesce(F.sum(f"__n{i}"), F.lit(0)).alias(f"__n{i}") for i in range(len(failed))]
            repeated = F.col("__key").isNotNull() & (F.col("__rows") > 1)
            counts.append(F.count(F.when(repeated, 1)).alias(f"__n{len(failed)}"))
            failed.append(("unique", key, repeated))
            df = by_key
        parts.append(df.agg(*counts).select(F.inline(F.array(*[
            F.struct(F.lit(table).alias("table_name"), F.lit(check).alias("check_name"),
                     F.lit(column).alias("column_name"), F.col(f"__n{i}").alias("failures"))
            for i, (check, column, _) in enumerate(failed)]))))
    if len(small) < len(RELATIONSHIPS):
        parts.append(relationship_checks(marts, parent_rows, [r for r in RELATIONSHIPS if r not in small]))
    return reduce(DataFrame.unionByName, parts)


def check_suite(marts: dict[str, DataFrame], parent_rows: dict[str, int] | None = None) -> DataFrame:
    return scan_checks(marts, parent_rows or {})
