"""Dimension models: date, team, payment, user, rating category.

Each id dimension is one UNION ALL of (id, time) branches over the
staging tables followed by ``groupBy(id).agg(max(time))``.  Spark runs
the aggregate partially on every input partition before the shuffle,
so the shuffle carries at most one row per id per partition, however
skewed the ids.  Where two branches read the same table (reviewer and
reviewee of a manual review) they come from one scan with ``explode``.
The surrogate key is hashed after aggregation: one md5 per member.
``members`` makes all four in one aggregate, with one scan of each table.

Incremental mode (``target`` given) keeps the reference's rules: the
time dimensions only take members newer than the target's high-water
mark, the category dimension only takes ids the target lacks.
"""

from __future__ import annotations

import threading
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qualis.functions.keys import id_key, rounded_id
from qualis.functions.times import SENTINEL_TS, date_key, strict_ts, ts_literal
from qualis.lazy import lazy
from qualis.operators.incremental import new_rows_only, since_watermark
from qualis.session import materialize

# Calendar range of the date dimension and day names by
# day-of-week number (Sunday = 1).
DATE_RANGE = ("2022-01-01", "2030-12-31")
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def _branch(df: DataFrame, id_col, ts=None) -> DataFrame:
    ts_col = strict_ts("updated_at") if ts is None else ts
    return df.select(id_col.alias("id"), ts_col.alias("updated_at"))


def _sentinel() -> F.Column:
    return ts_literal(SENTINEL_TS)


def _latest(branches: list[DataFrame], id_name: str, key_name: str) -> DataFrame:
    union = reduce(DataFrame.unionByName, branches)
    grouped = (union.filter(F.col("id").isNotNull())
               .groupBy("id").agg(F.max("updated_at").alias("updated_at")))
    return grouped.select(id_key("id").alias(key_name), F.col("id").alias(id_name), "updated_at")


def _since(df: DataFrame, target: DataFrame | None, mark: str | None = None) -> DataFrame:
    return df if target is None else since_watermark(df, target, mark=mark)


def dim_team(stg: dict[str, DataFrame], target: DataFrame | None = None, mark: str | None = None) -> DataFrame:
    branches = [
        _branch(stg["autoqa_reviews"], F.col("team_id")),
        _branch(stg["manual_reviews"], F.col("team_id")),
        _branch(stg["manual_rating"], F.col("team_id"), _sentinel()),
    ]
    return _since(_latest(branches, "team_id", "team_key"), target, mark)


def dim_payment(stg: dict[str, DataFrame], target: DataFrame | None = None, mark: str | None = None) -> DataFrame:
    branches = [
        _branch(stg["autoqa_reviews"], F.col("payment_id")),
        _branch(stg["manual_reviews"], F.col("payment_id")),
        _branch(stg["conversations"], F.col("payment_id")),
        _branch(stg["manual_rating"], F.col("payment_id"), _sentinel()),
        _branch(stg["autoqa_ratings"], F.col("payment_id"), _sentinel()),
    ]
    return _since(_latest(branches, "payment_id", "payment_key"), target, mark)


def dim_user(stg: dict[str, DataFrame], target: DataFrame | None = None, mark: str | None = None) -> DataFrame:
    """Users in five roles; float ids round half away from zero."""
    people = stg["manual_reviews"].select(
        F.explode(F.array(rounded_id("reviewee_id"), F.col("reviewer_id").cast("bigint"))).alias("id"),
        strict_ts("updated_at").alias("updated_at"))
    branches = [
        people,
        _branch(stg["conversations"], F.col("assignee_id")),
        _branch(stg["autoqa_reviews"], rounded_id("reviewee_internal_id")),
        _branch(stg["autoqa_ratings"], F.col("reviewee_internal_id").cast("bigint"), _sentinel()),
    ]
    return _since(_latest(branches, "user_id", "user_key"), target, mark)


def dim_rating_category(stg: dict[str, DataFrame], target: DataFrame | None = None, mark=None) -> DataFrame:
    """One row per category id; the name is the least one seen (deterministic ANY_VALUE)."""
    union = stg["autoqa_ratings"].select(
        F.col("rating_category_id").alias("category_id"), F.col("rating_category_name").alias("category_name")
    ).unionByName(stg["manual_rating"].select("category_id", "category_name"))
    dedup = (union.filter(F.col("category_id").isNotNull())
             .groupBy("category_id").agg(F.min("category_name").alias("category_name")))
    if target is not None:
        dedup = new_rows_only(dedup, target, F.col("category_id"), None, F.col("category_id"))
    return dedup.select(id_key("category_id").alias("rating_category_key"), "category_id", "category_name")


def dim_date(spark: SparkSession, start: str = DATE_RANGE[0], end: str = DATE_RANGE[1]) -> DataFrame:
    """Calendar days ``start``..``end`` inclusive with integer key yyyymmdd."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"),
                             F.expr("INTERVAL 1 DAY"))).alias("calendar_date"))
    dow = F.dayofweek("calendar_date").cast("bigint")
    name = F.element_at(F.array(*[F.lit(n) for n in DAY_NAMES]), dow.cast("int"))
    return days.select(
        date_key("calendar_date").alias("date_key"),
        "calendar_date",
        F.year("calendar_date").cast("bigint").alias("year"),
        F.month("calendar_date").cast("bigint").alias("month"),
        F.dayofmonth("calendar_date").cast("bigint").alias("day"),
        dow.alias("day_of_week"),
        name.alias("day_name"),
        F.quarter("calendar_date").cast("bigint").alias("quarter"))


def members(stg: dict[str, DataFrame]) -> DataFrame:
    """Every dimension's members at once: dimension, id, updated_at (latest) and name (least).

    Each staging table is read once: its rows expand to (dimension, id, time,
    name), which one aggregate groups, partially before its one shuffle.
    """
    null_ts, null_name = F.lit(None).cast("timestamp_ntz"), F.lit(None).cast("string")

    def of(dimension: str, id_col, ts=null_ts, name=null_name) -> F.Column:
        return F.struct(F.lit(dimension).alias("dimension"), id_col.cast("bigint").alias("id"), ts.alias("updated_at"), name.alias("name"))

    time, never = strict_ts("updated_at"), _sentinel()
    col = F.col
    roles = {
        "autoqa_reviews": [of("team", col("team_id"), time), of("payment", col("payment_id"), time), of("user", rounded_id("reviewee_internal_id"), time)],
        "manual_reviews": [of("team", col("team_id"), time), of("payment", col("payment_id"), time),
                           of("user", rounded_id("reviewee_id"), time), of("user", col("reviewer_id"), time)],
        "conversations": [of("payment", col("payment_id"), time), of("user", col("assignee_id"), time)],
        "manual_rating": [of("team", col("team_id"), never), of("payment", col("payment_id"), never),
                          of("category", col("category_id"), name=col("category_name"))],
        "autoqa_ratings": [of("payment", col("payment_id"), never), of("user", col("reviewee_internal_id"), never),
                           of("category", col("rating_category_id"), name=col("rating_category_name"))],
    }
    rows = [stg[t].select(F.explode(F.array(*r)).alias("m")).select("m.*") for t, r in roles.items()]
    return (reduce(DataFrame.unionByName, rows).filter(F.col("id").isNotNull())
            .groupBy("dimension", "id").agg(F.max("updated_at").alias("updated_at"), F.min("name").alias("name")))


def _of_members(found: DataFrame, name: str, target, mark: str | None) -> DataFrame:
    """A dimension from ``members``; with ``target`` its new rows only."""
    kind = name.removeprefix("dim_")
    if name == "dim_rating_category":
        rows = found.filter("dimension = 'category'").select(F.col("id").alias("category_id"), F.col("name").alias("category_name"))
        if target is not None:
            rows = new_rows_only(rows, target, F.col("category_id"), None, F.col("category_id"))
        return rows.select(id_key("category_id").alias("rating_category_key"), "category_id", "category_name")
    rows = found.filter(F.col("dimension") == kind).select(id_key("id").alias(f"{kind}_key"), F.col("id").alias(f"{kind}_id"), "updated_at")
    return _since(rows, target, mark)


def dimensions(stg: dict[str, DataFrame], targets: dict[str, DataFrame] | None = None,
               marks: dict[str, str] | None = None, together: bool = False) -> dict[str, DataFrame]:
    """The four id dimensions; with ``targets`` only their new rows.

    ``marks`` are the targets' recorded high-water marks, where known.
    ``together``: all are wanted, so the first access reads every staging
    table once and keeps the members of all of them.
    """
    t, m = targets or {}, marks or {}
    builders = {"dim_team": dim_team, "dim_payment": dim_payment, "dim_user": dim_user,
                "dim_rating_category": dim_rating_category}
    if not together:
        return lazy(builders, lambda n: builders[n](stg, t.get(n), m.get(n)))
    lock, kept = threading.Lock(), []

    def dimension(name: str) -> DataFrame:
        with lock:
            if not kept:
                kept.append(materialize(members(stg)))
        return _of_members(kept[0], name, t.get(name), m.get(name))
    return lazy(builders, dimension)
