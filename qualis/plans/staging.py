"""Staging (silver) models: lazy projections over the raw tables.

Nothing is materialised here; each model is a column list (plus one
filter) that Catalyst folds into the consuming plan, so only the
columns a mart needs are read from the raw parquet files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qualis import schemas
from qualis.lazy import lazy

STAGING_MODELS = {
    "stg_autoqa_ratings": "autoqa_ratings",
    "stg_autoqa_reviews": "autoqa_reviews",
    "stg_autoqa_root_cause": "autoqa_root_cause",
    "stg_conversations": "conversations",
    "stg_customer_subscriptions": "customer_subscriptions",
    "stg_manual_rating": "manual_rating",
    "stg_manual_reviews": "manual_reviews",
}


def stage(raw: dict[str, DataFrame], model: str) -> DataFrame:
    table = STAGING_MODELS[model]
    df = raw[table].select(*schemas.columns(table))
    if model == "stg_autoqa_root_cause":
        df = df.filter(F.col("autoqa_rating_id").isNotNull())
    return df


def staging(raw):
    """All staging models keyed by raw table name (built on first access)."""
    by_table = {table: model for model, table in STAGING_MODELS.items()}
    return lazy(by_table, lambda t: stage(raw, by_table[t]))


def register_views(spark: SparkSession) -> list[str]:
    """``refined.stg_*`` as views over the registered ``raw`` tables (those that exist)."""
    spark.sql("CREATE DATABASE IF NOT EXISTS refined")
    names = []
    for model, table in STAGING_MODELS.items():
        if not spark.catalog.tableExists(f"raw.{table}"):
            continue
        where = " WHERE autoqa_rating_id IS NOT NULL" if model == "stg_autoqa_root_cause" else ""
        columns = ", ".join(f"`{c}`" for c in schemas.columns(table))
        spark.sql(f"CREATE OR REPLACE VIEW refined.{model} AS SELECT {columns} FROM raw.{table}{where}")
        names.append(f"refined.{model}")
    return names
