"""Ingestion into the raw layer: landed CSV exports and the subscription export.

CSV tables are truncated and reloaded (each write is one Spark job per
table).  The subscription export is loaded by keyed MERGE: the first
load creates the table partitioned by signup day (by spans of days where a
deployment bounds FOLDERS); later loads write the days or spans that their
batch changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qualis.lazy import lazy
from qualis.schemas import struct_type
from qualis.session import materialize
from qualis.operators.merge import SUBSCRIPTION_CHANGE_COLUMNS, SUBSCRIPTION_KEY, plan_merge
from qualis.sources.csv_source import LANDED_FILES, read_csv
from qualis.sources.layers import Warehouse, partition_value, span

SUBSCRIPTIONS = "customer_subscriptions"
SIGNUP_DAY = "dt_customer_signup_date"
#: About how many folders a first load makes at most, by spans of days; None: one a signup day, however many there are.
FOLDERS: int | None = None


def ingest_csv_tables(spark: SparkSession, landing_dir: str, raw: Warehouse,
                      files: dict[str, str] | None = None, parallel: int = 6) -> dict[str, int]:
    """Read each landed CSV with its declared schema and overwrite its raw table.

    The tables are independent, so their load jobs run concurrently.
    """
    files = files or LANDED_FILES
    frames = lazy(files, lambda t: read_csv(spark, f"{landing_dir.rstrip('/')}/{files[t]}", t))
    return raw.write_many(frames, files, parallel)


def load_subscriptions(batch: DataFrame, raw: Warehouse) -> int:
    """First load: partitioned create.  Later loads: MERGE into the live version; returns its rows.

    An updated row keeps its signup day, so a batch changes the folders (days
    or spans of days) of the rows that it updates and adds rows to those of
    its new ones.  Only the former are read whole and written again, the
    latter get a further folder, all others are kept by reference.  A batch
    without rows, or that changes nothing, writes nothing; an empty batch
    returns 0.
    """
    if not raw.exists(SUBSCRIPTIONS):
        by = SIGNUP_DAY if FOLDERS is None else span(SIGNUP_DAY, -(-batch.agg(F.count_distinct(SIGNUP_DAY)).first()[0] // FOLDERS))
        return raw.write(SUBSCRIPTIONS, batch, partition_by=by)
    # the batch is materialised and counted: a small daily batch is
    # broadcast into the merge, so the target is never shuffled
    batch = materialize(batch)
    n = batch.count()
    if n == 0:
        return 0
    # declared schema: the partition column's type is not left to inference
    schema = struct_type(SUBSCRIPTIONS)
    folders = next((p.column for p in raw.live(SUBSCRIPTIONS).parts if p.column), SIGNUP_DAY)
    merge = plan_merge(raw.read(SUBSCRIPTIONS, schema), batch, SUBSCRIPTION_KEY, SUBSCRIPTION_CHANGE_COLUMNS, (SIGNUP_DAY,), n)
    kept_days = merge.changed.select(F.col(f"__keep_{SIGNUP_DAY}").alias(SIGNUP_DAY))
    touched = {r[0] for r in kept_days.select(partition_value(folders, kept_days.columns).cast("string")).distinct().collect()}  # at most one per folder
    inserted = materialize(merge.inserted)
    if not touched and inserted.isEmpty():
        return raw.rows(SUBSCRIPTIONS)
    again = merge.stays(raw.values(SUBSCRIPTIONS, folders, touched, schema)).unionByName(merge.updated)
    return raw.replace_values(SUBSCRIPTIONS, again.unionByName(inserted).filter(merge.guard), folders, touched)
