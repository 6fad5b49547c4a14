"""The daily run: ingest landed files, load subscriptions, build the warehouse, check it.

Mirrors the scheduled jobs: CSV exports are truncated and reloaded into
the raw layer, the subscription export is merged into its raw table, the
marts are rebuilt (full refresh by default, incremental on request) and
the data-check suite is written as a table next to the marts.  Failing
checks are reported, not raised (as the scheduled test step reports).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from qualis.lazy import lazy
from qualis.plans import checks, warehouse
from qualis.plans.ingest import SUBSCRIPTIONS, ingest_csv_tables, load_subscriptions
from qualis.sources.csv_source import LANDED_FILES
from qualis.sources.json_source import read_json_documents, read_json_lines
from qualis.sources.layers import Warehouse

CHECKS_TABLE = "data_checks"


def run_daily(spark: SparkSession, landing_dir: str, root: str, subscriptions_path: str | None = None,
              full_refresh: bool = True, legacy_json: bool = True, json_lines: bool = False) -> dict:
    raw = Warehouse(spark, root, "raw")
    loaded = ingest_csv_tables(spark, landing_dir, raw)
    if subscriptions_path:
        batch = (read_json_lines(spark, subscriptions_path) if json_lines
                 else read_json_documents(spark, subscriptions_path, legacy=legacy_json))
        loaded[SUBSCRIPTIONS] = load_subscriptions(batch, raw)
    tables = lazy([t for t in list(LANDED_FILES) + [SUBSCRIPTIONS] if raw.exists(t)], raw.read)
    dw = raw.at("dw")
    built = warehouse.run(tables, dw, full_refresh=full_refresh, prints=raw.fingerprints(LANDED_FILES))
    marts = lazy(warehouse.DIMENSIONS + warehouse.FACTS, dw.read)
    dim_rows = {n: dw.read(n).count() for n in warehouse.DIMENSIONS}
    dw.write(CHECKS_TABLE, checks.check_suite(marts, dim_rows))
    failing = (dw.read(CHECKS_TABLE).filter("failures > 0")
               .select("table_name", "check_name", "column_name", "failures").collect())  # <= 30 rows
    return {"loaded": loaded, "built": built,
            "failing_checks": [tuple(r) for r in failing]}
