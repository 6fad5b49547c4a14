"""Benchmark at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints ONE JSON line.

Stages follow the production pipeline: the raw layer is ingested once
(projections of the driver tables written as parquet), the warehouse is
built from it (full refresh, then an incremental run), and the dashboard
metrics and the data-check suite read the written marts.  A few
registered queries are also timed end to end from the driver tables.

Queries run fully through the ``noop`` sink (no driver collect) on a warm
JVM; times are medians of $BENCH_REPEATS runs (stages run once).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from qualis.catalog import QUERIES  # noqa: E402
from qualis.lazy import lazy  # noqa: E402
from qualis.operators.merge import merge_subscriptions  # noqa: E402
from qualis.plans import checks, metrics, relations, warehouse  # noqa: E402
from qualis.session import build_session, scratch_dir  # noqa: E402
from qualis.sources.fixtures import SOURCES, merge_source, merge_target, raw_table  # noqa: E402
from qualis.sources.layers import Warehouse  # noqa: E402

E2E = ("weighted_score", "fact_manual_reviews", "subs_merge", "incr_fact_autoqa_reviews")


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    spark = build_session(f"local[{cpus}]", int(cpus) * 2, "qualis-bench", extra)
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="qualis-bench-ckpt-"))
    times: dict[str, float] = {}

    def stage(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    def query(name, make):
        runs = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            _run(make())
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)

    _run(QUERIES["weighted_score"](spark, sf_dir))  # warm-up

    root = scratch_dir(spark, "bench")
    raw_wh, dw = Warehouse(spark, root, "raw"), Warehouse(spark, root, "dw")
    stage("ingest_raw", lambda: raw_wh.write_many(lazy(SOURCES, lambda t: raw_table(spark, sf_dir, t)), SOURCES, 7))
    raw = lazy(SOURCES, raw_wh.read)
    stage("warehouse_build_full", lambda: warehouse.run(raw, dw, full_refresh=True, prints=raw_wh.fingerprints(SOURCES)))
    stage("warehouse_build_incremental", lambda: warehouse.run(lazy(SOURCES, raw_wh.read), dw, full_refresh=False,
                                                                 prints=raw_wh.fingerprints(SOURCES)))

    names = warehouse.DIMENSIONS + warehouse.FACTS + warehouse.FLAT
    marts = lazy(names, dw.read)
    dim_rows = {n: dw.read(n).count() for n in warehouse.DIMENSIONS}

    query("weighted_score", lambda: metrics.weighted_score(raw_wh.read("manual_rating")))
    query("avg_score_per_ticket", lambda: metrics.avg_score_per_ticket(raw_wh.read("autoqa_ratings")))
    query("ticket_scores_auto_vs_manual", lambda: metrics.ticket_scores_auto_vs_manual(
        raw_wh.read("autoqa_ratings"), raw_wh.read("manual_reviews")))
    query("reviewer_performance", lambda: metrics.reviewer_performance(marts["fact_manual_reviews"]))
    query("root_cause_breakdown", lambda: metrics.root_cause_breakdown(
        marts["fact_autoqa_root_cause"], marts["fact_autoqa_ratings"]))
    query("score_by_month", lambda: metrics.score_series(
        marts["fact_manual_reviews"], marts["fact_autoqa_ratings"], marts["fact_autoqa_reviews"], "month"))
    query("score_by_week", lambda: metrics.score_series(
        marts["fact_manual_reviews"], marts["fact_autoqa_ratings"], marts["fact_autoqa_reviews"], "week"))
    query("top_agents", lambda: metrics.top_agents(marts["fact_manual_reviews"]))
    query("top_root_causes", lambda: metrics.top_root_causes(marts["fact_autoqa_root_cause"]))
    query("star_root_cause_drill", lambda: relations.root_cause_drill(
        marts["fact_autoqa_root_cause"], marts["fact_autoqa_ratings"], marts["fact_autoqa_reviews"]))
    query("avg_score_per_reviewee", lambda: metrics.avg_score_per_reviewee(raw_wh.read("manual_reviews")))
    query("root_cause_heatmap", lambda: metrics.root_cause_heatmap(marts["fact_autoqa_root_cause"]))
    query("check_suite", lambda: checks.check_suite(marts, dim_rows))
    subs = raw_wh.read("customer_subscriptions")
    n_source = merge_source(subs).count()  # loads measure their batch
    query("subs_merge_raw", lambda: merge_subscriptions(merge_target(subs), merge_source(subs), n_source))
    for name in E2E:
        query(f"e2e_{name}", lambda name=name: QUERIES[name](spark, sf_dir))

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "pipeline_and_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": int(cpus), "repeats": repeats, "spark": spark.version,
        "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
