"""Registered queries: one callable per operator/model, each (spark, sf_dir) -> DataFrame.

Raw tables are derived lazily from the driver tables of ``sf_dir``
(``qualis.sources.fixtures``); every query runs over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qualis import schemas
from qualis.operators.merge import merge_subscriptions
from qualis.plans import checks, dims, metrics, relations, warehouse
from qualis.plans.ingest import SUBSCRIPTIONS, ingest_csv_tables, load_subscriptions
from qualis.plans.running import Running
from qualis.plans.staging import stage, staging
from qualis.session import kept, materialize, release, scratch_dir
from qualis.sources.csv_source import LANDED_FILES, read_csv
from qualis.sources.fixtures import first_batch, merge_source, merge_target, raw_table, raw_tables
from qualis.sources.json_source import read_json_documents, write_documents
from qualis.sources.layers import Warehouse
from qualis.sources.split import read_csv_split, read_json_split

Query = Callable[[SparkSession, str], DataFrame]


def _raw(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return raw_table(spark, sf_dir, table)


def q_weighted_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.weighted_score(_raw(spark, sf_dir, "manual_rating"))


def q_avg_score_per_ticket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.avg_score_per_ticket(_raw(spark, sf_dir, "autoqa_ratings"))


def q_avg_score_per_reviewee(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.avg_score_per_reviewee(_raw(spark, sf_dir, "manual_reviews"))


def _mart(name: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return warehouse.build(raw_tables(spark, sf_dir))[name]
    q.__name__ = f"q_{name}"
    return q


def _incremental(name: str) -> Query:
    """Model after a first load of batch 1 and an incremental load of batch 2.

    Both go through a warehouse: batch 2 (the whole tables) is loaded on top
    of the written tables of batch 1, as new parts and the keys that they
    replace, and the table is read through these.
    """
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = raw_tables(spark, sf_dir)
        dw = Warehouse(spark, scratch_dir(spark, "warehouse"))
        warehouse.run(first_batch(raw), dw, only=(name,))
        warehouse.run(raw, dw, full_refresh=False, only=(name,))
        return dw.read(name)
    q.__name__ = f"q_incr_{name}"
    return q


def q_subs_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    subs = _raw(spark, sf_dir, "customer_subscriptions")
    return merge_subscriptions(materialize(merge_target(subs)), merge_source(subs))


def q_stg_autoqa_root_cause(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(raw_tables(spark, sf_dir), "stg_autoqa_root_cause")


QUERIES: dict[str, Query] = {
    "weighted_score": q_weighted_score,
    "avg_score_per_ticket": q_avg_score_per_ticket,
    "avg_score_per_reviewee": q_avg_score_per_reviewee,
}
QUERIES["stg_autoqa_root_cause"] = q_stg_autoqa_root_cause
for _name in warehouse.DIMENSIONS + warehouse.FACTS:
    QUERIES[_name] = _mart(_name)
QUERIES["mart_customer"] = _mart("customer")
QUERIES["mart_subscriptions"] = _mart("subscriptions")
for _name in warehouse.DIMENSIONS + warehouse.FACTS:
    QUERIES[f"incr_{_name}"] = _incremental(_name)
QUERIES["subs_merge"] = q_subs_merge


def _checks(fn, sized_parents: bool = False) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        m = warehouse.build(raw_tables(spark, sf_dir), together=sized_parents)
        if not sized_parents:
            return fn(m)
        # parents (dimensions) are materialised and counted, so small ones broadcast
        dims = warehouse.SizedDims(m)
        marts = {n: (dims[n] if n in warehouse.DIMENSIONS else m[n])
                 for n in warehouse.DIMENSIONS + warehouse.FACTS}
        return fn(marts, dims.rows)
    q.__name__ = f"q_{fn.__name__}"
    return q


QUERIES["check_not_null"] = _checks(checks.not_null_checks)
QUERIES["check_unique"] = _checks(checks.unique_checks)
QUERIES["check_relationships"] = _checks(checks.relationship_checks, sized_parents=True)
QUERIES["check_suite"] = _checks(checks.check_suite, sized_parents=True)


def _raw_join(fn, *tables: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(*[_raw(spark, sf_dir, t) for t in tables])
    q.__name__ = f"q_{fn.__name__}"
    return q


def _on_marts(fn, *names: str, **kw) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        # one scan a table for the dimensions, where all of them are looked up
        looked_up = {d for n in names for d in warehouse.FACT_DIMENSIONS[n]}
        m = warehouse.build(raw_tables(spark, sf_dir), together=len(looked_up) == len(warehouse.DIMENSIONS))
        facts = [m[n] for n in names]
        release(spark)  # the dimensions are made, the shuffles for them are not needed again
        return fn(*facts, **kw)
    q.__name__ = f"q_{fn.__name__}"
    return q


def q_star_reviews_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = warehouse.build(raw_tables(spark, sf_dir))
    return relations.reviews_by_date(m["fact_manual_reviews"], dims.dim_date(spark))


QUERIES.update({
    "raw_reviews_ratings": _raw_join(relations.reviews_ratings, "autoqa_reviews", "autoqa_ratings"),
    "raw_ratings_causes": _raw_join(relations.ratings_root_causes, "autoqa_ratings", "autoqa_root_cause"),
    "raw_reviews_conversations": _raw_join(relations.reviews_conversations, "autoqa_reviews", "conversations"),
    "raw_manual_ratings": _raw_join(relations.manual_reviews_ratings, "manual_reviews", "manual_rating"),
    "raw_manual_conversations": _raw_join(relations.manual_reviews_conversations, "manual_reviews", "conversations"),
    "star_root_cause_drill": _on_marts(relations.root_cause_drill, "fact_autoqa_root_cause",
                                       "fact_autoqa_ratings", "fact_autoqa_reviews"),
    "star_manual_rating_drill": _on_marts(relations.manual_rating_drill, "fact_manual_ratings",
                                          "fact_manual_reviews"),
    "star_reviews_by_date": q_star_reviews_by_date,
    "ticket_scores_auto_vs_manual": _raw_join(metrics.ticket_scores_auto_vs_manual, "autoqa_ratings",
                                              "manual_reviews"),
    "reviewer_performance": _on_marts(metrics.reviewer_performance, "fact_manual_reviews"),
    "root_cause_breakdown": _on_marts(metrics.root_cause_breakdown, "fact_autoqa_root_cause",
                                      "fact_autoqa_ratings"),
    "score_by_week": _on_marts(metrics.score_series, "fact_manual_reviews", "fact_autoqa_ratings",
                               "fact_autoqa_reviews", unit="week"),
    "score_by_month": _on_marts(metrics.score_series, "fact_manual_reviews", "fact_autoqa_ratings",
                                "fact_autoqa_reviews", unit="month"),
    "top_agents": _on_marts(metrics.top_agents, "fact_manual_reviews", k=10),
    "top_root_causes": _on_marts(metrics.top_root_causes, "fact_autoqa_root_cause", k=5),
    "root_cause_heatmap": _on_marts(metrics.root_cause_heatmap, "fact_autoqa_root_cause"),
})


# ---------------------------------------------------------------------------
# Sources and sinks: data derived from the driver tables is landed in the
# shared scratch folder in the export formats, then read back through the
# library's readers and loaders.

def q_scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    (_raw(spark, sf_dir, "conversations").write.mode("overwrite")
     .option("header", True).option("escape", '"').csv(path))
    return read_csv(spark, path, "conversations")


def q_load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = scratch_dir(spark, "landing")
    for table, name in LANDED_FILES.items():
        (_raw(spark, sf_dir, table).write.mode("overwrite").option("header", True).option("escape", '"')
         .csv(f"{landing}/{name}"))
    raw = Warehouse(spark, scratch_dir(spark, "warehouse"), "raw")
    ingest_csv_tables(spark, landing, raw)
    return reduce(DataFrame.unionByName, [
        raw.read(t).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table_name"), "row_count")
        for t in LANDED_FILES])


def _subscription_docs(spark: SparkSession, subs: DataFrame) -> DataFrame:
    path = scratch_dir(spark, "json")
    write_documents(subs, path, max_elements=500, legacy=True)
    return read_json_documents(spark, path, legacy=True)


def q_json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _subscription_docs(spark, _raw(spark, sf_dir, "customer_subscriptions"))


def q_subs_initial_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = Warehouse(spark, scratch_dir(spark, "warehouse"), "raw")
    load_subscriptions(_subscription_docs(spark, _raw(spark, sf_dir, "customer_subscriptions")), raw)
    return raw.read(SUBSCRIPTIONS, schemas.struct_type(SUBSCRIPTIONS))


def q_subs_merge_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    subs = _raw(spark, sf_dir, "customer_subscriptions")
    raw = Warehouse(spark, scratch_dir(spark, "warehouse"), "raw")
    load_subscriptions(_subscription_docs(spark, merge_target(subs)), raw)
    load_subscriptions(_subscription_docs(spark, merge_source(subs)), raw)
    return raw.read(SUBSCRIPTIONS, schemas.struct_type(SUBSCRIPTIONS))


def q_scan_csv_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    (_raw(spark, sf_dir, "conversations").write.mode("overwrite")
     .option("header", True).option("escape", '"').csv(path))
    return read_csv_split(spark, path, "conversations")


def q_json_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "json")
    write_documents(_raw(spark, sf_dir, "customer_subscriptions"), path, max_elements=100_000, legacy=True)
    return read_json_split(spark, path, legacy=True)


def q_json_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose names hold apostrophes and the words None and True, which the plain repair cannot read."""
    path = scratch_dir(spark, "json")
    subs = _raw(spark, sf_dir, "customer_subscriptions").withColumn(
        "customer_first_name", F.concat(F.lit("D'"), "customer_first_name", F.lit(" None's True")))
    write_documents(subs, path, max_elements=500, legacy="tokens")
    return read_json_documents(spark, path, legacy="tokens")


def q_sync_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table whose columns change between loads: one added, one dropped, one of another type."""
    ratings = _raw(spark, sf_dir, "manual_rating")
    even = F.col("category_id") % 2 == 0
    dw = Warehouse(spark, scratch_dir(spark, "warehouse"))
    dw.write("ratings", ratings.filter(even).select("review_id", "category_id", F.col("rating_max").cast("string").alias("rating_max"), "cause"))
    later = ratings.filter(~even).select("review_id", "category_id", "rating_max", "weight")
    dw.set_schema("ratings", later.schema)
    dw.append("ratings", later)
    return dw.read("ratings")


def _running(spark: SparkSession, sf_dir: str, name: str, group: str, sums: tuple[str, ...] = ()) -> Running:
    """A running aggregate after a full load, an upsert of changed rows and an append."""
    (table,), key = warehouse.MODEL_SOURCES[name], warehouse.UNIQUE_KEYS[name]
    stg = staging(raw_tables(spark, sf_dir))
    dims = warehouse.SizedDims(warehouse.build_dimensions(stg, together=True))
    dims.prefetch(warehouse.FACT_DIMENSIONS[name])
    release(spark)
    third = F.pmod(F.xxhash64(key), F.lit(3))
    dw = Warehouse(spark, scratch_dir(spark, "warehouse"))
    state = Running(dw, name, group, sums)

    def refresh():
        # nobody else reads this warehouse: what no live version names goes at once
        state.refresh()
        for t in (name, state.name):
            dw.sweep(t, 1, 0.0)
        release(spark)

    # a fact has one row for each staged row, and both have the key: the narrower ones are kept
    with kept(stg[table].filter(F.col(key).isNotNull()).dropDuplicates([key])) as rows:
        fact = warehouse.build_facts({table: rows}, dims)[name]
        # the first load holds other values for a third of the rows, which the second replaces
        stale = fact.filter(third == 1).select(*[F.lit(None).cast(fact.schema[c].dataType).alias(c) if c in sums else F.col(c) for c in fact.columns])
        dw.write(name, fact.filter(third == 0).unionByName(stale), key=key)
        refresh()
        fresh = fact.filter(third == 1)
        dw.upsert(name, fresh, key, fresh.count())
        refresh()
        dw.append(name, fact.filter(third == 2), key)
    refresh()
    return state


def q_running_avg_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _running(spark, sf_dir, "fact_autoqa_ratings", "external_ticket_id", ("score",)).averages("score", "avg_score")


def q_running_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _running(spark, sf_dir, "fact_manual_reviews", "conversation_external_id").repeated()


QUERIES.update({
    "scan_csv_split": q_scan_csv_split,
    "json_split": q_json_split,
    "json_tokens": q_json_tokens,
    "sync_columns": q_sync_columns,
    "running_avg_score": q_running_avg_score,
    "running_unique": q_running_unique,
    "scan_csv": q_scan_csv,
    "load_counts": q_load_counts,
    "json_flatten": q_json_flatten,
    "subs_initial_load": q_subs_initial_load,
    "subs_merge_load": q_subs_merge_load,
})
