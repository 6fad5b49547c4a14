"""Raw QA tables derived from the driver's generic tables.

The landed CSV/JSON exports of the QA domain are not part of the test
data, so each raw table is a deterministic projection of the driver
tables (orders, lineitem, events, customer).  Every projection is one
SQL text that runs unchanged on Spark and on DuckDB; Spark receives the
driver tables as DataFrame parameters (``spark.sql(text, orders=df)``)
so no global view is registered and column pruning / filter pushdown
reach the parquet scans.  The same texts are inlined as CTEs named
``q_<table>`` by the DuckDB oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qualis import schemas
from qualis.lazy import lazy
from qualis.operators.lookup import broadcastable

# Keys by which a projection's driver tables are joined, or dealt where models group its whole rows, and rows of the
# larger one that a task joins and groups.
JOIN_KEYS: dict[str, dict[str, str]] = {
    "autoqa_ratings": {"lineitem": "l_orderkey", "orders": "o_orderkey"},
    "autoqa_root_cause": {"lineitem": "l_orderkey"},
    "manual_reviews": {"events": "event_id", "orders": "o_orderkey"},
    "manual_rating": {"events": "event_id", "orders": "o_orderkey"},
}
JOINED_ROWS_A_TASK = 500_000
# Projections whose own rows are dealt, by the id that models group and join them by: no shuffle of the driver table before.
DEALT_BY = {"autoqa_root_cause": "autoqa_rating_id"}
# A customer row becomes a subscription row of some kilobytes, so few of them are a task's worth.
SUBSCRIPTIONS_A_TASK = 20_000

# Driver tables each projection reads.
SOURCES: dict[str, tuple[str, ...]] = {
    "autoqa_reviews": ("orders",),
    "autoqa_ratings": ("lineitem", "orders"),
    "autoqa_root_cause": ("lineitem",),
    "conversations": ("orders",),
    "manual_reviews": ("events", "orders"),
    "manual_rating": ("events", "orders"),
    "customer_subscriptions": ("customer",),
}

_TEXT: dict[str, str] = {
    "autoqa_reviews": """
SELECT concat('ar-', CAST(o_orderkey AS STRING)) AS autoqa_review_id,
 CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_custkey % 50 END AS payment_id,
 o_custkey % 5 AS payment_token_id, o_orderkey AS external_ticket_id,
 CASE WHEN o_orderkey % 17 = 0 THEN 'not-a-time' ELSE substring(CAST(o_orderdate AS STRING),1,19) END AS created_at,
 substring(CAST(o_orderdate AS STRING),1,19) AS conversation_created_at,
 CASE WHEN o_orderkey % 19 = 0 THEN '' ELSE substring(CAST(o_orderdate AS STRING),1,10) END AS conversation_created_date,
 o_orderkey % 7 AS team_id,
 CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_custkey % 40 AS DOUBLE) END AS reviewee_internal_id,
 substring(CAST(o_orderdate AS STRING),1,19) AS updated_at
FROM {orders}""",
    "autoqa_ratings": """
SELECT concat('ar-', CAST(l_orderkey AS STRING)) AS autoqa_review_id,
 concat('rt-', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS autoqa_rating_id,
 o_custkey % 50 AS payment_id, l_orderkey % 7 AS team_id, o_custkey % 5 AS payment_token_id,
 l_orderkey AS external_ticket_id, CAST(l_linenumber AS BIGINT) AS rating_category_id,
 concat('category-', CAST(l_linenumber AS STRING)) AS rating_category_name,
 min(l_tax) * 100 AS rating_scale_score,
 CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE max(l_quantity) * 2 END AS score,
 o_custkey % 40 AS reviewee_internal_id
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey GROUP BY l_orderkey, l_linenumber, o_custkey""",
    "autoqa_root_cause": """
SELECT CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE concat('rt-', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) END AS autoqa_rating_id,
 CAST(l_linenumber AS DOUBLE) AS category, CAST(CAST(l_quantity AS BIGINT) % 3 AS DOUBLE) AS count,
 CASE WHEN l_linestatus = 'O' THEN concat('cause-', CAST(l_suppkey % 10 AS STRING)) ELSE NULL END AS root_cause
FROM {lineitem}""",
    "conversations": """
SELECT o_custkey % 50 AS payment_id, o_custkey % 5 AS payment_token_id,
 CASE WHEN o_orderkey % 211 = 0 THEN NULL ELSE o_orderkey END AS external_ticket_id,
 substring(CAST(o_orderdate AS STRING),1,19) AS conversation_created_at,
 substring(CAST(o_orderdate AS STRING),1,10) AS conversation_created_at_date,
 o_orderpriority AS channel,
 CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE o_custkey % 60 END AS assignee_id,
 substring(CAST(o_orderdate AS STRING),1,19) AS updated_at,
 CASE WHEN o_orderstatus = 'F' THEN substring(CAST(o_orderdate AS STRING),1,19) ELSE NULL END AS closed_at,
 1 + o_orderkey % 9 AS message_count, CAST(NULL AS STRING) AS last_reply_at,
 CASE WHEN o_custkey % 4 = 0 THEN 'fr' ELSE 'en' END AS language, CAST(NULL AS STRING) AS imported_at,
 1 + o_custkey % 3 AS unique_public_agent_count,
 o_totalprice / 1000 AS public_mean_character_count, o_totalprice / 6000 AS public_mean_word_count,
 o_orderkey % 3 AS private_message_count, 1 + o_orderkey % 9 - o_orderkey % 3 AS public_message_count,
 CASE WHEN o_totalprice > 250000 THEN 'positive' ELSE 'negative' END AS klaus_sentiment,
 o_orderstatus = 'F' AS is_closed, o_custkey % 60 AS agent_most_public_messages,
 CAST(o_orderkey % 3600 AS DOUBLE) AS first_response_time,
 CAST(o_orderkey % 7200 AS DOUBLE) AS first_resolution_time_seconds,
 CAST(o_orderkey % 86400 AS DOUBLE) AS full_resolution_time_seconds,
 CAST(o_custkey % 60 AS DOUBLE) AS most_active_internal_user_id, CAST(NULL AS DOUBLE) AS deleted_at
FROM {orders}""",
    "manual_reviews": """
SELECT event_id AS review_id, o_custkey % 50 AS payment_id, o_custkey % 5 AS payment_token_id,
 substring(CAST(ts AS STRING),1,19) AS created, substring(CAST(o_orderdate AS STRING),1,19) AS conversation_created_at,
 substring(CAST(o_orderdate AS STRING),1,10) AS conversation_created_date, o_orderkey AS conversation_external_id,
 event_id % 9 AS team_id, user_id % 20 AS reviewer_id,
 CASE WHEN event_id % 29 = 0 THEN NULL ELSE CAST(user_id AS DOUBLE) END AS reviewee_id,
 CAST(NULL AS DOUBLE) AS comment_id, CAST(event_id % 3 AS DOUBLE) AS scorecard_id, event_type AS scorecard_tag,
 CASE WHEN event_id % 31 = 0 THEN NULL ELSE value END AS score,
 substring(CAST(ts AS STRING),1,19) AS updated_at, user_id % 20 AS updated_by,
 event_id % 2 = 0 AS assignment_review, event_id % 3 = 0 AS seen, event_id % 50 = 0 AS disputed,
 value AS review_time_seconds, event_type AS assignment_name, substring(CAST(ts AS STRING),1,19) AS imported_at
FROM {events} JOIN {orders} ON event_id = o_orderkey""",
    "manual_rating": """
SELECT o_custkey % 50 AS payment_id, CASE WHEN event_id % 500 = 499 THEN 99 ELSE event_id % 9 END AS team_id, event_id AS review_id, c AS category_id,
 CASE WHEN (event_id + c) % 6 = 0 THEN 42.0 WHEN event_id % 12 = 1 THEN 42.0 WHEN (event_id + c) % 37 = 0 THEN NULL ELSE CAST((event_id + c) % 5 AS DOUBLE) END AS rating,
 CASE WHEN (event_id + c) % 5 = 0 THEN event_type ELSE NULL END AS cause, CAST(4 AS BIGINT) AS rating_max,
 CAST(c * 5 AS DOUBLE) AS weight, c = 12 AS critical,
 concat('manual-', CAST(c AS STRING)) AS category_name
FROM {events} JOIN {orders} ON event_id = o_orderkey
CROSS JOIN (SELECT CAST(n AS BIGINT) AS c FROM (SELECT 6 AS n UNION ALL SELECT 7 UNION ALL SELECT 11 UNION ALL SELECT 12) v) k""",
}

# On Spark the four categories per review come from a generator (one
# input row -> four output rows in the same task), not from a join.
_SPARK_TEXT = {
    "manual_rating": _TEXT["manual_rating"].replace(
        "CROSS JOIN (SELECT CAST(n AS BIGINT) AS c FROM (SELECT 6 AS n UNION ALL SELECT 7 "
        "UNION ALL SELECT 11 UNION ALL SELECT 12) v) k",
        "LATERAL VIEW explode(array(CAST(6 AS BIGINT), CAST(7 AS BIGINT), CAST(11 AS BIGINT), "
        "CAST(12 AS BIGINT))) k AS c"),
}

# Subscription columns with a meaning; other single values differ by column and customer, arrays are typed NULLs.
_SUBSCRIPTION_EXPRS = {
    "subscription_id": "concat('sub-', CAST(c_custkey AS STRING))",
    "subscription_billing_period": "1 + c_custkey % 12",
    "subscription_billing_period_unit": "CASE WHEN c_custkey % 2 = 0 THEN 'month' ELSE 'year' END",
    "subscription_customer_id": "concat('cus-', CAST(c_custkey AS STRING))",
    "subscription_status": "c_mktsegment",
    "subscription_created_at": "1700000000 + c_custkey * 3600",
    "subscription_updated_at": "1710000000 + c_custkey",
    "subscription_deleted": "c_custkey % 7 = 0",
    "subscription_mrr": "CAST(floor(c_acctbal) AS BIGINT)",
    "customer_id": "concat('cus-', CAST(c_custkey AS STRING))",
    "customer_first_name": "c_name",
    "customer_created_at": "1700000000 + c_custkey * 3600",
    "customer_updated_at": "1710000000 + c_custkey",
}

_DUCK_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN",
               "date": "DATE", schemas.ITEM_ARRAY: "STRUCT(id VARCHAR, quantity BIGINT)[]"}


def _filler(name: str, typ: str, place: int) -> str | None:
    """A value of its own for a column, NULL for every eleventh customer or so."""
    value = {"string": f"concat('{name}-', CAST(c_custkey AS STRING))",
             "bigint": f"c_custkey * 1000 + {place}",
             "double": f"CAST(c_custkey * 1000 + {place} AS DOUBLE) / 4",
             "boolean": f"(c_custkey + {place}) % 3 = 0"}.get(typ)
    return value and f"CASE WHEN (c_custkey + {place}) % 11 = 0 THEN NULL ELSE {value} END"


def _subscriptions_text(dialect: str) -> str:
    parts = []
    for place, (name, typ) in enumerate(schemas.RAW_COLUMNS["customer_subscriptions"]):
        if name == "dt_customer_signup_date":
            days = "CAST(floor((1700000000 + c_custkey * 3600) / 86400) AS INT)"
            expr = (f"date_from_unix_date({days})" if dialect == "spark"
                    else f"DATE '1970-01-01' + {days}")
        elif name in _SUBSCRIPTION_EXPRS:
            expr = _SUBSCRIPTION_EXPRS[name]
        else:
            expr = f"CAST({_filler(name, typ, place) or 'NULL'} AS {typ if dialect == 'spark' else _DUCK_TYPES[typ]})"
        parts.append(f"{expr} AS {name}")
    return "\nSELECT " + ",\n ".join(parts) + "\nFROM {customer}"


def text(table: str, dialect: str = "spark") -> str:
    """Projection text of one raw table; ``{orders}``-style placeholders."""
    if table == "customer_subscriptions":
        return _subscriptions_text(dialect)
    if dialect == "spark" and table in _SPARK_TEXT:
        return _SPARK_TEXT[table]
    return _TEXT[table]


def duckdb_cte(table: str) -> str:
    """``q_<table> AS (...)`` for an oracle's WITH clause."""
    body = text(table, "duckdb").format(**{s: s for s in SOURCES[table]})
    return f"q_{table} AS ({body}\n)"


def duckdb_with(*tables: str) -> str:
    """WITH clause defining the given raw tables as ``q_<table>`` CTEs."""
    return "WITH " + ",\n".join(duckdb_cte(t) for t in tables)


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread(table: str, params: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The driver tables in as many partitions as their rows need (small ones as they are).

    Files with large row groups give few scan tasks, and AQE sizes partitions
    by compressed bytes: either way a task's rows, and its memory, would
    follow the input.  Both sides of a join are dealt by its key, so the join
    and what is grouped by that key need no other shuffle.  Beyond the bound
    of a broadcast they are joined by sorting: keys compress well, so AQE
    would send millions of rows to every task by way of the driver.
    """
    if table == "customer_subscriptions":
        n = params["customer"].count() // SUBSCRIPTIONS_A_TASK + 1
        return {"customer": params["customer"].repartition(n)} if n > 1 else params
    if table in JOIN_KEYS:
        rows = {s: df.count() for s, df in params.items()}
        n = max(rows.values()) // JOINED_ROWS_A_TASK + 1
        if n > 1:
            params = {s: df.repartition(n, JOIN_KEYS[table][s]) for s, df in params.items()}
        if len(params) > 1 and not broadcastable(min(rows.values())):
            params = {s: df.hint("merge") for s, df in params.items()}
    return params


def raw_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One raw table as a lazy DataFrame with the declared schema."""
    params = {s: driver_table(spark, sf_dir, s) for s in SOURCES[table]}
    df = spark.sql(text(table, "spark"), **(params if table in DEALT_BY else _spread(table, params)))
    df = df.select([df[c].cast(t).alias(c) for c, t in schemas.RAW_COLUMNS[table]])
    if table in DEALT_BY:
        n = max(p.count() for p in params.values()) // JOINED_ROWS_A_TASK + 1
        if n > 1:
            # at least the session's partitions, or a join would deal the rows again
            df = df.repartition(max(n, int(spark.conf.get("spark.sql.shuffle.partitions"))), DEALT_BY[table])
    return df


def raw_tables(spark: SparkSession, sf_dir: str):
    """All raw tables, each built on first access."""
    return lazy(SOURCES, lambda t: raw_table(spark, sf_dir, t))


# Two-batch splits for incremental loads: batch 1 = rows meeting the
# predicate (loaded as the first run), batch 2 = the whole table.  The
# same predicate text runs on Spark and DuckDB.
BATCH1_PREDICATES: dict[str, str] = {
    "autoqa_reviews": "updated_at < '1999-01-01' AND external_ticket_id % 10 <> 3",
    "conversations": "updated_at < '1999-01-01'",
    "autoqa_ratings": "external_ticket_id % 4 <> 0",
    "autoqa_root_cause": "category < 6",
    "manual_reviews": "updated_at < '2024-01-15'",
    "manual_rating": "review_id % 500 <> 499 AND category_id <> 12",
}


def first_batch(raw):
    """Batch-1 view of the raw tables (tables without a split pass whole)."""
    return lazy(list(raw), lambda t: raw[t].filter(BATCH1_PREDICATES[t]) if t in BATCH1_PREDICATES else raw[t])


# Subscription merge batch: the target lacks customers with key % 10 = 1;
# the source changes rows by key % 10 (0: times, mrr and signup date move;
# 2: both times NULL, mrr moves; 3: customer time and name move; 4: mrr
# moves with equal times; 5: absent; 1 and others: unchanged rows).
def _cust_key(df: DataFrame):
    return F.substring(df["subscription_id"], 5, 100).cast("bigint") % 10


def merge_target(subs: DataFrame) -> DataFrame:
    return subs.filter(_cust_key(subs) != 1)


def merge_source(subs: DataFrame) -> DataFrame:
    k = _cust_key(subs)
    src = subs.filter(k != 5)
    k = _cust_key(src)

    def when_k(col, cases):
        expr = None
        for kv, v in cases:
            expr = F.when(k == kv, v) if expr is None else expr.when(k == kv, v)
        return expr.otherwise(src[col]).alias(col)

    changes = {
        "subscription_updated_at": [(0, src["subscription_updated_at"] + 1),
                                    (2, F.lit(None).cast("bigint"))],
        "customer_updated_at": [(2, F.lit(None).cast("bigint")), (3, src["customer_updated_at"] + 1)],
        "subscription_mrr": [(0, src["subscription_mrr"] + 1), (2, src["subscription_mrr"] + 5),
                             (4, src["subscription_mrr"] + 9)],
        "customer_first_name": [(3, F.concat(src["customer_first_name"], F.lit(" (renamed)")))],
        "dt_customer_signup_date": [(0, F.date_add(src["dt_customer_signup_date"], 1))],
    }
    return src.select(*[when_k(c, changes[c]) if c in changes else src[c] for c in src.columns])


def merge_batch_duckdb() -> str:
    """CTEs ``merge_t`` and ``merge_s`` (needs ``q_customer_subscriptions``)."""
    k = "(CAST(substr(subscription_id, 5) AS BIGINT) % 10)"
    return f"""merge_t AS (SELECT * FROM q_customer_subscriptions WHERE {k} <> 1),
merge_s AS (SELECT * REPLACE (
    CASE WHEN {k} = 0 THEN subscription_updated_at + 1 WHEN {k} = 2 THEN NULL ELSE subscription_updated_at END AS subscription_updated_at,
    CASE WHEN {k} = 2 THEN NULL WHEN {k} = 3 THEN customer_updated_at + 1 ELSE customer_updated_at END AS customer_updated_at,
    CASE WHEN {k} = 0 THEN subscription_mrr + 1 WHEN {k} = 2 THEN subscription_mrr + 5 WHEN {k} = 4 THEN subscription_mrr + 9 ELSE subscription_mrr END AS subscription_mrr,
    CASE WHEN {k} = 3 THEN customer_first_name || ' (renamed)' ELSE customer_first_name END AS customer_first_name,
    CASE WHEN {k} = 0 THEN dt_customer_signup_date + 1 ELSE dt_customer_signup_date END AS dt_customer_signup_date)
  FROM q_customer_subscriptions WHERE {k} <> 5)"""
