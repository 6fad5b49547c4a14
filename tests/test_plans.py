"""Plan-shape checks: the properties the pipeline relies on at scale."""

import re

import pytest

from qualis.plans import metrics, warehouse
from qualis.sources.fixtures import raw_table, raw_tables
from qualis.sources.layers import Warehouse

from conftest import SF_SMALL


def _executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_lookups_broadcast_sized_dimensions(spark):
    fact = warehouse.build(raw_tables(spark, SF_SMALL))["fact_manual_reviews"]
    plan = fact._jdf.queryExecution().sparkPlan().toString()  # static plan, before AQE
    assert "SortMergeJoin" not in plan
    assert plan.count("BroadcastHashJoin") >= 4  # payment, team, reviewer, reviewee


def test_unsized_dimension_is_not_broadcast_blindly(spark):
    from qualis.operators.lookup import lookup
    f = spark.range(10).withColumnRenamed("id", "user_id")
    d = spark.range(10).selectExpr("id AS user_id", "md5(CAST(id AS STRING)) AS user_key")
    plan = lookup(f, "user_id", d, "user_id", "user_key")._jdf.queryExecution().logical().toString()
    assert "broadcast" not in plan.lower()


def test_scans_read_only_needed_columns(spark, tmp_dir):
    wh = Warehouse(spark, tmp_dir, "raw")
    wh.write("manual_rating", raw_table(spark, SF_SMALL, "manual_rating"))
    df = metrics.weighted_score(wh.read("manual_rating"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<review_id:bigint,rating:double,rating_max:bigint,weight:double>" in plan
    # partial (map-side) aggregation before the shuffle
    assert plan.count("HashAggregate") >= 2


def test_dimension_aggregates_partially_before_shuffle(spark):
    dim = warehouse.build(raw_tables(spark, SF_SMALL))["dim_user"]
    plan = dim._jdf.queryExecution().sparkPlan().toString()
    assert "partial_max" in plan


def test_merge_of_a_large_batch_broadcasts_none_of_its_keys(spark):
    """The driver would hold up to four tables of the batch's rows; a small measured batch is broadcast as before."""
    from qualis.operators.merge import merge_when_changed
    target = spark.range(30).selectExpr("id AS k", "id AS t", "concat('a', id) AS v")
    source = spark.range(20, 40).selectExpr("id AS k", "id + id % 2 AS t", "concat('b', id) AS v")
    want = sorted([(k, k + k % 2 if 20 <= k else k, f"{'b' if k >= 30 or k > 20 and k % 2 else 'a'}{k}") for k in range(40)])
    for rows, broadcasts in ((500_000, False), (20, True)):
        merged = merge_when_changed(target, source, "k", ("t",), source_rows=rows)
        assert sorted(map(tuple, merged.collect())) == want
        assert ("BroadcastHashJoin" in _executed(merged)) is broadcasts


def test_dealt_tables_are_joined_without_a_broadcast(spark, monkeypatch):
    """AQE sizes broadcasts by compressed bytes, which millions of keys in a row hardly fill."""
    from qualis.operators import lookup
    from qualis.sources import fixtures
    for table in ("autoqa_ratings", "manual_reviews", "manual_rating", "autoqa_root_cause"):
        want = sorted(map(str, raw_table(spark, SF_SMALL, table).collect()))
        with monkeypatch.context() as m:
            m.setattr(fixtures, "JOINED_ROWS_A_TASK", 500)
            m.setattr(lookup, "DIM_BROADCAST_MAX_ROWS", 500)
            whole = raw_table(spark, SF_SMALL, table)
            plan = _executed(whole)
            assert "BroadcastHashJoin" not in plan and "Exchange hashpartitioning" in plan, table
            tables = {s: fixtures.driver_table(spark, SF_SMALL, s) for s in fixtures.SOURCES[table]}
            assert {df.rdd.getNumPartitions() for df in fixtures._spread(table, tables).values()} == {max(df.count() for df in tables.values()) // 500 + 1}
            assert sorted(map(str, whole.collect())) == want, table


def _driver_tables(spark, path):
    """300 orders, 1,200 lines (four an order), 450 events of which 300 have an order."""
    day = "CAST('{}' AS TIMESTAMP_NTZ) + make_dt_interval(CAST(id % 900 AS INT))"
    tables = {
        "orders": spark.range(300).selectExpr(
            "id AS o_orderkey", "id % 90 AS o_custkey", "IF(id % 2 = 0, 'F', 'O') AS o_orderstatus",
            "CAST(id * 1000 AS DOUBLE) AS o_totalprice", f"{day.format('1997-06-01')} AS o_orderdate", "'1-URGENT' AS o_orderpriority"),
        "lineitem": spark.range(1200).selectExpr(
            "id % 300 AS l_orderkey", "id % 7 AS l_suppkey", "CAST(1 + id DIV 300 AS INT) AS l_linenumber",
            "CAST(id % 50 AS DOUBLE) AS l_quantity", "CAST(id % 9 AS DOUBLE) / 100 AS l_tax", "'O' AS l_linestatus"),
        "events": spark.range(450).selectExpr(
            "id AS event_id", f"{day.format('2024-01-01')} AS ts", "id % 70 AS user_id", "'click' AS event_type", "CAST(id % 100 AS DOUBLE) AS value"),
    }
    for name, df in tables.items():
        df.write.parquet(f"{path}/{name}.parquet")
    return path


@pytest.mark.parametrize("name", ["incr_dim_payment", "reviewer_performance", "star_reviews_by_date", "top_agents",
                                  "score_by_month", "score_by_week"])
def test_queries_keep_their_tables_dealt_by_rows(spark, tmp_dir, monkeypatch, name):
    """Partitions by bytes, or as many as the session names, would take more rows a task with every larger input."""
    from qualis.catalog import QUERIES
    from qualis.sources import fixtures

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    def kept(df, keep=warehouse.materialize):
        plans.append(plan(df))
        return keep(df)

    path, plans = _driver_tables(spark, tmp_dir), []
    want = sorted(map(str, QUERIES[name](spark, path).collect()))
    monkeypatch.setattr(fixtures, "JOINED_ROWS_A_TASK", 50, raising=False)
    monkeypatch.setattr(warehouse, "materialize", kept)
    result = QUERIES[name](spark, path)
    assert want and sorted(map(str, result.collect())) == want
    plans.append(plan(result))
    dealt = set()
    for key, n in (("l_orderkey", 1200 // 50 + 1), ("event_id", 450 // 50 + 1)):
        for p in plans:
            if f"{key}#" in p:
                assert re.search(rf"hashpartitioning\({key}#\d+L, {n}\)", p), key
                dealt.add(key)
    assert dealt == {"l_orderkey", "event_id"}


def test_check_suite_computes_each_table_once(spark):
    from qualis.plans import checks
    read = []

    class Marts(dict):
        def __getitem__(self, name):
            read.append(name)
            return super().__getitem__(name)

    def fact(columns, rows):
        return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))

    marts = Marts({"dim_team": fact(["team_key"], [("t",)]), "dim_payment": fact(["payment_key"], [("p",), ("p",), (None,)]),
                   "dim_user": fact(["user_key"], []), "dim_rating_category": fact(["rating_category_key"], [("c",)])})
    for table in dict.fromkeys(t for t, _ in checks.NOT_NULL if t.startswith("fact_")):
        columns = [c for t, c, *_ in checks.NOT_NULL + checks.RELATIONSHIPS if t == table]
        # keys a, a, b, null, null; the other columns name members that do not exist, but for one
        marts[table] = fact(columns, [(k, *["p" if i == 4 else "x"] * (len(columns) - 1)) for i, k in enumerate(["a", "a", "b", None, None])])
    want = sorted(map(tuple, checks.not_null_checks(marts).unionByName(checks.unique_checks(marts)).unionByName(checks.relationship_checks(marts)).collect()))
    assert {w[-1] for w in want} == {0, 1, 2, 4, 5}
    read.clear()
    suite = checks.check_suite(marts, {n: 3 for n in marts if n.startswith("dim_")})
    assert all(read.count(t) == 1 for t in marts if t.startswith("fact_"))
    assert sorted(map(tuple, suite.collect())) == want and len(want) == 30


@pytest.fixture()
def shuffled(spark):
    """Joins by shuffles, in plans that do not change while they run."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    was = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in was.items():
        spark.conf.set(k, v)


def _dealt_by(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [re.sub(r"#\d+L?", "", x) for x in re.findall(r"Exchange hashpartitioning\((.*), \d+\)", plan)]


def test_root_cause_drill_shuffles_no_hashed_text(spark, tmp_dir, monkeypatch, shuffled):
    from qualis.catalog import QUERIES
    from qualis.sources import fixtures
    path = _driver_tables(spark, tmp_dir)
    marts = warehouse.build(raw_tables(spark, path))
    c, a, r = (marts[f"fact_autoqa_{n}"] for n in ("root_cause", "ratings", "reviews"))
    want = c.select("autoqa_root_cause_key", "autoqa_rating_key", "category", "root_cause").join(
        a.select("autoqa_rating_key", "autoqa_review_key", "rating_category_key", "score"), "autoqa_rating_key").join(
        r.select("autoqa_review_key", "team_key", "created_ts"), "autoqa_review_key")
    monkeypatch.setattr(fixtures, "JOINED_ROWS_A_TASK", 50)
    got = QUERIES["star_root_cause_drill"](spark, path)
    by = _dealt_by(got)
    assert not any(re.search(r"\w+_key\b", re.sub("[lo]_orderkey", "", x)) for x in by), by
    # the root causes are shuffled once, by the id that tells them apart and joins them, the ratings with the reviews once more
    assert by.count("autoqa_rating_id") == 2 and sum("l_orderkey" in x for x in by) == 1
    assert got.columns == want.columns and want.count() > 1000
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_new_root_causes_are_found_without_shuffling_their_hashes(spark, tmp_dir, monkeypatch, shuffled):
    from qualis.catalog import QUERIES
    path, made = _driver_tables(spark, tmp_dir), []

    def kept(df, keep=warehouse.materialize):
        made.append(df)
        return keep(df)

    monkeypatch.setattr(warehouse, "materialize", kept)
    got = QUERIES["incr_fact_autoqa_root_cause"](spark, path)
    plan = made[-1]._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange"):]
    assert not re.search(r"Project \[.*md5\(", below), plan  # hashed above the first exchange only
    monkeypatch.undo()
    assert sorted(map(str, got.collect())) == sorted(map(str, QUERIES["fact_autoqa_root_cause"](spark, path).collect()))
