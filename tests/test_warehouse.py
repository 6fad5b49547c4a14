"""What a version of a stored table costs, and that every way of writing one gives the same rows."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from qualis import schemas
from qualis.operators import keyset
from qualis.operators.incremental import StoredKeys, only_new_keys, sync_columns, upsert
from qualis.operators.merge import merge_subscriptions
from qualis.plans import dims, ingest, warehouse
from qualis.plans.ingest import SIGNUP_DAY, SUBSCRIPTIONS, load_subscriptions
from qualis.plans.running import Running
from qualis.plans.staging import staging
from qualis.sources import layers
from qualis.sources.fixtures import SOURCES, first_batch, merge_source, merge_target, raw_table, raw_tables
from qualis.sources.layers import Warehouse

from conftest import SF_SMALL


def _files(folder):
    """Data files under a folder -> (size, modification time)."""
    return {os.path.join(d, f): (os.path.getsize(os.path.join(d, f)), os.stat(os.path.join(d, f)).st_mtime_ns)
            for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def _same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


# -- MERGE by partition -----------------------------------------------------

@pytest.fixture()
def subscriptions(spark, tmp_dir):
    subs = raw_table(spark, SF_SMALL, "customer_subscriptions")
    raw = Warehouse(spark, tmp_dir, "raw")
    load_subscriptions(merge_target(subs), raw)
    return subs, raw


def test_merge_rewrites_only_the_days_it_touches(spark, tmp_dir, subscriptions):
    subs, raw = subscriptions
    schema = schemas.struct_type(SUBSCRIPTIONS)
    before, live = _files(f"{tmp_dir}/raw/{SUBSCRIPTIONS}"), raw.live(SUBSCRIPTIONS)
    day = subs.filter(f"{SIGNUP_DAY} IS NOT NULL").groupBy(SIGNUP_DAY).count().orderBy(SIGNUP_DAY).first()[0]
    source = subs.filter(F.col(SIGNUP_DAY) == day).withColumn("subscription_updated_at", F.col("subscription_updated_at") + 1)
    want = merge_subscriptions(raw.read(SUBSCRIPTIONS, schema), source).collect()
    rows = load_subscriptions(source, raw)
    assert rows == len(want) == raw.read(SUBSCRIPTIONS, schema).count() == raw.rows(SUBSCRIPTIONS)
    assert sorted(map(str, raw.read(SUBSCRIPTIONS, schema).collect())) == sorted(map(str, want))
    kept = [p for p in raw.live(SUBSCRIPTIONS).parts if p.value != str(day)]
    assert kept == [p for p in live.parts if p.value != str(day)]  # by reference
    after = _files(f"{tmp_dir}/raw/{SUBSCRIPTIONS}")
    assert {k: after[k] for k in before} == before  # names, sizes and times of all old files
    assert {os.path.basename(os.path.dirname(f)) for f in set(after) - set(before)} == {f"{SIGNUP_DAY}={day}"}


def test_many_days_share_folders_and_one_schema(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(ingest, "FOLDERS", 2)
    subs = raw_table(spark, SF_SMALL, "customer_subscriptions")
    subs = subs.withColumn(SIGNUP_DAY, F.when(F.col("subscription_id") != "sub-7", F.col(SIGNUP_DAY)))
    schema = schemas.struct_type(SUBSCRIPTIONS)
    raw = Warehouse(spark, tmp_dir, "raw")
    load_subscriptions(subs, raw)
    assert subs.select(SIGNUP_DAY).distinct().count() > 5 and len(raw.live(SUBSCRIPTIONS).parts) <= 4  # two or three spans, and no day
    for back in (raw, Warehouse(spark, tmp_dir, "raw")):
        assert _same(back.read(SUBSCRIPTIONS, schema), subs) and back.read(SUBSCRIPTIONS).columns == subs.columns
    with open(f"{tmp_dir}/raw/_versions/{SUBSCRIPTIONS}.v1.json") as entry:
        assert entry.read().count("customer_first_name") == 1  # the log names the columns once, not once a folder
    raw.register()
    assert spark.table(f"raw.{SUBSCRIPTIONS}").count() == subs.count()


def test_merge_rewrites_only_the_spans_it_touches(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(ingest, "FOLDERS", 2)
    subs = raw_table(spark, SF_SMALL, "customer_subscriptions")
    schema = schemas.struct_type(SUBSCRIPTIONS)
    raw = Warehouse(spark, tmp_dir, "raw")
    load_subscriptions(merge_target(subs), raw)
    before, live = _files(f"{tmp_dir}/raw/{SUBSCRIPTIONS}"), raw.live(SUBSCRIPTIONS)
    source = subs.filter("subscription_id = 'sub-2'").withColumn("subscription_updated_at", F.col("subscription_updated_at") + 1)
    want = merge_subscriptions(merge_target(subs), source)
    assert load_subscriptions(source, raw) == want.count()
    assert _same(raw.read(SUBSCRIPTIONS, schema), want)
    assert len(set(raw.live(SUBSCRIPTIONS).parts) - set(live.parts)) == 1 == len(set(live.parts) - set(raw.live(SUBSCRIPTIONS).parts))
    assert {k: v for k, v in _files(f"{tmp_dir}/raw/{SUBSCRIPTIONS}").items() if k in before} == before
    want = merge_subscriptions(raw.read(SUBSCRIPTIONS, schema), merge_source(subs)).collect()
    load_subscriptions(merge_source(subs), raw)
    assert sorted(map(str, raw.read(SUBSCRIPTIONS, schema).collect())) == sorted(map(str, want))
    assert len(raw.live(SUBSCRIPTIONS).parts) < 2 * len(live.parts) + 2


def test_merge_over_whole_batches_equals_the_full_rewrite(spark, subscriptions):
    subs, raw = subscriptions
    schema = schemas.struct_type(SUBSCRIPTIONS)
    want = merge_subscriptions(merge_target(subs), merge_source(subs))
    load_subscriptions(merge_source(subs), raw)
    assert _same(raw.read(SUBSCRIPTIONS, schema), want)
    assert Warehouse(spark, raw.root, "raw").rows(SUBSCRIPTIONS) == want.count()


def test_batch_that_is_empty_or_changes_nothing_writes_nothing(spark, tmp_dir, subscriptions):
    subs, raw = subscriptions
    before, version = _files(tmp_dir), raw.version(SUBSCRIPTIONS)
    assert load_subscriptions(subs.limit(0), raw) == 0
    assert load_subscriptions(merge_target(subs).filter("subscription_id IS NOT NULL"), raw) == raw.rows(SUBSCRIPTIONS)
    assert raw.version(SUBSCRIPTIONS) == version
    assert {k for k in _files(tmp_dir) if f"/{SUBSCRIPTIONS}/" in k} == {k for k in before if f"/{SUBSCRIPTIONS}/" in k}


def test_rows_without_a_day_and_views_over_days(spark, tmp_dir):
    raw = Warehouse(spark, tmp_dir, "raw")
    rows = spark.createDataFrame([(1, "a", "x"), (2, None, "x"), (3, "b'c", "x")], "k bigint, day string, v string")
    raw.write("days", rows, partition_by="day")
    again = spark.createDataFrame([(2, None, "new"), (4, "a", "new")], "k bigint, day string, v string")
    assert raw.replace_values("days", again, "day", {None}) == 4
    assert sorted(tuple(r) for r in raw.read("days").collect()) == [(1, "a", "x"), (2, None, "new"), (3, "b'c", "x"), (4, "a", "new")]
    raw.register()
    assert sorted(map(tuple, spark.table("raw.days").select("k", "day", "v").collect())) == sorted(map(tuple, raw.read("days").collect()))


# -- upserts as parts and deletes -------------------------------------------

ROWS = "k bigint, v string, updated_at timestamp_ntz"


def _at(day):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day)


def test_upsert_writes_in_proportion_to_the_batch(spark, tmp_dir):
    dw = Warehouse(spark, tmp_dir, "dw")
    big = spark.range(200_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit(_at(0)).cast("timestamp_ntz").alias("updated_at"))
    dw.write("t", big, key="k")
    before = _files(tmp_dir)
    rows = dw.upsert("t", spark.createDataFrame([(5, "new", _at(1)), (300_000, "new", _at(1)), (None, "new", _at(1))], ROWS), "k", 3)
    assert rows == dw.rows("t") == dw.read("t").count() == 200_002
    written = sum(size for f, (size, _) in _files(tmp_dir).items() if f not in before)
    assert written < 0.01 * sum(size for size, _ in before.values())
    assert {f: _files(tmp_dir)[f] for f in before} == before
    assert [r.v for r in dw.read("t").filter("k = 5").collect()] == ["new"] and dw.watermark("t").startswith("2024-01-02")
    dw.register()
    assert spark.table("dw.t").count() == 200_002 and spark.table("dw.t").filter("k = 5").collect()[0].v == "new"


@pytest.mark.parametrize("seed", range(3))
def test_any_run_of_upserts_equals_the_plain_one(spark, tmp_dir, monkeypatch, seed):
    monkeypatch.setattr(layers, "COMPACT_SHARE", 0.5 if seed else 9.9)
    draw = random.Random(seed)
    dw = Warehouse(spark, tmp_dir, "dw")
    model: list[tuple] = [(k, f"0-{k}", _at(0)) for k in range(12)] + [(None, "0-null", _at(0))]
    dw.write("t", spark.createDataFrame(model, ROWS), key="k")
    for step in range(1, 6):
        keys = draw.sample(range(20), draw.randint(1, 5)) + [None] * draw.randint(0, 1)
        batch = [(k, f"{step}-{k}", _at(step)) for k in keys]
        df = spark.createDataFrame(batch, ROWS)
        assert _same(upsert(dw.read("t"), df, "k"), spark.createDataFrame([r for r in model if r[0] is None or r[0] not in keys] + batch, ROWS))
        model = [r for r in model if r[0] is None or r[0] not in keys] + batch
        assert dw.upsert("t", df, "k", len(batch)) == len(model)
        assert _same(dw.read("t"), spark.createDataFrame(model, ROWS))
        assert dw.null_keys("t", "k") == sum(r[0] is None for r in model)
    fresh = Warehouse(spark, tmp_dir, "dw")
    assert _same(fresh.read("t"), spark.createDataFrame(model, ROWS)) and fresh.rows("t") == len(model)
    fresh.compact("t", "k")
    assert len(fresh.live("t").parts) == 1 and not fresh.live("t").deletes and _same(fresh.read("t"), spark.createDataFrame(model, ROWS))


def test_two_new_rows_for_one_stored_row_are_an_error(spark, tmp_dir):
    dw = Warehouse(spark, tmp_dir, "dw")
    dw.write("t", spark.createDataFrame([(1, "a", _at(0))], ROWS), key="k")
    with pytest.raises(ValueError):
        dw.upsert("t", spark.createDataFrame([(1, "x", _at(1)), (1, "y", _at(1))], ROWS), "k", 2)
    assert dw.version("t") == 1
    assert dw.upsert("t", spark.createDataFrame([(2, "x", _at(1)), (2, "y", _at(1))], ROWS), "k", 2) == 3  # no stored row: all are inserted


# -- key filters ------------------------------------------------------------

def test_key_filter_finds_all_keys_and_few_others(spark):
    held = spark.range(0, 40_000).select((F.col("id") * 7).alias("k"))
    n_words = keyset.words(40_000)
    stored = keyset.build(held, "k", n_words, "p")
    assert stored.count() <= n_words
    about = {"p": {"words": n_words, "low": "0", "high": str(10**9)}}
    assert keyset.possible(held, "k", about, stored).count() == 40_000
    others = spark.range(0, 40_000).select((F.col("id") * 7 + 3).alias("k"))
    wrong = keyset.possible(others, "k", about, stored).count() / 40_000
    assert wrong < 0.03, wrong  # false positives, measured
    assert keyset.possible(others, "k", {"p": {**about["p"], "low": "-9", "high": "-1"}}, stored).count() == 0  # out of range


def test_held_keys_read_only_parts_that_may_hold_one(spark, tmp_dir):
    dw = Warehouse(spark, tmp_dir, "dw")
    make = lambda lo, hi: spark.range(lo, hi).select(F.md5(F.col("id").cast("string")).alias("k"))
    dw.write("t", make(0, 3000), key="k")
    for step in range(1, 4):
        dw.append("t", make(3000 * step, 3000 * step + 3000), "k")
    folders = [p.folder for p in dw.live("t").parts]
    keys = make(6010, 6013).union(make(90_000, 90_005))
    held = dw.held_keys("t", keys, "k")
    plan = held._jdf.queryExecution().analyzed().toString() + str(held.inputFiles())
    assert [f in plan for f in folders] == [False, False, True, False]
    assert _same(held, make(6010, 6013))
    assert dw.held_keys("t", make(90_000, 90_002), "k").count() == 0
    assert _same(dw.held_keys("t", make(2990, 3010), "k", few=True), make(2990, 3010))


@pytest.mark.parametrize("share", [0.0, 1000.0])
def test_new_keys_of_a_stored_table_equal_the_scan(spark, tmp_dir, monkeypatch, share):
    monkeypatch.setattr(StoredKeys, "FILTER_SHARE", share)
    dw = Warehouse(spark, tmp_dir, "dw")
    source = spark.createDataFrame([(1, "a"), (2, "b"), (9, "c"), (9, "d"), (None, "n")], "k bigint, v string")
    for held in ([1, 5], [], [2, None]):
        dw.write("t", spark.createDataFrame([(k,) for k in held], "k bigint"), key="k")
        assert _same(StoredKeys(dw, "t", "k").only_new(source, F.col("k")), only_new_keys(source, dw.read("t"), "k"))
    dw.write("t", spark.createDataFrame([(1,), (2,)], "k bigint"))  # without a key filter
    assert sorted(r.v for r in StoredKeys(dw, "t", "k").only_new(source, F.col("k")).collect()) == ["c", "d"]


# -- columns, content, retention --------------------------------------------

def test_columns_change_without_a_write(spark, tmp_dir):
    dw = Warehouse(spark, tmp_dir, "dw")
    old = spark.createDataFrame([(1, "7", "gone"), (2, "8", "gone")], "k bigint, v string, old string")
    dw.write("t", old, key="k")
    before = _files(tmp_dir)
    new = StructType.fromDDL("k bigint, v bigint, added double")
    dw.set_schema("t", new)
    assert _files(tmp_dir) == before
    assert sorted(map(tuple, dw.read("t").collect())) == [(1, 7, None), (2, 8, None)] and _same(dw.read("t"), sync_columns(old, new))
    dw.upsert("t", spark.createDataFrame([(2, 9, 0.5), (3, 1, 1.5)], new), "k", 2)
    assert sorted(map(tuple, dw.read("t").collect())) == [(1, 7, None), (2, 9, 0.5), (3, 1, 1.5)]
    dw.register()
    assert sorted(map(tuple, spark.table("dw.t").collect())) == [(1, 7, None), (2, 9, 0.5), (3, 1, 1.5)]


def test_retyped_key_still_matches_and_deletes(spark, tmp_dir):
    dw = Warehouse(spark, tmp_dir, "dw")
    dw.write("t", spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string"), key="k")
    dw.upsert("t", spark.createDataFrame([(1, "A")], "k int, v string"), "k", 1)
    dw.set_schema("t", StructType.fromDDL("k bigint, v string"))
    assert dw.upsert("t", spark.createDataFrame([(2, "B"), (1, "AA")], "k bigint, v string"), "k", 2) == 3
    assert sorted(map(tuple, dw.read("t").collect())) == [(1, "AA"), (2, "B"), (3, "c")]


def test_swapped_value_with_equal_count_is_caught(spark, tmp_dir):
    dw = Warehouse(spark, tmp_dir, "dw")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, v string")
    seen = rows.agg(F.count(F.lit(1)).alias("rows"), layers.fingerprint(rows).alias("fingerprint")).first().asDict()
    rows.orderBy("v").write.parquet(f"{tmp_dir}/dw/t/ok")
    assert dw._confirmed("t", "ok", rows.schema, seen, None, None)[1] == 2
    spark.createDataFrame([(1, "b"), (2, "a")], "k bigint, v string").write.parquet(f"{tmp_dir}/dw/t/swapped")
    with pytest.raises(RuntimeError, match="not those written"):
        dw._confirmed("t", "swapped", rows.schema, seen, None, None)
    rows.limit(1).write.parquet(f"{tmp_dir}/dw/t/short")
    with pytest.raises(RuntimeError, match="read back 1"):
        dw._confirmed("t", "short", rows.schema, seen, None, None)


def test_sweep_keeps_what_kept_versions_name(spark, tmp_dir):
    dw = Warehouse(spark, tmp_dir, "dw")
    for step in range(4):
        dw.write("t", spark.createDataFrame([(k, f"{step}", _at(step)) for k in range(10)], ROWS), key="k")
    reader = dw.read("t")  # of version 4, which stays
    dw.upsert("t", spark.createDataFrame([(3, "new", _at(9))], ROWS), "k", 1)
    assert dw.sweep("t", keep_versions=2) == []  # all folders are young
    gone = dw.sweep("t", keep_versions=2, older_than_s=-1)
    assert {g.split("-")[0] for g in gone} == {"v1", "v2", "v3"}
    assert {r.v for r in reader.collect()} == {"3"}
    fresh = Warehouse(spark, tmp_dir, "dw")
    assert fresh.version("t") == 5 and fresh.read("t").count() == 10
    assert dw.sweep("t", keep_versions=2, older_than_s=-1) == []


# -- running aggregates -----------------------------------------------------

def test_running_aggregates_equal_a_recomputation_and_read_new_parts_only(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(layers, "COMPACT_SHARE", 9.9)
    schema = "k bigint, g string, x double"
    dw = Warehouse(spark, tmp_dir, "dw")
    dw.write("t", spark.createDataFrame([(i, f"g{i % 5}" if i % 7 else None, i / 10) for i in range(40)], schema), key="k")
    state = Running(dw, "t", "g", ("x",))

    def recomputed():
        return dw.read("t").groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("x").cast("decimal(38,12)")).cast("decimal(38,12)").alias("sum_x"), F.count("x").alias("n_x"))

    assert state.refresh() == 6 and state.refresh() == 0 and _same(state.groups(), recomputed())
    first = dw.live("t").parts[0].folder
    for batch in ([(3, "g9", 7.5), (100, "g1", None)], [(3, None, 0.1), (4, "g4", None)], [(101, "g9", 2.0), (None, "g9", 3.0)]):
        dw.upsert("t", spark.createDataFrame(batch, schema), "k", len(batch))
        came, _ = dw.changes("t", dw.live(state.name).sources["t"])
        assert not any(first in f for f in came.inputFiles())
        assert state.refresh() <= 4
        assert _same(state.groups(), recomputed())
    assert {r.g: r.a for r in state.averages("x", "a").collect()} == {
        r.g: None if r.a is None else round(r.a, 9) for r in dw.read("t").groupBy("g").agg(F.avg("x").alias("a")).collect()}
    dw.compact("t", "k")  # written whole: the state is computed anew
    assert dw.changes("t", dw.live(state.name).sources["t"]) is None
    state.refresh()
    assert _same(state.groups(), recomputed())
    assert state.repeated().first()[0] == recomputed().where("g IS NOT NULL AND n > 1").count()


# -- builds -----------------------------------------------------------------

def test_dimensions_read_each_table_once(spark, tmp_dir):
    raw = Warehouse(spark, tmp_dir, "raw")
    raw.write_many(raw_tables(spark, SF_SMALL), SOURCES)
    stg = staging({t: raw.read(t) for t in SOURCES})
    plan = dims.members(stg)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan parquet") == 5 and "partial_max" in plan
    together = dims.dimensions(stg, together=True)
    for name, alone in dims.dimensions(stg).items():
        assert _same(together[name], alone), name


def test_run_leaves_out_models_of_unchanged_raw_tables(spark, tmp_dir):
    raw, dw = Warehouse(spark, tmp_dir, "raw"), Warehouse(spark, tmp_dir, "dw")
    names = warehouse.DIMENSIONS + warehouse.FACTS
    raw.write_many(first_batch(raw_tables(spark, SF_SMALL)), SOURCES)
    tables = {t: raw.read(t) for t in SOURCES}
    first = warehouse.run(tables, dw, prints=raw.fingerprints(SOURCES))
    raw.write("manual_reviews", raw.read("manual_reviews").repartition(3))  # the same rows, written again
    files = _files(f"{tmp_dir}/dw")
    again = warehouse.run({t: raw.read(t) for t in SOURCES}, dw, full_refresh=False, prints=raw.fingerprints(SOURCES), only=names)
    assert again == {n: first[n] for n in names} and _files(f"{tmp_dir}/dw") == files
    raw.write("manual_reviews", raw_table(spark, SF_SMALL, "manual_reviews"))
    third = warehouse.run({t: raw.read(t) for t in SOURCES}, dw, full_refresh=False, prints=raw.fingerprints(SOURCES), only=names)
    assert third["fact_manual_reviews"] > first["fact_manual_reviews"] and dw.version("fact_conversations") == 1


# -- disk -------------------------------------------------------------------

def test_running_query_keeps_only_what_its_result_reads(spark, tmp_dir, monkeypatch):
    from qualis import catalog, session
    monkeypatch.setattr(catalog, "scratch_dir", lambda s, name="scratch": f"{tmp_dir}/{name}")
    monkeypatch.setattr(session, "scratch_dir", lambda s, name="scratch": f"{tmp_dir}/{name}")
    got = catalog.QUERIES["running_avg_score"](spark, SF_SMALL)
    want = catalog.QUERIES["avg_score_per_ticket"](spark, SF_SMALL)
    assert _same(want, got)
    dw = Warehouse(spark, f"{tmp_dir}/warehouse")
    for table in ("fact_autoqa_ratings", "fact_autoqa_ratings_by_external_ticket_id"):
        v = dw.live(table)
        named = {n for p in v.parts for n in (p.folder, f"{p.folder}.keys")} | {d.folder for d in v.deletes}
        assert set(os.listdir(f"{tmp_dir}/warehouse/dw/{table}")) == named  # no replaced part stays
    assert not os.path.exists(f"{tmp_dir}/rows")


def test_compaction_by_slices_and_packed_texts_keep_every_row(spark, tmp_dir, monkeypatch):
    from qualis.operators import lookup
    monkeypatch.setattr(layers, "COMPACT_SLICE_ROWS", 3)
    monkeypatch.setattr(lookup, "DIM_BROADCAST_MAX_ROWS", 0)
    md5 = "0123456789abcdef" * 2
    texts = [md5, md5.upper(), md5[:-1] + "\n", md5 + "\n", md5[:16], "", "\0" * 17, "é", "a", "b", "c", "d", None]
    old = [(t, t, float(i)) for i, t in enumerate(texts)] + [(None, "x", -1.0), ("a2", None, None)]
    new = [(t, t, None) for t in texts[:9]] + [(None, "new", 1.0), ("fresh", md5, 2.0)]
    kind = "k string, t string, v double"
    dw = Warehouse(spark, tmp_dir)
    dw.write("t", spark.createDataFrame(old, kind), key="k")
    dw.upsert("t", spark.createDataFrame(new, kind), "k", len(new))
    want = sorted(map(str, [r for r in old if r[0] is None or r[0] not in texts[:9]] + new))
    assert len(dw.live("t").parts) == 4 and not dw.live("t").deletes and dw.rows("t") == len(want)
    for back in (dw, Warehouse(spark, tmp_dir)):
        assert sorted(str(tuple(r)) for r in back.read("t").collect()) == want
    dw.upsert("t", spark.createDataFrame([("fresh", "again", 3.0)], kind), "k", 1)
    assert dw.live("t").deletes and sorted(map(str, dw.read("t").where("k = 'fresh'").collect())) == ["Row(k='fresh', t='again', v=3.0)"]


def test_every_signup_day_has_its_folder_however_many_there_are(spark, tmp_dir):
    raw = Warehouse(spark, tmp_dir, "raw")
    rows = spark.range(1200).selectExpr("concat('sub-', id) AS subscription_id", f"date_from_unix_date(CAST(nullif(id, 7) AS INT)) AS {SIGNUP_DAY}").repartition(2)
    assert load_subscriptions(rows, raw) == 1200
    assert {p.column for p in raw.live(SUBSCRIPTIONS).parts} == {SIGNUP_DAY} and len(raw.live(SUBSCRIPTIONS).parts) == 1200
    for back in (raw, Warehouse(spark, tmp_dir, "raw")):
        assert _same(back.read(SUBSCRIPTIONS), rows)
    days = {str(dt.date(1970, 1, 2)), None}
    again = spark.createDataFrame([("sub-1", dt.date(1970, 1, 2)), ("sub-new", None)], rows.schema)
    assert raw.replace_values(SUBSCRIPTIONS, again, SIGNUP_DAY, days) == 1200
    assert _same(raw.read(SUBSCRIPTIONS), rows.where("subscription_id NOT IN ('sub-1', 'sub-7')").unionByName(again))
