import datetime as dt

import pytest
from pyspark.sql import functions as F

from qualis.operators.incremental import only_new_keys, since_watermark, sync_columns, upsert
from qualis.operators.merge import merge_when_changed


def _keys(df, col="k"):
    return sorted((r[col] for r in df.collect()), key=lambda x: (x is None, x))


def test_new_keys_empty_target_passes_everything(spark):
    src = spark.createDataFrame([(1,), (None,)], "k bigint")
    tgt = spark.createDataFrame([], "k bigint")
    assert _keys(only_new_keys(src, tgt, "k")) == [1, None]


def test_new_keys_drop_null_source_key(spark):
    src = spark.createDataFrame([(1,), (2,), (None,)], "k bigint")
    tgt = spark.createDataFrame([(1,)], "k bigint")
    assert _keys(only_new_keys(src, tgt, "k")) == [2]


def test_new_keys_null_in_target_passes_nothing(spark):
    src = spark.createDataFrame([(1,), (2,)], "k bigint")
    tgt = spark.createDataFrame([(1,), (None,)], "k bigint")
    assert only_new_keys(src, tgt, "k").count() == 0


def _ts(s):
    return dt.datetime.fromisoformat(s)


def test_watermark_skips_equal_and_older_rows(spark):
    tgt = spark.createDataFrame([(1, _ts("2024-01-02 00:00:00"))], "k bigint, updated_at timestamp_ntz")
    src = spark.createDataFrame([(2, _ts("2024-01-02 00:00:00")), (3, _ts("2024-01-01 00:00:00")),
                                 (4, _ts("2024-01-03 00:00:00")), (5, None)], "k bigint, updated_at timestamp_ntz")
    assert _keys(since_watermark(src, tgt)) == [4]


def test_watermark_empty_target(spark):
    tgt = spark.createDataFrame([], "k bigint, updated_at timestamp_ntz")
    src = spark.createDataFrame([(1, _ts("1950-01-01 00:00:00")), (2, _ts("1899-01-01 00:00:00")), (3, None)],
                                "k bigint, updated_at timestamp_ntz")
    assert _keys(since_watermark(src, tgt)) == [1]


def test_sync_columns(spark):
    tgt = spark.createDataFrame([(1, "old")], "k bigint, gone string")
    src = spark.createDataFrame([(2, 2.5)], "k bigint, added double")
    out = sync_columns(tgt, src.schema)
    assert out.columns == ["k", "added"] and out.first().added is None


def test_upsert_replaces_and_inserts(spark):
    tgt = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k bigint, v string")
    new = spark.createDataFrame([(2, "B"), (3, "c"), (None, "m")], "k bigint, v string")
    got = sorted((r.k or 0, r.v) for r in upsert(tgt, new, "k").collect())
    assert got == [(0, "m"), (0, "n"), (1, "a"), (2, "B"), (3, "c")]


def test_upsert_two_rows_for_one_target_row_is_an_error(spark):
    tgt = spark.createDataFrame([(1, "a")], "k bigint, v string")
    new = spark.createDataFrame([(1, "x"), (1, "y")], "k bigint, v string")
    with pytest.raises(Exception):
        upsert(tgt, new, "k").collect()


def test_upsert_duplicates_without_target_are_all_inserted(spark):
    tgt = spark.createDataFrame([(1, "a")], "k bigint, v string")
    new = spark.createDataFrame([(5, "x"), (5, "y")], "k bigint, v string")
    assert upsert(tgt, new, "k").count() == 3


MERGE_SCHEMA = "id string, t1 bigint, t2 bigint, v bigint, keep string"


def _merge(spark, target_rows, source_rows):
    t = spark.createDataFrame(target_rows, MERGE_SCHEMA)
    s = spark.createDataFrame(source_rows, MERGE_SCHEMA)
    out = merge_when_changed(t, s, "id", ("t1", "t2"), ("keep",))
    return sorted((tuple(r) for r in out.collect()), key=lambda r: (r[0] is None, r[0] or "", r[3] or 0))


def test_merge_updates_changed_rows_only(spark):
    target = [("a", 1, 1, 10, "t"), ("b", 1, 1, 10, "t"), ("c", 1, 1, 10, "t"), ("d", 1, 1, 10, "t")]
    source = [("a", 2, 1, 11, "s"),        # changed: updated, keep column stays
              ("b", None, None, 15, "s"),  # NULL times: not a change
              ("c", 1, 1, 19, "s"),        # equal times: unchanged
              ("e", 1, 1, 1, "s")]         # new: inserted
    assert _merge(spark, target, source) == [
        ("a", 2, 1, 11, "t"), ("b", 1, 1, 10, "t"), ("c", 1, 1, 10, "t"), ("d", 1, 1, 10, "t"),
        ("e", 1, 1, 1, "s")]


def test_merge_two_changed_source_rows_is_an_error(spark):
    with pytest.raises(Exception):
        _merge(spark, [("a", 1, 1, 1, "t")], [("a", 2, 1, 1, "s"), ("a", 3, 1, 1, "s")])


def test_merge_duplicate_new_keys_both_inserted_and_null_keys_insert(spark):
    got = _merge(spark, [("a", 1, 1, 1, "t")], [("z", 1, 1, 1, "s"), ("z", 1, 1, 2, "s"), (None, 1, 1, 3, "s")])
    assert len(got) == 4 and got[-1][0] is None


def test_upsert_with_measured_small_batch_broadcasts_keys(spark):
    tgt = spark.createDataFrame([(i, "t") for i in range(100)], "k bigint, v string")
    new = spark.createDataFrame([(5, "n"), (500, "n")], "k bigint, v string")
    out = upsert(tgt, new, "k", new_rows_count=2)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" in plan
    got = dict((r.k, r.v) for r in out.collect())
    assert len(got) == 101 and got[5] == "n" and got[500] == "n" and got[6] == "t"
    dup = spark.createDataFrame([(5, "x"), (5, "y")], "k bigint, v string")
    with pytest.raises(Exception):
        upsert(tgt, dup, "k", new_rows_count=2).collect()


def test_merge_with_measured_small_batch_is_map_side(spark):
    t = spark.createDataFrame([(f"k{i}", 1, 1, i, "t") for i in range(50)], MERGE_SCHEMA)
    s = spark.createDataFrame([("k3", 2, 1, 99, "s"), ("new", 1, 1, 7, "s")], MERGE_SCHEMA)
    out = merge_when_changed(t, s, "id", ("t1", "t2"), ("keep",), source_rows=2)
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    got = {r.id: (r.t1, r.v, r.keep) for r in out.collect()}
    assert len(got) == 51 and got["k3"] == (2, 99, "t") and got["new"] == (1, 7, "s") and got["k4"] == (1, 4, "t")


def test_sync_columns_casts_retyped_columns(spark):
    tgt = spark.createDataFrame([(1, 7)], "k bigint, v bigint")
    new = spark.createDataFrame([(2, "x")], "k bigint, v string")
    assert sorted((r.k, r.v) for r in upsert(tgt, new, "k").collect()) == [(1, "7"), (2, "x")]


def test_merge_updates_each_target_row_of_a_key(spark):
    target = [("a", 1, 1, 1, "t"), ("a", 1, 1, 2, "u"), ("a", 2, 1, 3, "v")]
    assert _merge(spark, target, [("a", 2, 1, 9, "s")]) == [
        ("a", 2, 1, 3, "v"), ("a", 2, 1, 9, "t"), ("a", 2, 1, 9, "u")]


def test_merge_reads_the_whole_target_once(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    spark.createDataFrame([(f"k{i}", 1, 1, i, "t") for i in range(9)], MERGE_SCHEMA).write.parquet(path)
    s = spark.createDataFrame([("k3", 2, 1, 99, "s")], MERGE_SCHEMA)
    plan = merge_when_changed(spark.read.parquet(path), s, "id", ("t1", "t2"), ("keep",), 1)._jdf.queryExecution().sparkPlan().toString()
    # rows with a key and rows without one, each by a pushed filter
    assert plan.count("FileScan parquet") == 2 and "IsNotNull(id)" in plan and "IsNull(id)" in plan
