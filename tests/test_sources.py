import os

import pytest

from qualis import schemas
from qualis.sources import fixtures
from qualis.sources.csv_source import read_csv
from qualis.sources.json_source import read_json_documents, read_json_lines
from qualis.sources.layers import Warehouse

HEADER = ",".join(schemas.columns("autoqa_root_cause"))


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_csv_quotes_newlines_and_missing_tokens(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "autoqa_root_cause_test - autoqa_root_cause_test.csv"),
               HEADER + "\n"
               'rt-1,1.0,2.0,"says ""hi"", then\nleaves"\n'
               "rt-2,,N/A,N/A\n"
               "rt-3,3.0\n")
    rows = sorted(read_csv(spark, p, "autoqa_root_cause").collect(), key=lambda r: r.autoqa_rating_id)
    assert rows[0].root_cause == 'says "hi", then\nleaves' and rows[0]["count"] == 2.0
    assert rows[1].category is None and rows[1]["count"] is None and rows[1].root_cause is None
    assert rows[2].category == 3.0 and rows[2]["count"] is None  # short row padded


def test_csv_long_row_is_an_error(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "long.csv"), HEADER + "\nrt-1,1.0,2.0,x,extra\n")
    with pytest.raises(Exception):
        read_csv(spark, p, "autoqa_root_cause").collect()


def test_csv_untypable_cell_is_an_error(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "bad.csv"), HEADER + "\nrt-1,abc,2.0,x\n")
    with pytest.raises(Exception):
        read_csv(spark, p, "autoqa_root_cause").collect()


LEGACY = ("{'list': [{'subscription': {'id': 'sub-1', 'billing_period': 1, 'deleted': False, "
          "'subscription_items': '[{'id': 'i1', 'quantity': 2}]', 'updated_at': 1710000001}, "
          "'customer': {'id': 'cus-1', 'first_name': 'Ann', 'created_at': 1700000000, "
          "'allow_direct_debit': True, 'billing_address': {'city': 'Tallinn', 'zip': '10111'}}}]}")


def test_legacy_json_document(spark, tmp_dir):
    d = os.path.join(tmp_dir, "docs")
    os.makedirs(d)
    _write(os.path.join(d, "a.json"), LEGACY)
    _write(os.path.join(d, "b.json"), LEGACY.replace("sub-1", "sub-2"))
    rows = sorted(read_json_documents(spark, d).collect(), key=lambda r: r.subscription_id)
    assert [r.subscription_id for r in rows] == ["sub-1", "sub-2"]
    r = rows[0]
    assert r.subscription_deleted is False and r.customer_allow_direct_debit is True
    assert r.customer_billing_address_city == "Tallinn" and r.subscription_subscription_items[0].quantity == 2
    assert str(r.dt_customer_signup_date) == "2023-11-14"
    assert len(rows[0]) == len(schemas.columns("customer_subscriptions"))


def test_apostrophe_in_legacy_value_fails(spark, tmp_dir):
    d = os.path.join(tmp_dir, "bad")
    os.makedirs(d)
    _write(os.path.join(d, "a.json"), LEGACY.replace("'Ann'", "'O'Brien'"))
    with pytest.raises(Exception):
        read_json_documents(spark, d).collect()


def test_valid_json_lines_twin(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "lines.json"),
               '{"subscription": {"id": "sub-1", "updated_at": 5}, "customer": {"id": "cus-1", '
               '"created_at": 1700000000, "billing_address": {"city": "Tartu"}}}\n')
    r = read_json_lines(spark, p).first()
    assert r.subscription_id == "sub-1" and r.customer_billing_address_city == "Tartu"


def test_warehouse_versions_and_empty_guard(spark, tmp_dir):
    wh = Warehouse(spark, tmp_dir, "raw")
    assert not wh.exists("t")
    assert wh.write("t", spark.createDataFrame([(1,), (2,)], "k bigint")) == 2
    assert wh.version("t") == 1
    assert wh.write("t", spark.createDataFrame([], "k bigint")) == 0  # untouched
    assert wh.version("t") == 1 and wh.read("t").count() == 2
    # an upsert reads the live version and writes the next one
    from qualis.operators.incremental import upsert
    assert wh.write("t", upsert(wh.read("t"), spark.createDataFrame([(3,)], "k bigint"), "k")) == 3
    assert wh.version("t") == 2 and wh.read("t").count() == 3


def test_registered_tables_run_warehouse_sql(spark, tmp_dir):
    """Weighted scores, as SQL over the registered raw table, equal the DataFrame metric."""
    from qualis.plans.metrics import weighted_score
    from qualis.sources.fixtures import raw_table
    from conftest import SF_SMALL

    wh = Warehouse(spark, tmp_dir, "raw")
    wh.write("manual_rating", raw_table(spark, SF_SMALL, "manual_rating"))
    assert "raw.manual_rating" in wh.register()
    sql = spark.sql("""
        SELECT review_id, if(sum(w) = 0, 0D, 100 * sum(p) / sum(w)) AS final_score_percentage
        FROM (SELECT review_id, if(rating = 42, 0, weight) AS w, if(rating = 42, 0, rating / rating_max * weight) AS p
              FROM raw.manual_rating)
        GROUP BY review_id""")
    want = {r.review_id: r.final_score_percentage for r in weighted_score(wh.read("manual_rating")).collect()}
    got = {r.review_id: (None if r.final_score_percentage is None else round(r.final_score_percentage, 9))
           for r in sql.collect()}
    assert got == want


def test_python_none_in_legacy_document_fails(spark, tmp_dir):
    """The legacy repair does not translate None, so such a document does not parse."""
    d = os.path.join(tmp_dir, "none")
    os.makedirs(d)
    _write(os.path.join(d, "a.json"), LEGACY.replace("'Ann'", "None"))
    with pytest.raises(Exception):
        read_json_documents(spark, d).collect()


def test_csv_header_count_and_narrow_selects(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "ok.csv"), HEADER + "\nrt-1,1.0,2.0,x\nrt-2,1.0\n")
    df = read_csv(spark, p, "autoqa_root_cause")
    assert df.count() == 2 and not df.isEmpty()
    names = schemas.columns("autoqa_root_cause")
    swapped = _write(os.path.join(tmp_dir, "swapped.csv"), ",".join([names[0], names[2], names[1], names[3]]) + "\nrt-1,1.0,2.0,x\n")
    with pytest.raises(Exception):
        read_csv(spark, swapped, "autoqa_root_cause").collect()
    long = _write(os.path.join(tmp_dir, "long2.csv"), HEADER + "\nrt-1,1.0,2.0,x,extra\n")
    for multiline in (True, False):
        with pytest.raises(Exception):
            read_csv(spark, long, "autoqa_root_cause", multiline).select(names[0]).collect()


def test_document_without_list_fails(spark, tmp_dir):
    d = os.path.join(tmp_dir, "nolist")
    os.makedirs(d)
    _write(os.path.join(d, "a.json"), "{'items': []}")
    with pytest.raises(Exception):
        read_json_documents(spark, d).collect()


def test_empty_rebuild_replaces_and_partitions_register(spark, tmp_dir):
    dw = Warehouse(spark, tmp_dir, "dw")
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "k bigint, day string")
    assert dw.write("t", rows) == 3
    assert dw.write("t", rows.filter("k < 0")) == 0
    assert dw.read("t").count() == 0
    raw = Warehouse(spark, tmp_dir, "raw")
    raw.write("p", rows, partition_by="day")
    raw.register()
    assert spark.table("raw.p").count() == 3


def test_strict_timestamps(spark):
    from qualis.functions.times import strict_ts

    def at(text):
        return str(spark.createDataFrame([(text,)], "t string").select(strict_ts("t")).first()[0])

    assert at("2024-01-01 00:00:00") == "2024-01-01 00:00:00"
    assert at("2024-01-01 00:00:00+02:00") == "2023-12-31 22:00:00"
    assert at("2024-01-01T10:00:00.5Z") == "2024-01-01 10:00:00.500000"
    assert at("2024-01-01") == "2024-01-01 00:00:00" and at(None) == "None"
    for bad in ("2024", "2024-01", "soon"):
        with pytest.raises(Exception):
            at(bad)


def test_append_writes_new_rows_only(spark, tmp_dir):
    dw = Warehouse(spark, tmp_dir, "dw")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, v string")
    dw.write("t", rows)
    first = dw.paths("t")
    assert dw.append("t", spark.createDataFrame([(3, "c")], "k bigint, v string")) == 1
    assert dw.paths("t")[:1] == first and len(dw.paths("t")) == 2
    assert dw.append("t", rows.filter("k < 0")) == 0 and dw.version("t") == 2 and dw.rows("t") == 3
    again = Warehouse(spark, tmp_dir, "dw")
    assert sorted(r.k for r in again.read("t").collect()) == [1, 2, 3]
    again.register()
    assert spark.table("dw.t").count() == 3
    again.write("t", rows)  # the view gives way to a table
    again.register()
    assert spark.table("dw.t").count() == 2


def test_second_writer_of_a_version_fails(spark, tmp_dir):
    rows = spark.createDataFrame([(1,)], "k bigint")
    one, two = Warehouse(spark, tmp_dir, "dw"), Warehouse(spark, tmp_dir, "dw")
    one.write("t", rows)
    with pytest.raises(Exception):
        two.write("t", rows)
    two.refresh()
    assert two.write("t", rows) == 1 and two.version("t") == 2


def test_staging_views_read_the_raw_tables(spark, tmp_dir):
    from conftest import SF_SMALL
    from qualis.plans.staging import register_views
    from qualis.sources.fixtures import raw_table

    raw = Warehouse(spark, tmp_dir, "raw")
    raw.write("autoqa_root_cause", raw_table(spark, SF_SMALL, "autoqa_root_cause"))
    raw.register()
    assert "refined.stg_autoqa_root_cause" in register_views(spark)
    want = raw.read("autoqa_root_cause").filter("autoqa_rating_id IS NOT NULL").count()
    assert spark.table("refined.stg_autoqa_root_cause").count() == want > 0


@pytest.mark.parametrize("table, source, tasks", [("customer_subscriptions", "customer", 4), ("autoqa_ratings", "lineitem", 7)])
def test_input_is_spread_by_its_rows(spark, monkeypatch, table, source, tasks):
    from conftest import SF_SMALL
    want = sorted(map(str, fixtures.raw_table(spark, SF_SMALL, table).collect()))
    monkeypatch.setattr(fixtures, "SUBSCRIPTIONS_A_TASK", 50)
    monkeypatch.setattr(fixtures, "JOINED_ROWS_A_TASK", 1_000)
    tables = {s: fixtures.driver_table(spark, SF_SMALL, s) for s in fixtures.SOURCES[table]}
    assert max(df.count() for df in tables.values()) == tables[source].count()
    assert {df.rdd.getNumPartitions() for df in fixtures._spread(table, tables).values()} == {tasks}
    assert sorted(map(str, fixtures.raw_table(spark, SF_SMALL, table).collect())) == want
