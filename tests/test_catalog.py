"""Driver contract: every query of the catalog has an oracle; entry() is the flagship."""

import __spark_entry__ as entry


def test_every_query_has_an_oracle():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    # the optional training-data queries that SQL cannot express are held against brute force in tests/llm
    assert set(q) - set(o) <= set(entry.LLM_QUERIES)
    assert len(set(q) - set(entry.LLM_QUERIES)) >= 52


def test_oracles_inline_their_inputs():
    # oracles read only the driver's tables (as q_<table> CTEs), never our outputs
    for name, sql in entry.oracle_sql().items():
        assert sql.lstrip().upper().startswith("WITH"), name


def test_entry_schema_is_stable(spark):
    df = entry.entry(spark)
    assert [f.name for f in df.schema.fields] == ["review_id", "final_score_percentage"]
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["bigint", "double"]


def test_test_modules_have_names_of_their_own():
    # two modules of one name keep each other from being collected
    import collections
    import pathlib

    names = collections.Counter(p.name for p in pathlib.Path(__file__).parent.rglob("test_*.py"))
    assert not [n for n, k in names.items() if k > 1]
