"""Property tests: operators against pure-Python models of the SQL semantics."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from qualis.operators.incremental import only_new_keys, upsert
from qualis.operators.merge import merge_when_changed

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
keys = st.one_of(st.none(), st.integers(0, 4))
small = st.one_of(st.none(), st.integers(0, 2))


def _not_in(s, target):
    """SQL ``s NOT IN (target)`` as keep/drop."""
    if not target:
        return True
    if s is None:
        return False
    if s in target:
        return False
    return None not in target


@SETTINGS
@given(src=st.lists(keys, max_size=6), tgt=st.lists(keys, max_size=5))
def test_only_new_keys_is_sql_not_in(spark, src, tgt):
    s = spark.createDataFrame([(k, i) for i, k in enumerate(src)], "k bigint, i int")
    t = spark.createDataFrame([(k,) for k in tgt], "k bigint")
    got = sorted(r.i for r in only_new_keys(s, t, "k").collect())
    assert got == [i for i, k in enumerate(src) if _not_in(k, tgt)]


@SETTINGS
@given(tgt=st.lists(keys, max_size=5, unique=True), new=st.lists(keys, max_size=5))
def test_upsert_is_keyed_merge(spark, tgt, new):
    t = spark.createDataFrame([(k, f"t{i}") for i, k in enumerate(tgt)], "k bigint, v string")
    n = spark.createDataFrame([(k, f"n{i}") for i, k in enumerate(new)], "k bigint, v string")
    counts = Counter(k for k in new if k is not None)
    if any(c > 1 and k in tgt for k, c in counts.items()):
        with pytest.raises(Exception):
            upsert(t, n, "k").collect()
        return
    want = [(k, f"t{i}") for i, k in enumerate(tgt) if k is None or k not in counts]
    want += [(k, f"n{i}") for i, k in enumerate(new)]
    got = [(r.k, r.v) for r in upsert(t, n, "k", new_rows_count=len(new)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def _changed(t, s):
    a = None if t[1] is None or s[1] is None else t[1] != s[1]
    b = None if t[2] is None or s[2] is None else t[2] != s[2]
    return a is True or b is True


@SETTINGS
@given(tgt=st.lists(st.tuples(keys, small, small, st.integers(0, 9)), max_size=5,
                    unique_by=lambda r: r[0] if r[0] is not None else object()),
       src=st.lists(st.tuples(keys, small, small, st.integers(0, 9)), max_size=5))
def test_merge_when_changed_model(spark, tgt, src):
    schema = "id bigint, t1 bigint, t2 bigint, v bigint, keep string"
    t = spark.createDataFrame([r + ("t",) for r in tgt], schema)
    s = spark.createDataFrame([r + ("s",) for r in src], schema)
    by_key = {r[0]: r for r in tgt if r[0] is not None}
    updates: dict = {}
    for r in src:
        if r[0] in by_key and _changed(by_key[r[0]], r):
            updates.setdefault(r[0], []).append(r)
    out = merge_when_changed(t, s, "id", ("t1", "t2"), ("keep",), source_rows=len(src) if len(src) % 2 else None)
    if any(len(v) > 1 for v in updates.values()):
        with pytest.raises(Exception):
            out.collect()
        return
    want = []
    for r in tgt:
        u = updates.get(r[0]) if r[0] is not None else None
        want.append((r[0],) + (u[0][1:] if u else r[1:]) + ("t",))
    want += [r + ("s",) for r in src if r[0] is None or r[0] not in by_key]
    got = [tuple(r) for r in out.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
