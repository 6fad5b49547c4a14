import hashlib
import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from qualis.llm.cuckoo import CuckooIndex
from qualis.llm.exact import build_index, dedup, digests, lookup, update_index


def _digest(x):
    return hashlib.sha256(str(x).encode()).digest()


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("pdg"), st.integers(0, 60)), max_size=300))
def test_cuckoo_index_acts_like_a_dict(changes):
    index, model = CuckooIndex(1), {}
    for i, (what, x) in enumerate(changes):
        key = _digest(x)
        if what == "p":
            index.put(key, i)
            model[key] = i
        elif what == "d":
            assert index.delete(key) == (model.pop(key, None) is not None)
        assert index.get(key) == model.get(key)
    assert dict(index.items()) == model and index.n == len(model)
    assert dict(CuckooIndex.load(index.dump()).items()) == model


def test_overflow_resizes_and_keeps_every_digest():
    index, keys = CuckooIndex(1), [_digest(i) for i in range(20_000)]
    # digests that share a fingerprint and bucket compete for eight slots
    keys += [b"\x07\x07\0\0" + b"\x01" * 8 + i.to_bytes(20, "big") for i in range(8)]
    random.Random(1).shuffle(keys)
    for i, k in enumerate(keys):
        index.put(k, i)
    assert all(index.get(k) == i for i, k in enumerate(keys)) and index.n == len(keys)
    assert not any(index.get(_digest(-i)) for i in range(1, 2000))


def _lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def _brute(rows):
    ids = defaultdict(list)
    for d, t in rows:
        ids[_lower(t)].append(d)
    keep = {t: max((d for d in own if d is not None), default=None) for t, own in ids.items()}
    return sorted(str((d, keep[_lower(t)], len(ids[_lower(t)]), d == keep[_lower(t)], hashlib.sha256(_lower(t).encode()).hexdigest())) for d, t in rows)


def test_dedup_matches_brute_force(spark):
    texts = ["Same", "same", "SAME é", "same É", "", None, "x" * 5000]
    rows = [(i, texts[i * 31 % 7] if i % 5 else f"{texts[i % 5]}{i % 11}") for i in range(400)]
    rows += [(None, "SAME"), (None, "alone"), (3, "twice"), (3, "twice"), (3, "other")]
    docs = spark.createDataFrame([(*r, b"x", 1) for r in rows], "doc_id long, text string, digest binary, keep_id int")
    got = dedup(docs).collect()
    assert sorted(str(tuple(r)) for r in got) == _brute(rows)
    assert dedup(docs.limit(0)).count() == 0


def test_index_takes_insertions_and_deletions(spark):
    docs = spark.createDataFrame([(i, f"text {i % 50}") for i in range(100)], "doc_id long, text string")
    index = build_index(docs, 4)
    assert index.agg(F.sum("entries")).first()[0] == 50
    gone = digests(docs.where("doc_id % 50 < 10")).withColumn("live", F.lit(False))
    new = digests(spark.createDataFrame([(500, "text 20"), (501, "new")], "doc_id long, text string")).withColumn("live", F.lit(True))
    rows = index.collect()
    index = update_index(spark.createDataFrame(rows, index.schema), gone.unionByName(new), 4)
    found = lookup(index, digests(docs).unionByName(new.drop("live")), 4).collect()
    assert len(found) == 41
    by = {bytes(r.digest): (r.keep_id, r.group_size) for r in found}
    assert by[_digest("text 20")] == (500, 3) and by[_digest("new")] == (501, 1) and by[_digest("text 30")] == (80, 2)


def test_query_matches_its_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    from qualis.llm import exact

    path = "/root/testdata/sf0.01"
    got = exact.query(spark, path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet'")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({exact.ORACLE})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
