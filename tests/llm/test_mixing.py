import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from qualis.llm import mixing
from qualis.llm.mixing import mix

SCHEMA = "doc_id long, text string, source string, size string, target string"


def _docs(spark, rows):
    return spark.createDataFrame([(*r, "x", None) for r in rows], SCHEMA)


def _targets(sizes):
    """Share by weight; while a source is above three times its size, fix it there and share the rest again."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    fixed, total = {}, sum(sizes.values())
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if share[s] > 3 * sizes[s]]
        if not above:
            return fixed | share
        fixed |= {s: 3 * sizes[s] for s in above}


def _check(rows, docs):
    words = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in docs]
    assert Counter((r.doc_id, r.size) for r in rows) == Counter((d[0], n) for d, n in zip(docs, words))
    sizes = defaultdict(int)
    for (_, _, s), n in zip(docs, words):
        sizes[s] += n
    targets = _targets(sizes) if sum(sizes.values()) else dict.fromkeys(sizes, 0.0)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        rate = r.target / r.source_size if r.source_size else 0
        assert r.taken in ({r.size * int(rate + 1e-9), r.size * (int(rate - 1e-9) + 1)} if r.size else {0})
        assert r.taken <= 3 * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= largest[s] + 1e-6


def test_targets_and_rounding(spark):
    docs = [(i, "w " * (i * 7919 % 50), ["a", "b", "B", "é", None, "hot", "hot", "hot", "hot"][i % 9]) for i in range(3000)]
    docs += [(9000 + i, "w " * 400, "tiny") for i in range(2)]
    first = mix(_docs(spark, docs), carry=True).collect()
    _check(first, docs)
    again = mix(_docs(spark, docs).repartition(7), carry=True).collect()
    assert sorted(map(str, first)) == sorted(map(str, again))


def test_choice_is_random_but_the_mass_is_kept(spark):
    docs = [(i, "w " * (5 + i % 3), "a") for i in range(40)] + [(100 + i, "w " * 50, "b") for i in range(10)]
    chosen = []
    for seed in (1, 1000):
        rows = mix(_docs(spark, docs), seed=seed).collect()
        _check(mix(_docs(spark, docs), seed=seed, carry=True).collect(), docs)
        chosen.append(frozenset((r.doc_id, r.copies) for r in rows))
    assert chosen[0] != chosen[1]


def test_nulls_repeats_and_empty(spark):
    docs = [(1, None, "a"), (None, "x y", "a"), (None, "x y", "a"), (2, "", None), (3, "p q r", "a")] + [(7, "like rows", "r")] * 31
    _check(mix(_docs(spark, docs), carry=True).collect(), docs)
    assert mix(_docs(spark, [])).count() == 0
    _check(mix(_docs(spark, [(1, None, None)]), carry=True).collect(), [(1, None, None)])


def test_query(spark):
    path = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    source = {d: s for d, _, s in docs}
    got = mixing.query(spark, path)
    assert got.columns[:5] == ["doc_id", "size", "source_size", "target", "copies"]
    _check([type("R", (), r.asDict() | {"source": source[r.doc_id]}) for r in got.collect()], docs)


def test_very_many_like_rows_are_dealt_over_tasks(spark):
    n = 300_000
    docs = spark.range(n).select(F.lit(None).cast("long").alias("doc_id"), F.lit("two words").alias("text"), F.lit("a").alias("source"))
    docs = docs.unionByName(spark.createDataFrame([(1, "b " * (n // 2), "b"), (2, "", "b")], docs.schema))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions stay apart
    got = mix(docs)
    found = got.groupBy(F.spark_partition_id().alias("p"), "doc_id", "size").agg(F.count(F.lit(1)).alias("rows"), F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    like = [r for r in found if r["size"] == 2]
    assert sum(r.rows for r in like) == n and max(r.rows for r in like) < n // 2
    assert abs(sum(r.taken for r in like) - like[0].target) <= 2
