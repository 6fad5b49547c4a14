from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline

from qualis.llm.neardup import THRESHOLD, similarity

PATH = "/root/testdata/sf0.001"


def test_stages_keep_their_promises(spark):
    docs = spark.read.parquet(f"{PATH}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, PATH).cache()
        kept[name] = out.collect()
        if name != "packing":
            assert out.columns == columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
            docs = out
    filtered, deduped, apart, mixed, packed = kept.values()
    assert filtered and all(len(r.text.split()) >= 50 for r in filtered)
    lines = [x for r in deduped for x in r.text.split("\n") if x.strip()]
    assert len(lines) == len(set(lines)) and all(r.n_chars == len(r.text) for r in deduped)
    texts = [r.text for r in apart]
    assert not any(similarity(a, b) >= THRESHOLD for i, a in enumerate(texts) for b in texts[:i])
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in apart}
    assert {r.doc_id for r in packed} == {r.doc_id for r in mixed}
    assert sum(r.start == 0 for r in packed) == len(mixed)


def test_registered_with_the_operators():
    queries = entry.queries()
    assert "pipeline" in queries and [n for n in range(1, 11) if not any(q.startswith(f"op{n}_") for q in queries)] == []
    assert set(entry.oracle_sql()) <= set(queries)


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{PATH}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, PATH)
    assert docs.count() == 0


def test_like_rows_share_their_copies(spark):
    # weights 1 and 2 of sources of 600 and 300 words: source a takes half of its size
    rows = [(None, " ".join([f"w{i % 40}", *["x"] * 5]), "a") for i in range(70)] + [(1, "one text of six words here", "a")] * 30 + [(9 + i, "b " * 6, "b") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = corpus_pipeline.mix_sources(spark, docs, PATH)
    target = {r.source: r.target / 6 for r in corpus_pipeline.mixing.mix(docs, carry=True).collect()}
    taken = [r.source for r in got.collect()]
    assert 0 < target["a"] < 100
    for s in "ab":
        assert abs(taken.count(s) - target[s]) <= 1
    again = corpus_pipeline.mix_sources(spark, docs.repartition(3), PATH).collect()
    assert sorted(map(str, got.collect())) == sorted(map(str, again))


def test_one_row_of_each_near_duplicate_class_stays(spark):
    words = lambda k: " ".join(f"{k}{i}" for i in range(60))
    rows = [(None, words("a"))] * 20 + [(None, words("a") + " end")] + [(5, words("b"))] * 3 + [(5, words("b") + " end"), (6, words("b"))] + [(7, words("c")), (8, None), (8, None)]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, n int")
    got = corpus_pipeline.near_dedup(spark, docs, PATH)
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0, (r.text or "-")[0]) for r in got.collect()) == [(0, "a"), (5, "b"), (7, "c"), (8, "-")]


CLASHING = ("n_words", "kept", "rule", "base_failed", "_gone", "_text_key", "_words", "_share", "_copy", "copies", "n", "label", "id", "size", "row", "class_key", "KEPT_too")


def test_columns_of_any_name_pass_through_every_stage(spark):
    docs = spark.read.parquet(f"{PATH}/documents.parquet").limit(120).drop("n_chars", "lang")
    for i, name in enumerate(CLASHING):
        docs = docs.withColumn(name, F.concat(F.lit(f"{i}-"), F.col("doc_id")))
    docs = docs.unionByName(docs.limit(2)).cache()  # repeated rows
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, PATH).cache()
        rows = docs.collect()
        assert docs.columns == ["doc_id", "text", "source", *CLASHING], name
        assert 0 < len(rows) and (name != "quality rules" or len(rows) < n)
        assert all(r[c] == f"{i}-{r.doc_id}" for r in rows for i, c in enumerate(CLASHING)), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, PATH).count() >= len(rows)


def test_stages_without_ids_or_sources(spark):
    text = " ".join(f"w{i}" for i in range(70))
    docs = spark.createDataFrame([(text, "x"), (text, "x"), (f"{text} more words at the end", "y"), (None, "z"), ("", "z")], "text string, kept string")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, PATH)
        assert docs.columns == ["text", "kept"]
    assert {r.kept for r in docs.collect()} <= {"x", "y"} and docs.count() >= 1
