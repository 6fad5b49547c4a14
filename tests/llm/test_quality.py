import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from qualis.llm import quality
from qualis.llm.quality import COUNTS, Condition, DecisionList, features, fit, judge, learn, text_counts, with_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _brute(text):
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)}
    lines, dup = [], 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.append(line)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab é#|\n\t\x0b\x1c\x85　.A1"), max_size=60))
def test_counts_match_their_definition(text):
    got = dict(zip(COUNTS, text_counts(text)))
    assert (got["n_words"], got["word_chars"], got["n_symbols"], got["n_dup_lines"], got["n_repeat_words"]) == _brute(text)


def test_learned_list_separates_held_out_rows():
    rng = np.random.default_rng(1)
    n = 4000
    x = {"a": rng.random(n), "b": rng.random(n), "c": rng.random(n)}
    bad = ((x["a"] > 0.8) & (x["b"] < 0.3)) | (x["c"] < 0.05)
    part = rng.random(n) < 0.5
    test = rng.random(n) < 0.3
    rules = learn({k: v[~test] for k, v in x.items()}, bad[~test], part[~test])
    verdict = rules.mask({k: v[test] for k, v in x.items()})
    assert (verdict == bad[test]).mean() > 0.98 and len(rules.rules) >= 2


def test_list_is_an_ordered_expression(spark):
    rules = DecisionList(((Condition("words", True, 100.0),), (Condition("symbol_share", True, 0.5), Condition("words", False, 10.0))))
    docs = spark.createDataFrame([(1, "a " * 100), (2, "## #a"), (3, "plain words")], "doc_id long, text string")
    assert {r.doc_id: r.rule for r in judge(docs, rules, carry=("doc_id",)).collect()} == {1: 1, 2: 2, 3: None}
    assert "1. reject if words >= 100" in str(rules)


def test_nulls_empty_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, None, 5), (None, "", 6), (2, "w " * 60, 7)], "doc_id long, text string, n_words int").drop("n_words")
    docs = docs.withColumn("label", docs.doc_id).withColumn("id", docs.doc_id)
    got = judge(docs, DecisionList(()), carry=("doc_id",)).collect()
    assert [(r.n_words, r.base_failed, r.kept) for r in got] == [(0, True, False), (0, True, False), (60, True, False)]
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert fit(docs, none).rules == () and judge(docs.limit(0), DecisionList(())).count() == 0
    labels = spark.createDataFrame([(1, None), (None, 0), (2, 0), (2, 1)], "doc_id long, quality int")
    assert fit(docs, labels).rules == ()
    assert with_counts(docs).select(*[c.alias(k) for k, c in features().items()]).where("words is null or repeat_share is null").count() == 0


def test_carried_columns_may_not_bear_names_of_results(spark):
    docs = spark.createDataFrame([(1, "w " * 60, 7, True)], "doc_id long, text string, n_words int, Kept boolean")
    for name in ("n_words", "Kept"):
        with pytest.raises(ValueError):
            judge(docs, DecisionList(()), carry=("doc_id", name))
    assert judge(docs, DecisionList(()), carry=("doc_id",)).count() == 1


def test_an_id_of_very_many_rows_counts_once_in_the_fit(spark, monkeypatch):
    docs = spark.range(3000).selectExpr("1 AS doc_id", "concat('a ', id % 7, repeat(' b', 60)) AS text")
    seen = []
    monkeypatch.setattr(quality, "learn", lambda x, bad, grow, **o: seen.append(len(bad)) or DecisionList(()))
    fit(docs.union(docs.selectExpr("2", "text").limit(1)), spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, quality int"))
    assert seen == [2]


def test_query_keeps_good_and_drops_bad_documents(spark):
    path = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in quality.query(spark, path).collect()}
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    assert rows.keys() == texts.keys()
    for d, t in texts.items():
        r = rows[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == _brute(t)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.kept and r.base_failed)
    labels = spark.read.parquet(f"{path}/labels.parquet").collect()
    tested = [(r.quality, rows[r.doc_id].kept) for r in labels if not rows[r.doc_id].base_failed]
    assert np.mean([q == k for q, k in tested]) > 0.95
