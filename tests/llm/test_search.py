import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import pyarrow as pa

from qualis.llm import search

TERM = re.compile(search.TERM)
SMALL = "/root/testdata/sf0.001"


def _terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def _brute(docs, items, top=50):
    """The ranking with plain loops: item number -> [(score, doc_id)]."""
    held = [Counter(_terms(t)) for _, t in docs]
    sizes = [sum(c.values()) for c in held]
    n_docs, n_terms = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for c in held for t in c)
    out = []
    for text in items:
        found = []
        for (doc_id, _), own, n in zip(docs, held, sizes):
            score = 0
            for t in set(_terms(text)) & set(own):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                m = 100 - 50 + (50 * n * n_docs) // n_terms
                score += w * ((1000000000 * own[t]) // (1000 * own[t] + 20 * m))
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0))
        out.append([(-s, None if none else i) for s, none, i in sorted(found)[:top]])
    return out


def _random_docs(n, seed, words=40):
    draw = random.Random(seed)
    return [(i, " ".join(f"w{int(draw.paretovariate(0.7)) % words}" for _ in range(draw.randint(0, 60)))) for i in range(n)]


def _ranked(rows):
    out = defaultdict(list)
    for r in sorted(rows, key=lambda r: r.rank):
        out[r.item_id].append((r.score, r.doc_id))
    return out


def test_ranking_equals_brute_force_in_any_layout(spark):
    docs = _random_docs(700, 1)
    items = [(k, " ".join(f"W{j}" for j in random.Random(k).sample(range(45), 6))) for k in range(12)]
    want = {k: r for k, r in enumerate(_brute(docs, [t for _, t in items], 7)) if r}
    asked = spark.createDataFrame([(k, t, 1) for k, t in items], "item_id long, text string, rank int")
    table = spark.createDataFrame([(i, t, "own", 5, 1.0) for i, t in docs], "doc_id long, text string, term string, shard long, score double")
    for parts in (1, 6):
        index = search.build(table.repartition(parts)).cache()
        rows = search.search(index, asked, 7).collect()
        assert _ranked(rows) == want
        assert all(sorted(r.rank for r in rows if r.item_id == k) == list(range(1, len(v) + 1)) for k, v in want.items())


def test_more_queries_than_a_pass_holds(spark, monkeypatch):
    docs, items = _random_docs(100, 2), [f"w{k} w{k + 1} w0" for k in range(20)]
    monkeypatch.setattr(search, "PASS_TERMS", 9)
    index = search.build(spark.createDataFrame(docs, "doc_id long, text string")).cache()
    rows = search.search(index, spark.createDataFrame(list(enumerate(items)), "item_id long, text string"), 5).collect()
    assert _ranked(rows) == {k: r for k, r in enumerate(_brute(docs, items, 5)) if r}


def _shard_table(docs):
    shard = search.ShardIndex(0)
    for i, t in docs:
        shard.add(i, t.encode())
    return pa.Table.from_batches(shard.batches())


def test_block_maxima_leave_blocks_packed(monkeypatch):
    monkeypatch.setattr(search, "BLOCK", 4)
    monkeypatch.setattr(search, "WINDOW", 32)
    # a rare term in a few documents, and a frequent one nearly everywhere
    docs = [(i, "rare " * (i % 50 == 7) + "common " * (1 + i % 3) + "filler " * (i % 11)) for i in range(600)]
    table = _shard_table(docs)
    scale = search.Scale(600, sum(len(_terms(t)) for _, t in docs))
    weights = {"rare": scale.weight(12), "common": scale.weight(600)}
    opened = []
    real = search.Postings.block
    monkeypatch.setattr(search.Postings, "block", lambda self, k: (opened.append((id(self), k)), real(self, k))[1])
    wanted = table.filter(pa.compute.or_kleene(pa.compute.is_null(table["term"]), pa.compute.is_in(table["term"], pa.array(["rare", "common"]))))
    got = search._search_shard([["rare", "common"]], weights, scale, 3)(wanted).to_pylist()
    assert [(r["score"], r["doc_id"]) for r in got] == _brute(docs, ["rare common"], 3)[0]
    assert len(set(opened)) < 40 < 150  # of 150 blocks of the frequent term and 3 of the rare one


def test_shards_of_any_block_and_window_size(monkeypatch):
    docs = _random_docs(300, 3, 25)
    items = [" ".join(f"w{j}" for j in random.Random(k).sample(range(25), 8)) for k in range(15)]
    want = _brute(docs, items, 10)
    df = Counter(t for _, d in docs for t in set(_terms(d)))
    scale = search.Scale(sum(bool(t) for _, t in docs), sum(len(_terms(t)) for _, t in docs))
    weights = {t: scale.weight(n) for t, n in df.items()}
    for block, window in ((1, 1), (3, 17), (128, 2048)):
        monkeypatch.setattr(search, "BLOCK", block)
        monkeypatch.setattr(search, "WINDOW", window)
        rows = search._search_shard([sorted(set(_terms(t)) & set(df)) for t in items], weights, scale, 10)(_shard_table(docs)).to_pylist()
        assert [[(r["score"], r["doc_id"]) for r in rows if r["query"] == k] for k in range(15)] == want


def test_unbeaten_postings_give_the_blocks_maximum():
    draw = random.Random(5)
    for _ in range(200):
        n = draw.randint(1, 30)
        times = search.np.array([draw.randint(1, 9) for _ in range(n)])
        lengths = times + search.np.array([draw.randint(0, 20) for _ in range(n)])
        best = search._unbeaten(times, lengths)
        for scale in (search.Scale(10, 100), search.Scale(1000, 7), search.Scale(3, 10**6)):
            def top(k):
                return int(scale.impact(times[k], scale.norm(lengths[k])).max())
            assert top(best) == top(search.np.arange(n))


def test_nulls_ties_repeats_long_texts_and_empty_tables(spark):
    long = "needle " + "hay " * 300_000
    docs = [(3, "Öl é NEEDLE"), (1, "öl é needle"), (1, "öl é needle"), (None, "öl é needle"), (2, None), (4, ""), (5, long), (6, "!!! \n"), (7, "x" * 100_000)]
    items = [(0, "needle"), (0, "needle"), (None, "ÖL é needle"), (1, "absent"), (2, None), (3, "x" * 100_000), (0, "hay")]
    index = search.build(spark.createDataFrame(docs, "doc_id long, text string")).cache()
    asked = spark.createDataFrame(items, "item_id long, text string")
    rows = search.search(index, asked, 3).collect()
    texts = ["needle", "ÖL é needle", "x" * 100_000, "hay"]
    want = dict(zip(texts, _brute(docs, texts, 3)))
    got = Counter((r.item_id, r.rank, r.doc_id, r.score) for r in rows)
    ids = {"needle": 0, "ÖL é needle": None, "x" * 100_000: 3, "hay": 0}
    assert got == Counter((ids[t], k + 1, i, s) for t, r in want.items() for k, (s, i) in enumerate(r))
    assert [i for _, i in want["needle"]] == [1, 1, 3]
    assert search.search(index.limit(0), asked).count() == 0
    assert search.search(index, asked.limit(0)).count() == 0
    assert search.build(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_equals_its_sql(spark):
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SMALL}/{name}.parquet')")
    rows = search.query(spark, SMALL).select("item_id", "rank", "doc_id", "score").collect()
    assert sorted(map(tuple, rows)) == sorted(db.execute(search.ORACLE).fetchall())
