import random
from collections import Counter

import numpy as np

from qualis.llm import neardup
from qualis.llm.bagminhash import signatures, weighted_jaccard
from qualis.llm.neardup import SHINGLE, THRESHOLD, band_keys, classes, shingles, similarity


def test_registers_estimate_weighted_jaccard_without_bias():
    rng = np.random.default_rng(5)
    for _ in range(12):
        n = int(rng.integers(1, 60))
        keys = rng.integers(0, 2**63, n).astype(np.uint64)
        a, b = (rng.integers(0, 12, n) * (rng.random(n) < 0.8) for _ in range(2))
        a[0] = max(a[0], 1)
        b[0] = max(b[0], 1)
        doc = np.concatenate([np.zeros((a > 0).sum(), int), np.ones((b > 0).sum(), int)])
        sig = signatures(doc, np.concatenate([keys[a > 0], keys[b > 0]]), np.concatenate([a[a > 0], b[b > 0]]), 2, 4096)
        want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        assert abs((sig[0] == sig[1]).mean() - want) < 0.04


def test_signatures_do_not_depend_on_neighbours():
    texts = ["a b c d e f g h", "x", "a b c d e f g h " * 30, "one two three four five six"]
    together, n = band_keys(texts)
    for i, t in enumerate(texts):
        alone, m = band_keys([t])
        assert (alone[0] == together[i]).all() and m[0] == n[i] == len(shingles(t))


def _brute(rows):
    bags = [Counter(shingles(t or "")) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same = (rows[i][1] or "") == (rows[j][1] or "")
            if same or (bags[i] and bags[j] and weighted_jaccard(bags[i], bags[j]) >= THRESHOLD):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(rows))]


def _rows():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(12):
        base = rng.choices(words, k=rng.randrange(8, 220))
        for _ in range(rng.randrange(1, 9)):
            copy = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 25)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append(" ".join(copy))
    rows += ["few words", "few words", "few  words", "other words", "", None, " \n", "é é é é é é é é", "é " * 40, "same " * 50, "same " * 46]
    return [(i, t) for i, t in enumerate(rows)]


def test_classes_match_brute_force(spark):
    rows = _rows()
    docs = spark.createDataFrame([(*r, 3, "b") for r in rows], "doc_id long, text string, node int, band string")
    got = {r.doc_id: r for r in classes(docs).collect()}
    want = _brute(rows)
    assert {d: r.class_id for d, r in got.items()} == dict(enumerate(want))
    sizes = Counter(want)
    assert all(r.class_size == sizes[r.class_id] and r.kept == (r.doc_id == r.class_id) for r in got.values())


def test_unlike_members_of_a_bucket_are_all_compared(spark, monkeypatch):
    """With one register per band, buckets hold many unlike texts; the classes stay exact."""
    from qualis.llm import neardup

    rng = random.Random(9)
    rows = []
    for g in range(5):
        base = [f"g{g}w{i}" for i in range(60)]
        common = [f"c{i}" for i in range(40)]
        for _ in range(4):
            copy = common + list(base)
            copy[rng.randrange(45, 95)] = "edit"
            rows.append((len(rows), " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    roots = neardup._roots
    node_rows = docs.selectExpr("doc_id", "text", "xxhash64(text) as node")
    members = node_rows.selectExpr("1L as band", "node", "96L as n").distinct()
    got = {r.node: r.root for r in roots(node_rows, members, THRESHOLD).collect()}
    nodes = {r.doc_id: r.node for r in node_rows.collect()}
    want = _brute(rows)
    assert all((got[nodes[i]] == got[nodes[j]]) == (want[i] == want[j]) for i in nodes for j in nodes)
    assert len(set(got.values())) == 5 and SHINGLE == 5


def test_similar_multisets_share_a_prefix_element():
    from qualis.llm.neardup import prefix

    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(1, 30))
        keys = rng.integers(0, 2**62, n).astype(np.uint64)
        a = rng.integers(0, 4, n)
        b = np.maximum(a + rng.integers(-1, 2, n) * (rng.random(n) < 0.2), 0)
        if not a.sum() or not b.sum() or np.minimum(a, b).sum() < THRESHOLD * np.maximum(a, b).sum():
            continue
        known = np.sort(rng.choice(keys, n // 2, replace=False))
        common = {"shingle": known, "count": rng.integers(2, 9, len(known))}
        pa, pb = (prefix(keys[x > 0], x[x > 0], common, THRESHOLD) for x in (a, b))
        assert set(pa.tolist()) & set(pb.tolist())


def test_texts_that_share_a_long_passage_are_told_apart(spark):
    """One bucket of many unlike texts: finer buckets decide, with few comparisons."""
    from qualis.llm import neardup

    passage = [f"p{i}" for i in range(100)]
    rows = [(i, " ".join([*passage, *(f"own{i}x{k}" for k in range(20 if i % 4 else 6))])) for i in range(60)]
    node_rows = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "xxhash64(text) as node")
    members = node_rows.selectExpr("1L as band", "node", "size(split(text, ' ')) - 4L as n")
    got = {r.node: r.root for r in neardup._roots(node_rows, members, THRESHOLD).collect()}
    nodes = {r.doc_id: r.node for r in node_rows.collect()}
    want = _brute(rows)
    assert all((got[nodes[i]] == got[nodes[j]]) == (want[i] == want[j]) for i in nodes for j in nodes)


def test_a_large_group_costs_a_comparison_each(spark):
    base = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join([*base, f"end{i}"])) for i in range(800)]
    got = classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.class_id, r.class_size) for r in got} == {(0, 800)}
    assert similarity(rows[0][1], rows[1][1]) >= THRESHOLD


def test_nulls_repeats_and_empty(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (None, "z z"), (1, None)], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.class_size, r.kept) for r in classes(docs).collect())
    assert got == [("1", 1, True), ("4", 3, True), ("4", 3, True), ("None", 1, True), ("None", 3, False)]
    assert classes(docs.limit(0)).count() == 0


def test_unlike_texts_of_one_hash_stay_apart(spark, monkeypatch):
    """With the length of the text as its first hash, most texts share it with unlike ones."""
    from pyspark.sql import functions as F

    from qualis.llm import neardup, stages

    monkeypatch.setattr(neardup, "first_hash", lambda text: F.length(text).cast("long"))
    rows = _rows() + [(500, "one two three four five six"), (500, "two one three four five six"), (500, "one two three four five six")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.text_key): r.class_key for r in classes(docs).collect()}
    want = _brute(rows)
    assert len(set(got.values())) == len(set(want))
    kept = sorted((r.doc_id, r.text or "") for r in stages.near_stage(docs).collect())
    assert len(kept) == len(set(want)) and kept[-2:] == [(500, "one two three four five six"), (500, "two one three four five six")]


def test_shingle_counts_cover_all_texts(spark):
    from qualis.llm import neardup

    rng = random.Random(4)
    texts = [" ".join(rng.choices("abc", k=rng.randrange(0, 40))) for _ in range(300)]
    rows = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    got = {r.node: sorted((s["count"], s.texts or 1) for s in r.shingles) for r in neardup.ranked_shingles(rows).collect()}
    bags = [Counter(shingles(t)) for t in texts]
    held = Counter(s for b in bags for s in b)
    assert got == {i: sorted((n, held[s]) for s, n in b.items()) for i, b in enumerate(bags) if b}


def test_long_texts_are_compared_whole_and_spread_over_tasks(spark, monkeypatch):
    """Texts of 30,000 words that differ in their second half only; a task compares a pair or two."""
    from qualis.llm import neardup

    monkeypatch.setattr(neardup, "SHINGLES_A_PARTITION", 100_000)
    rng = random.Random(6)
    base = [f"w{rng.randrange(9000)}" for _ in range(30_000)]
    rows = []
    for share in (0, 0.01, 0.05, 0.2, 0.3):
        copy = base[:15_000] + [w if rng.random() >= share else "x" + w for w in base[15_000:]]
        rows.append((len(rows), " ".join(copy)))
    rows.append((len(rows), rows[0][1] + " end"))
    got = {r.doc_id: r.class_id for r in classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == dict(enumerate(_brute(rows))) and len(set(got.values())) > 1


def test_links_of_earlier_rounds_are_not_joined_again(spark, monkeypatch):
    taken = []
    plain = neardup.components
    monkeypatch.setattr(neardup, "components", lambda links: taken.append(links.count()) or plain(links))
    nodes = spark.range(50).withColumnRenamed("id", "node")
    found = neardup._Classes(nodes, nodes.selectExpr("node", "'' AS text"), 0.8)
    found.merge(spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long"))
    found.merge(spark.createDataFrame([(45, 47), (3, 45), (4, 45), (5, 45)], "a long, b long"))
    assert taken == [40, 2]  # the second time a link between the classes, whatever their size
    roots = {r.node: r.root for r in found.roots.collect()}
    assert len(roots) == 50 and {n for n, root in roots.items() if root == 0} == {*range(41), 45, 47}
    assert all(root == n for n, root in roots.items() if root)
