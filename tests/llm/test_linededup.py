import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from qualis.llm import linededup
from qualis.llm.linededup import MIN_CHARS, coarse_variants, dedup_lines, dropped_lines, variants


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


_TEXT = st.text(st.sampled_from("ab é🙂"), min_size=1, max_size=9)


@settings(max_examples=300, deadline=None)
@given(_TEXT, _TEXT)
def test_shared_variants_mean_one_edit(a, b):
    va, vb = variants(a).tolist(), variants(b).tolist()
    same_place = any(x == y for x, y in zip(va[1:], vb[1:])) and len(a) == len(b)
    linked = va[0] == vb[0] or va[0] in vb[1:] or vb[0] in va[1:] or same_place
    assert linked == (_distance(a, b) <= 1)
    if _distance(a, b) <= 1:
        assert set(coarse_variants([a])[0].tolist()) & set(coarse_variants([b])[0].tolist())


def _brute(rows):
    """rows of (doc_id, text), ids distinct: {(doc_id, line_no): (of, edits)}."""
    order = lambda at: (at[0] is not None, at[0] or 0, at[1])
    places = {}
    for d, t in rows:
        for k, line in enumerate((t or "").split("\n")):
            if re.search(r"[^\x20\x09-\x0D]", line):
                places.setdefault(line, []).append((d, k))
    first = {x: min(p, key=order) for x, p in places.items()}
    out = {}
    for x, own in places.items():
        near = [first[y] for y in places if order(first[y]) < order(first[x]) and min(len(x), len(y)) >= MIN_CHARS and abs(len(x) - len(y)) <= 1 and _distance(x, y) == 1]
        for at in own:
            if near:
                out[at] = (min(near, key=order), 1)
            elif at != first[x]:
                out[at] = (first[x], 0)
    return out


def _rows():
    rng = random.Random(3)
    base = ["".join(rng.choice("abc é") for _ in range(n)) + "z" for n in (5, 18, 19, 20, 21, 22, 40)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randrange(6)):
            line = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                at = rng.randrange(len(line))
                what = rng.randrange(3)
                line[at:at + (what != 0)] = [] if what == 1 else [rng.choice("abcx")]
            lines.append("".join(line))
        rows.append((i if i != 30 else None, "\n".join(lines) if i % 11 else None))
    return rows + [(100, "\n \n\t\n"), (101, ""), (102, "one line " * 2000 + "\n" + "one line " * 1999 + "one lime ")]


def test_dropped_lines_match_brute_force(spark):
    rows = _rows()
    docs = spark.createDataFrame([(*r, "c", 1) for r in rows], "doc_id long, text string, line string, first int")
    got = {(r.at.doc_id, r.at.line_no): ((r.of.doc_id, r.of.line_no), r.edits) for r in dropped_lines(docs).collect()}
    assert got == _brute(rows) and {e for _, e in got.values()} == {0, 1}
    kept = {r.doc_id: r for r in dedup_lines(docs).collect()}
    for d, t in rows:
        want = t if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (d, k) not in got)
        assert kept[d].text == want and kept[d].line == "c"
    assert dropped_lines(docs.limit(0)).count() == 0 and dedup_lines(docs.limit(0)).columns == docs.columns


def test_repeated_rows_are_one_document(spark):
    docs = spark.createDataFrame([(1, "same line here, long enough"), (1, "same line here, long enough"), (2, "same line here, long enough")], "doc_id long, text string")
    assert [(r.at.doc_id, r.of.doc_id) for r in dropped_lines(docs).collect()] == [(2, 1)]
    assert sorted(r.text for r in dedup_lines(docs).collect()) == ["", *["same line here, long enough"] * 2]
    docs = spark.createDataFrame([(1, "a line\nanother"), (1, "another\nother"), (1, None)], "doc_id long, text string")
    assert sorted(str(r.text) for r in dedup_lines(docs).collect()) == ["None", "a line", "another\nother"]


def test_a_line_shared_by_many_lines_makes_no_pairs(spark):
    """3000 lines one character apart from a common one: rows stay in proportion."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("a common long line with a place "), F.char(F.col("id") + 0x4E00)).alias("text"))
    got = dropped_lines(docs).collect()
    assert len(got) == 3000 - docs.select("text").distinct().count() + docs.select("text").distinct().count() - 1
    assert {r.of.doc_id for r in got} == {0}


def test_query_matches_its_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    path = "/root/testdata/sf0.01"
    got = linededup.query(spark, path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet'")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({linededup.ORACLE})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_texts_that_share_an_id_are_documents_of_their_own(spark):
    header = "a header line of many documents"
    for i in (None, 7):
        docs = spark.createDataFrame([(i, f"{header}\nbody number {'xyz'[n]} {'pqr'[n] * 9}") for n in range(3)], "doc_id long, text string")
        texts = [r.text for r in dedup_lines(docs).collect()]
        assert sum(header in t for t in texts) == 1 and sum("body" in t for t in texts) == 3
