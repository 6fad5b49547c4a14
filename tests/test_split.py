"""Files read by many tasks equal the same files read by one."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from qualis import schemas
from qualis.sources.csv_source import read_csv
from qualis.sources.fixtures import raw_table
from qualis.sources.json_source import literal_to_json, parse_documents, read_json_documents, write_documents
from qualis.sources.split import csv_records, json_elements, pieces, read_csv_split, read_json_split

from conftest import SF_SMALL


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


@pytest.fixture()
def small_blocks(spark):
    """Blocks of a few hundred bytes, so that a small file has many."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def use(size):
        for k in old:
            spark.conf.set(k, str(size))
    yield use
    for k, v in old.items():
        spark.conf.set(k, v)


def _cells(draw):
    """A cell's text and how an export writes it."""
    text = "".join(draw.choice(["a", "é", ",", '"', "\n", "\r\n", " ", "x, y", '""', "''", "7"]) for _ in range(draw.randint(0, 9)))
    quoted = any(c in text for c in ',"\n\r') or draw.random() < 0.2
    return text, '"' + text.replace('"', '""') + '"' if quoted else text


@pytest.mark.parametrize("size,end", [(64, "\n"), (131, "\r\n"), (1_000_000, "\n")])
def test_records_are_rebuilt_across_blocks(spark, tmp_dir, small_blocks, size, end):
    draw = random.Random(size)
    want = {}
    for name in ("one.csv", "two.csv"):
        rows = [[_cells(draw) for _ in range(3)] for _ in range(120)]
        lines = [",".join(w for _, w in r) for r in rows]
        _write(f"{tmp_dir}/in/{name}", "h1,h2,h3" + end + end.join(lines) + draw.choice(["", end]))
        want[name] = ["h1,h2,h3", *[x for x in lines if x.strip("\r")]]
    small_blocks(size)
    got = {}
    for r in csv_records(spark, f"{tmp_dir}/in").collect():
        got.setdefault(os.path.basename(r.file), []).append((r.number, r.record))
    assert {k: [t for _, t in sorted(v)] for k, v in got.items()} == want
    assert all(sorted(n for n, _ in v) == list(range(len(v))) for v in got.values())
    if size < 1000:
        assert pieces(spark, f"{tmp_dir}/in", "\n").select("file", "block").distinct().count() > 20


def test_split_csv_equals_the_whole_file_reader(spark, tmp_dir, small_blocks):
    draw = random.Random(8)
    names = schemas.columns("autoqa_root_cause")
    kinds = dict(schemas.RAW_COLUMNS["autoqa_root_cause"])
    lines = [",".join(names)]
    for i in range(300):
        cells = []
        for n in names:
            if kinds[n] == "string":
                cells.append(draw.choice(['"a\nb ""quoted"", c"', "plain", "N/A", '"\r\n"', "", '"one, two"', f"r{i}"]))
            else:
                cells.append(draw.choice(["1", "2.0", "", "NaN", "17"]))
        lines.append(",".join(cells[:draw.choice([4, 4, 4, 3])]))
    path = _write(f"{tmp_dir}/big.csv", "\n".join(lines) + "\n\n")
    want = sorted(map(str, read_csv(spark, path, "autoqa_root_cause").collect()))
    small_blocks(256)
    split = read_csv_split(spark, path, "autoqa_root_cause")
    assert sorted(map(str, split.collect())) == want and len(want) == 300
    assert pieces(spark, path, "\n").rdd.getNumPartitions() > 10


def test_split_csv_errors_are_those_of_the_reader(spark, tmp_dir):
    names = schemas.columns("autoqa_root_cause")
    swapped = _write(f"{tmp_dir}/swapped.csv", ",".join([names[0], names[2], names[1], names[3]]) + "\nrt-1,1.0,2.0,x\n")
    long = _write(f"{tmp_dir}/long.csv", ",".join(names) + "\nrt-1,1.0,2.0,x,extra\n")
    bad = _write(f"{tmp_dir}/bad.csv", ",".join(names) + "\n" + ",".join("word" for _ in names) + "\n")
    for path in (swapped, long, bad):
        with pytest.raises(Exception):
            read_csv_split(spark, path, "autoqa_root_cause").collect()
    empty = _write(f"{tmp_dir}/empty.csv", ",".join(names) + "\n")
    assert read_csv_split(spark, empty, "autoqa_root_cause").count() == 0


def _element(draw, i):
    text = "".join(draw.choice(["a", "{", "}", "[", "]", '"', "\\", "é", ",", '"}', "\\\\"]) for _ in range(draw.randint(0, 12)))
    return {"subscription": {"id": f"s{i}", "plan": text, "n": {"deep": {"deeper": [1, {"x": "}"}]}}},
            "customer": {"id": f"c{i}", "billing_address": {"city": text[::-1]}}}


@pytest.mark.parametrize("size", [50, 333, 1_000_000])
def test_elements_are_rebuilt_across_blocks(spark, tmp_dir, small_blocks, size):
    draw = random.Random(size)
    want = {}
    for name, n in (("a.json", 150), ("b.json", 1), ("c.json", 0)):
        elements = [_element(draw, i) for i in range(n)]
        text = json.dumps({"list": elements, "next_offset": {"a": "}{"}, "more": [{"list": [1]}, {"x": {}}]}, ensure_ascii=False, indent=draw.choice([None, 1]))
        _write(f"{tmp_dir}/in/{name}", text)
        want[name] = elements
    small_blocks(size)
    got = {"c.json": []}
    for r in json_elements(spark, f"{tmp_dir}/in", legacy=False).collect():
        got.setdefault(os.path.basename(r.file), []).append((r.number, json.loads(r.text)))
    assert {k: [e for _, e in sorted(v, key=lambda p: p[0])] for k, v in got.items()} == want


def test_split_documents_equal_whole_ones(spark, tmp_dir, small_blocks):
    subs = raw_table(spark, SF_SMALL, "customer_subscriptions")
    write_documents(subs, f"{tmp_dir}/etl", max_elements=10**9, legacy=True)
    want = read_json_documents(spark, f"{tmp_dir}/etl", legacy=True)
    rows = sorted(map(str, want.collect()))
    small_blocks(20_000)
    got = read_json_split(spark, f"{tmp_dir}/etl", legacy=True)
    assert sorted(map(str, got.collect())) == rows and got.columns == want.columns
    assert pieces(spark, f"{tmp_dir}/etl", "}").select("block").distinct().count() > 3


def test_documents_are_written_element_by_element(spark, tmp_dir):
    subs = raw_table(spark, SF_SMALL, "customer_subscriptions")
    twice = subs.unionByName(subs)
    assert write_documents(twice, f"{tmp_dir}/etl", max_elements=100, legacy=False) == 3
    files = [os.path.join(d, f) for d, _, names in os.walk(f"{tmp_dir}/etl") for f in names if f.endswith(".txt")]
    written = 0
    for f in files:
        with open(f) as text:
            rows = text.read().rstrip(" ").split(" ,{")  # a row of the writer for each element, none for the document
        elements = json.loads(" ,{".join(rows))["list"]
        assert len(rows) == len(elements)
        written += len(elements)
    assert len(files) == 3 and written == twice.count()
    assert sorted(map(str, read_json_documents(spark, f"{tmp_dir}/etl", legacy=False).collect())) == sorted(map(str, twice.collect()))


def test_document_without_a_list_fails_also_when_split(spark, tmp_dir):
    for name, text in (("a.json", "{'items': [{'a': 1}]}"), ("b.json", "{'list': {'a': 1}, 'b': [{}]}"), ("c.json", "{'list': [{'a': 1}, {'b': {}")):
        path = _write(f"{tmp_dir}/{name}", text)
        with pytest.raises(Exception):
            read_json_split(spark, path).collect()


LITERALS = [
    {"a": "it's", "b": None, "c": True, "d": "True None False", "e": [1, 2], "f": 1.5, "g": False},
    {"a": 'say "hi"', "b": "it's \"both\"", "c": "back\\slash", "d": "tab\t and\nbreak", "e": "é ñ 日本", "f": "", "g": "[not, an array"},
    {"list": [{"x": "a, 'b': None}", "y": {"z": "O'Neil's \"None\""}}]},
    {"a": "\x07 \x7f ", "b": "x'", "c": "'x", "d": "''", "e": "\\'"},
]


@pytest.mark.parametrize("value", LITERALS)
def test_literals_of_the_language_become_json(spark, value):
    text = spark.createDataFrame([(repr(value),)], "value string").select(literal_to_json(F.col("value"))).first()[0]
    assert json.loads(text) == value


def test_quoted_arrays_and_valid_json_pass(spark):
    cases = {"{'a': '[1, 2]', 'b': '[]', 'c': '[\"x\"]'}": {"a": [1, 2], "b": [], "c": ["x"]},
             "{'a': \"['x', 'it']\"}": {"a": ["x", "it"]},
             '{"a": "it\'s", "b": null, "c": [true, "None"]}': {"a": "it's", "b": None, "c": [True, "None"]}}
    for text, want in cases.items():
        got = spark.createDataFrame([(text,)], "value string").select(literal_to_json(F.col("value"))).first()[0]
        assert json.loads(got) == want, text


def test_documents_with_apostrophes_parse_by_tokens(spark):
    doc = {"list": [{"subscription": {"id": "s1", "updated_at": 5}, "customer": {"id": "c1", "first_name": "D'Arcy", "last_name": None, "pii_cleared": "True",
                                                                              "created_at": 1700000000}}]}
    docs = spark.createDataFrame([(repr(doc),)], "value string")
    with pytest.raises(Exception):
        parse_documents(docs).collect()  # the plain replacement breaks on them
    row = parse_documents(docs, legacy="tokens").first()
    assert (row.subscription_id, row.customer_first_name, row.customer_last_name, row.customer_pii_cleared) == ("s1", "D'Arcy", None, "True")
