import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from qualis.llm import chunks
from qualis.llm.chunks import LEAST, MASK_BITS, MIN_WORDS, MOST, WINDOW, _GEAR, chunk_ends, gear_hashes, repeated_spans


def _slow_ends(data):
    ends, last = [], 0
    for i in range(len(data)):
        h = 0
        for b in data[max(0, i - WINDOW + 1):i + 1]:
            h = ((h << 1) + int(_GEAR[b])) % 2**32
        mark = (h >> WINDOW) % 2**MASK_BITS == 0
        if i + 1 - last >= LEAST and mark or i + 1 - last == MOST or i + 1 == len(data):
            ends.append(i + 1)
            last = i + 1
    return ends


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=900))
def test_chunks_match_a_byte_by_byte_rolling_hash(data):
    assert chunk_ends(data) == _slow_ends(data)
    assert len(gear_hashes(np.frombuffer(data, np.uint8))) == len(data)


def test_long_runs_are_cut_and_insertions_only_change_what_is_near():
    assert all(b - a <= MOST for a, b in zip([0, *chunk_ends(b"a" * 5000)], chunk_ends(b"a" * 5000)))
    rng = random.Random(1)
    text = bytes(rng.choices(b"abcdefghij klm", k=4000))
    cut = lambda d: {d[a:b] for a, b in zip([0, *chunk_ends(d)], chunk_ends(d))}
    assert len(cut(text) & cut(text[:500] + b"inserted" + text[500:])) > 0.9 * len(cut(text))


def _words(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnopq", k=rng.randrange(2, 9))) for _ in range(n))


def test_passages_of_over_fifty_words_are_found_and_clean_texts_left_alone(spark):
    rng = random.Random(7)
    passages = [_words(rng, 55 + i) for i in range(12)]
    rows, holds = [], {}
    for i in range(120):
        parts = [_words(rng, rng.randrange(30, 120)), _words(rng, rng.randrange(5, 60))]
        if i % 3 == 0:
            holds[i] = i // 3 % 12
            parts.insert(1, passages[holds[i]])
        rows.append((i, rng.choice(["é ", "", "\n"]) + " ".join(parts)))
    docs = spark.createDataFrame([(*r, 1, b"x") for r in rows], "doc_id long, text string, row int, d1 binary")
    got = repeated_spans(docs).collect()
    first = {p: min(d for d, q in holds.items() if q == p) for p in holds.values()}
    assert {r.doc_id for r in got} == {d for d, p in holds.items() if d != first[p]}
    texts = dict(rows)
    for r in got:
        assert r.of_doc_id == first[holds[r.doc_id]] and texts[r.doc_id][r.start:r.end] in texts[r.of_doc_id] and r.n_words >= MIN_WORDS


def test_nulls_repeats_and_empty(spark):
    text = _words(random.Random(2), 80)
    docs = spark.createDataFrame([(3, text), (3, text), (None, text), (5, None), (6, "")], "doc_id long, text string")
    got = repeated_spans(docs).collect()
    assert [(r.doc_id, r.of_doc_id) for r in got] == [(3, None)]
    assert repeated_spans(docs.limit(0)).count() == 0


def test_repeats_within_one_document_are_found(spark):
    rng = random.Random(11)
    passage, parts = _words(rng, 200), [_words(rng, 40) for _ in range(6)]
    text = " | ".join(f"{p} | {passage}" for p in parts)
    got = sorted(repeated_spans(spark.createDataFrame([(4, text), (4, text)], "doc_id long, text string")).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.of_doc_id) for r in got] == [(4, 4)] * 5
    assert all(passage in text[r.start:r.end] and text.index(passage) < r.start for r in got)


def test_spans_reach_the_ends_of_the_passage(spark):
    rng = random.Random(12)
    passages = [_words(rng, 20 + i) for i in range(20)] + ["é" * 3 + _words(rng, 30) + "ü" * 3]
    rows = [(i, f"{_words(rng, 40)} #{'A' if i < 100 else 'B'} {passages[i % 100]} {'C' if i < 100 else 'D'}# {_words(rng, 40)}") for n in range(21) for i in (n, 100 + n)]
    got = {r.doc_id: r for r in repeated_spans(spark.createDataFrame(rows, "doc_id long, text string"), min_words=18).collect()}
    texts = dict(rows)
    # those without a whole chunk in common with the earlier text stay unseen
    whole = {100 + i for i, p in enumerate(passages) if _common_chunk(texts[i], texts[100 + i])}
    assert set(got) == whole and len(whole) > 15
    for d, r in got.items():
        assert r.of_doc_id == d - 100 and texts[d][r.start:r.end] == f" {passages[d - 100]} "


def _common_chunk(a, b):
    cut = lambda d: {d[x:y] for x, y in zip([0, *chunk_ends(d)], chunk_ends(d))}
    return cut(a.encode()) & cut(b.encode())


def _repeated_words(docs, window):
    """Brute force: per document (in order of ids) the words that lie in a run of ``window`` words which occurred before."""
    seen, out = {}, {}
    for doc_id, text in sorted(docs):
        words = [(m.start(), m.end(), m.group()) for m in re.finditer(r"\S+", text)]
        out[doc_id] = set()
        for i in range(len(words) - window + 1):
            if len({w for _, _, w in words[i:i + window]}) < 3:
                continue  # one word again and again repeats itself at every place: chunks of greatest size need not meet
            # the same characters, white space included
            run = text[words[i][0]:words[i + window - 1][1]]
            if seen.setdefault(run, (doc_id, i)) != (doc_id, i):
                out[doc_id].update((b, e) for b, e, _ in words[i:i + window])
    return out


@pytest.mark.parametrize("bound", [None, 0])
def test_query_finds_the_repeats_of_brute_force(spark, monkeypatch, bound):
    if bound is not None:
        monkeypatch.setattr(chunks, "BROADCAST_BYTES", bound)
    path = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    texts = dict(docs)
    spans = {}
    for r in chunks.query(spark, path).collect():
        spans.setdefault(r.doc_id, []).append((r.start, r.end))
        # every span consists of repeats (of several places, where they touch): most of its pieces occur elsewhere too
        pieces = [texts[r.doc_id][k:k + 20] for k in range(r.start, r.end - 20, 20)]
        again = [p for p in pieces if texts[r.doc_id].count(p) > 1 or any(p in t for d, t in docs if d != r.doc_id)]
        assert len(again) >= 0.6 * len(pieces), (r, texts[r.doc_id][r.start:r.end])
    want = _repeated_words(docs, 51)
    total = sum(map(len, want.values()))
    found = sum(any(b <= s and e <= t for b, t in spans.get(d, ())) for d, words in want.items() for s, e in words)
    assert total > 500 and found / total >= 0.9, found / total
