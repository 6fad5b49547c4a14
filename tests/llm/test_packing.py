import zlib
from collections import defaultdict

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
from qualis.llm.packing import Limits, pack  # noqa: E402

PATH = P.path("word_bpe_49k.json")


def _reference_ids(texts):
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(PATH)
    return [[*e.ids, 1] for e in full.encode_batch(texts, add_special_tokens=False)]


def _check(rows, ids, limits):
    """Each id in exactly one piece, sequences gapless and within all limits."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(ids)
    for doc_id, own in pieces.items():
        own.sort(key=lambda r: r.start)
        got = np.concatenate([np.frombuffer(r.ids, "<u4") for r in own]).tolist()
        assert got == ids[doc_id] and [r.start for r in own] == np.cumsum([0, *[r.length for r in own][:-1]]).tolist()
        assert all(r.doc_tokens == len(got) for r in own)
    lengths = []
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == np.cumsum([0, *[r.length for r in own][:-1]]).tolist()
        assert [r.segment for r in own] == list(range(len(own))) and len(own) <= limits.segments
        assert sum(r.loss_tokens for r in own) <= limits.loss
        lengths.append(sum(r.length for r in own))
        assert lengths[-1] <= limits.tokens
    return lengths


TEXTS = ["", "One two  three", "İstanbul ΣΑΣ ½ é <|endoftext|> ok", "l'été où ça'll don't 12 ßtraße!!", "word " * 9000, "x" * 5000,
         "a\x85b c\x1cd", "déjà\n\tvu… “quoted”", "日本語 текст 🙂"]


def test_every_id_is_in_one_piece_and_padding_is_small(spark):
    docs = spark.createDataFrame([(i, t, "extra", 7) for i, t in enumerate(TEXTS)], "doc_id long, text string, ids string, start int")
    limits = Limits()
    lengths = _check(pack(docs.coalesce(1), PATH).collect(), dict(enumerate(_reference_ids(TEXTS))), limits)
    assert all(n == 2048 or n & (n - 1) == 0 for n in lengths)


def test_nulls_repeats_and_empty_tables(spark):
    schema = "doc_id long, text string"
    assert pack(spark.createDataFrame([], schema), PATH).count() == 0
    rows = pack(spark.createDataFrame([(1, None), (None, "a b"), (2, "same"), (2, "same")], schema), PATH).collect()
    assert {(r.doc_id, r.doc_tokens) for r in rows if r.doc_id != 2} == {(1, 1), (None, 3)}
    assert sum(r.length for r in rows if r.doc_id == 2) == 4


def test_all_three_limits_hold_for_instruction_data(spark):
    rows = [(i, "question " * (i % 40), "answer " * (i % 23 + 1)) for i in range(500)]
    limits = Limits(tokens=256, segments=5, loss=100)
    docs = spark.createDataFrame(rows, "conv long, q string, a string").coalesce(1)
    got = pack(docs, PATH, "conv", "a", "q", limits).collect()
    ids = {i: [*np.frombuffer(b"".join(np.array(x[:-1], "<u4").tobytes() for x in _reference_ids([q, a])), "<u4").tolist(), 1] for i, q, a in rows}
    lengths = _check(got, ids, limits)
    full = [sum(r.loss_tokens for r in got), len(got), sum(lengths)]
    assert len(lengths) <= 1.5 * max(full[0] / 100, full[1] / 5, full[2] / 256) + 8


def test_query_digests(spark):
    from qualis.llm import packing

    rows = packing.query(spark, "/root/testdata/sf0.001").collect()
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    ids = dict(zip(docs, _reference_ids(list(docs.values()))))
    assert all(r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4").tobytes()) for r in rows)
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
    again = packing.query(spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
