import hashlib
import random

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
from qualis.llm import piecebpe  # noqa: E402

PATH = P.path("piece_bpe_32k.model")
TEXTS = ["", " ", "a", " a  b ", "One two\n\n three\t\r\n", "<s>hi</s><unk><0x41>", "a▁b ▁", "İstanbul ñandú 日本語 текст 🙂\0\x01", "x" * 3000,
         "=-" * 500 + " " * 70, "don't 12345", "﻿abc�"]


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=PATH)


def _ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_encoding_is_the_librarys_on_random_texts(library):
    model, draw = piecebpe.piece_model(PATH), random.Random(3)
    pieces = list(model.ids)
    for _ in range(3000):
        kind = draw.random()
        if kind < 0.4:
            text = "".join(draw.choice(pieces) for _ in range(draw.randint(1, 9))).replace("▁", " ")
        elif kind < 0.7:
            text = "".join(draw.choice(["a", "b", "the", "ing", " ", "  ", "\n", "0", "é", "▁", "--"]) for _ in range(draw.randint(1, 40)))
        else:
            text = "".join(chr(draw.choice([draw.randint(0, 0x2ff), draw.randint(0x3000, 0xd7ff), draw.randint(0xe000, 0x10ffff)])) for _ in range(draw.randint(1, 20)))
        assert _ids(model.packed(text)) == library.encode(text), text


def test_decoding_is_the_librarys_on_random_ids(library):
    model, draw = piecebpe.piece_model(PATH), random.Random(4)
    for _ in range(5000):
        ids = [draw.randrange(32000) if draw.random() < 0.5 else draw.randrange(300) for _ in range(draw.randint(0, 8))]
        assert model.decoded(np.array(ids, "<u4").tobytes()) == library.decode(ids), ids


def test_backtracking_takes_pieces_back(library):
    model = piecebpe.PieceModel(PATH)
    greedy = 0
    for word in "undesirable antidisestablishmentarianism rehashthe abcdefghijklmnop".split():
        want = [library.id_to_piece(i) for i in library.encode(word)]
        assert model.pieces("▁" + word) == want
        greedy += next(p for p in sorted(model.ids, key=len, reverse=True) if ("▁" + word).startswith(p)) != want[0]
    assert greedy  # the longest first piece was not always the right one


def test_query_matches_the_library(spark, library):
    rows = piecebpe.query(spark, "/root/testdata/sf0.001").collect()
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        ids = library.encode(docs[r.doc_id], add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_nulls_repeats_long_texts_and_clashing_names(spark, library):
    schema = "doc_id long, text string, ids string, begin int"
    assert piecebpe.decode(piecebpe.encode(spark.createDataFrame([], schema), PATH), PATH).count() == 0
    long = "word and more, " * 40_000 + "z" * 100_000
    texts = [*TEXTS, None, long]
    rows = [(i, t, "own", 1) for i, t in enumerate(texts)] + [(None, "same", "own", 1)] * 2
    got = piecebpe.decode(piecebpe.encode(spark.createDataFrame(rows, schema), PATH), PATH).collect()
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in got) == [-1, -1, *range(len(texts))]
    for r in got:
        text = "same" if r.doc_id is None else texts[r.doc_id] or ""
        assert _ids(r.ids) == library.encode(text, add_bos=True, add_eos=True) and r.text == library.decode(_ids(r.ids))
    # the batch size of the table does not matter, and begin and end ids are optional
    bare = piecebpe.encode(spark.createDataFrame(rows, schema).repartition(7), PATH, bos=False, eos=False).collect()
    assert {_ids(r.ids) == library.encode(texts[r.doc_id] or "") for r in bare if r.doc_id is not None} == {True}
    empty = spark.createDataFrame([(1, None)], "doc_id long, ids binary")
    assert piecebpe.decode(empty, PATH).collect()[0].text == ""
