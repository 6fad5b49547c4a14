import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
from qualis.llm import align  # noqa: E402

A_PATH, B_PATH = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, block long, pairs string, groups int"
TEXTS = ["", None, " ", "a b", "One two three, don't 12345!\n\nfour\t ", "a▁b", "<|endoftext|> <s>x</s> <0x41>", "ñandú 日本語 текст 🙂🙂 étéééé", "İ ſ  \x85 \x00\x01 ٣",
         "x" * 300, "=-=-" * 60 + " " * 33, "word " * 50, "One two three, don't 12345!\n\nfour\t "]


class Brute:
    """The contract with plain loops over the libraries' tokens."""

    def __init__(self):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(A_PATH)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=B_PATH)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        self.bytes = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}

    def groups(self, text):
        if not text:
            return []
        a = [(i, bytes(self.bytes[c] for c in self.a.id_to_token(i))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(self.b.id_to_piece(i)[1:-1], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()) for i in self.b.encode(text)]
        raw = (" " + text).encode()
        if b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
            return []
        ends = [set(np.cumsum([len(x) for _, x in side]).tolist()) for side in (a, b)]
        cuts = sorted(ends[0] & ends[1])
        out = [([], []) for _ in cuts]
        for side, tokens in enumerate((a, b)):
            at = group = 0
            for i, x in tokens:
                at += len(x)
                out[group][side].append(i)
                group += at == cuts[group]
        return out

    def results(self, texts):
        groups = [self.groups(t) for t in texts]
        links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
        held = Counter(p for own in links for p in own)
        most = defaultdict(int)
        for (x, _), n in held.items():
            most[x] = max(most[x], n)
        rows = []
        for g, own in zip(groups, links):
            spelled = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
            rows.append((sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(own.values()), spelled,
                         sum(n for p, n in own.items() if held[p] == most[p[0]]), sum(n * held[p] for p, n in own.items())))
        return rows


@pytest.fixture(scope="module")
def brute():
    return Brute()


def _found(df):
    return sorted(((r.doc_id if r.doc_id is not None else -1), r.n_a, r.n_b, r.n_groups, r.n_links, r.groups, r.n_best, r.count_sum) for r in df.collect())


def test_scores_equal_brute_force_in_any_layout(spark, brute):
    want = sorted((i, *r) for i, r in enumerate(brute.results(TEXTS)))
    docs = spark.createDataFrame([(i, t, 7, "own", 3) for i, t in enumerate(TEXTS)], SCHEMA)
    assert _found(align.link_scores(docs.coalesce(1), A_PATH, B_PATH)) == want
    assert _found(align.link_scores(docs.repartition(5), A_PATH, B_PATH)) == want


def test_repeated_rows_null_ids_and_empty_tables(spark, brute):
    rows = [(1, "same text"), (1, "same text"), (None, "same text"), (None, "other texts here")]
    docs = spark.createDataFrame([(i, t, 0, "", 0) for i, t in rows], SCHEMA)
    assert _found(align.link_scores(docs, A_PATH, B_PATH)) == sorted((i if i is not None else -1, *r) for (i, _), r in zip(rows, brute.results([t for _, t in rows])))
    assert align.link_scores(docs.limit(0), A_PATH, B_PATH).count() == 0


def test_small_blocks_and_documents_of_many_links(spark, brute, monkeypatch):
    # tasks read the bounds of their own process: pairs of every document go through the parts of large ones there
    a, b, a_surfaces, b_surfaces = align._models(A_PATH, B_PATH)
    texts = [t or "" for t in TEXTS] + ["don't stop, " * 400 + "日本語🙂" * 50]
    whole = align.Aligned(texts, a, b, a_surfaces, b_surfaces)
    want = {k: (keys.tolist(), times.tolist()) for k, keys, times in whole.pairs(32000)}
    monkeypatch.setattr(align, "LINKS_AT_A_TIME", 3)
    parts = defaultdict(lambda: ([], []))
    for k, keys, times in whole.pairs(32000):
        parts[k][0].extend(keys.tolist())
        parts[k][1].extend(times.tolist())
    assert {k: tuple(map(list, zip(*sorted(zip(*v))))) for k, v in parts.items()} == want
    assert sum(sum(t) for _, t in want.values()) == whole.n_links.sum()
    block = align.Block(4)
    for keys, _ in want.values():
        block.add(np.array(keys))
    row = block.summary().to_pylist()[0]
    assert dict(zip(row["asked"], row["docs"])) == Counter(k for keys, _ in want.values() for k in keys)


def test_overlaps_are_all_pairs_that_share_a_byte():
    a, b, a_surfaces, b_surfaces = align._models(A_PATH, B_PATH)
    found = align.Aligned(["undesirable étéé 日本", "x" * 40, "", "12 345"], a, b, a_surfaces, b_surfaces)
    got = sorted(zip(*map(np.ndarray.tolist, align.overlaps(found.a, found.b))))
    want = [(i, j) for i, (s, e) in enumerate(zip(found.a.starts, found.a.ends)) for j, (t, f) in enumerate(zip(found.b.starts, found.b.ends)) if s < f and t < e]
    assert got == want


def test_bytes_that_differ_leave_a_document_without_tokens():
    a, b, a_surfaces, b_surfaces = align._models(A_PATH, B_PATH)
    found = align.Aligned(["ok", "a▁b", "two"], a, b, a_surfaces, b_surfaces)
    assert found.a.counts[1] == found.b.counts[1] == found.n_groups[1] == 0 and found.n_groups[[0, 2]].min() > 0


def test_byte_tokenizer_is_the_librarys_on_random_texts(brute):
    import random

    a, draw = align._models(A_PATH, B_PATH)[0], random.Random(9)
    ranges = [(0, 0x2ff), (0x391, 0x52f), (0x2010, 0x2027), (0x3041, 0x30ff), (0xac00, 0xd7a3), (0x1f300, 0x1faff)]
    for _ in range(3000):
        text = "".join(draw.choice(["a", "B", " ", "  ", "\n", "'s", "'ll", "12", chr(draw.randint(*draw.choice(ranges)))]) for _ in range(draw.randint(1, 25)))
        assert np.frombuffer(a.packed(text), "<u4").tolist() == brute.a.encode(text, add_special_tokens=False).ids


def test_query_equals_brute_force(spark, brute):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    want = sorted((r.doc_id, a, b, g, n, hashlib.sha256(s.encode()).hexdigest() if s else "", best, total)
                  for r, (a, b, g, n, s, best, total) in zip(rows, brute.results([r.text for r in rows])))
    got = align.query(spark, "/root/testdata/sf0.001").withColumnRenamed("groups_sha256", "groups")
    assert _found(got) == want
