"""Alignment of two tokenizers' tokens over the same texts, and how common each linked pair of ids is.

Per batch of documents, the tokens of either side are a pandas frame of
(document, start, end).  ``merge_asof`` by document finds for each token
start the other side's covering token, in both directions; the union of the
two is every overlapping pair of tokens.  A pair with equal ends closes a
group, and all tokens of a group are linked.

Which share of a corpus holds a pair of ids linked is counted without a row
per link: the aligning task writes each document's distinct pairs as one
packed row, and the distinct pairs of a block of documents, with their
numbers of documents, as another.  Only the latter are exploded, summed by
pair, and sent back to the blocks that asked, so a pair travels once a block.
A block is bounded by its texts' length.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualis.llm.common import blocks, id_and_text, saved, table
from qualis.llm.tokens import _byte_letters

#: Characters of text in a block, and links that are expanded at a time.
BLOCK_CHARS = 8_000_000
LINKS_AT_A_TIME = 1 << 21
#: Characters whose class no Unicode version changes; texts with others go through the file's own tokenizer.
SETTLED = re.compile("[\t\n\r\x20-\x7e\xa1-\u024fΑ-ΡΣ-ωЀ-ҁҊ-ԯ‐-‧ぁ-ゖァ-ヺ一-龥가-힣\U0001f300-\U0001faff]*")


class ByteTokenizer:
    """Encodes texts to packed ids (little-endian unsigned 32-bit), exactly as a byte-level BPE file does.

    The merges run in tiktoken, from the file's own vocabulary.  It joins
    any pair whose joined bytes are a token, the lowest id first; the file
    lists pairs.  Where ids rise in the order of the merges and every token's
    own text is encoded as that token, only a listed pair can ever stand side
    by side, so both give the same ids; a file without that is refused.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self._full = Tokenizer.from_file(path)
        self._full.encode_special_tokens = True  # their strings in a text are ordinary text
        byte_of = {c: b for b, c in enumerate(_byte_letters())}
        vocabulary = self._full.get_vocab(with_added_tokens=False)
        alone = self._full.model.tokenize
        with open(path, encoding="utf-8") as f:
            merged = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in json.load(f)["model"]["merges"]]
        if merged != sorted(merged) or any([t.id for t in alone(token)] != [i] for token, i in vocabulary.items() if len(token) > 1):
            raise ValueError(f"{path}: ids do not follow the merges")
        self.surface = [b""] * self._full.get_vocab_size(with_added_tokens=True)
        for token, i in vocabulary.items():
            self.surface[i] = bytes(byte_of[c] for c in token)
        self._ranked = tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                         mergeable_ranks={s: i for i, s in enumerate(self.surface) if s})

    def packed(self, text: str) -> bytes:
        if not text:
            return b""
        if SETTLED.fullmatch(text) is None:
            return np.array(self._full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self._ranked.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()


class PieceTokenizer:
    """Encodes texts to packed ids as a SentencePiece model does, which puts a space before them."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self._model = model = SentencePieceProcessor(model_file=path)
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.surface = [bytes([int(p[1:-1], 16)]) if model.is_byte(i) else b"" if model.is_control(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]

    def packed(self, text: str) -> bytes:
        return np.array(self._model.encode(text, num_threads=1), "<u4").tobytes()


_LOADED: dict[tuple[str, str], tuple] = {}


def _models(a_path: str, b_path: str) -> tuple:
    """Both tokenizers and their tokens' bytes: once per worker process."""
    if (a_path, b_path) not in _LOADED:
        a, b = ByteTokenizer(a_path), PieceTokenizer(b_path)
        _LOADED[a_path, b_path] = a, b, Surfaces(a.surface), Surfaces(b.surface)
    return _LOADED[a_path, b_path]


class Surfaces:
    """The bytes of each id, for many ids at once."""

    def __init__(self, surface: list[bytes]):
        self.lengths = np.array([len(s) for s in surface], np.int64)
        self._bytes = np.frombuffer(b"".join(surface), np.uint8)
        self._starts = np.cumsum(self.lengths) - self.lengths

    def joined(self, ids: np.ndarray) -> np.ndarray:
        parts = []
        for at in range(0, len(ids), 1 << 17):  # keeps the index arrays small
            some = ids[at:at + (1 << 17)]
            lengths = self.lengths[some]
            ends = np.cumsum(lengths)
            parts.append(self._bytes[np.repeat(self._starts[some] - ends + lengths, lengths) + np.arange(ends[-1])])
        return np.concatenate(parts) if parts else np.zeros(0, np.uint8)


class Side:
    """One tokenizer's tokens of several documents: per token id, document, start and end over all documents' bytes."""

    def __init__(self, packed: list[bytes], surfaces: Surfaces):
        self.ids = np.frombuffer(b"".join(packed), "<u4").astype(np.int64)
        self.counts = np.array([len(p) // 4 for p in packed], np.int64)
        self.doc = np.repeat(np.arange(len(packed)), self.counts)
        lengths = surfaces.lengths[self.ids]
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths

    def frame(self, name: str) -> pd.DataFrame:
        return pd.DataFrame({"doc": self.doc, "at": self.starts, name: np.arange(len(self.ids))})


def overlaps(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of an A and a B token (their numbers) that share a byte."""
    left, right = a.frame("a"), b.frame("b")
    cover_b = pd.merge_asof(left, right, on="at", by="doc")["b"].to_numpy(np.int64)
    cover_a = pd.merge_asof(right, left, on="at", by="doc")["a"].to_numpy(np.int64)
    own_b = np.arange(len(cover_a))
    new = a.starts[cover_a] != b.starts  # tokens with one start found each other both ways
    return np.concatenate([np.arange(len(cover_b)), cover_a[new]]), np.concatenate([cover_b, own_b[new]])


def token_groups(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """The group number of each A and each B token: places where both sides end a token cut documents into groups."""
    pair_a, pair_b = overlaps(a, b)
    equal = a.ends[pair_a] == b.ends[pair_b]
    numbers = []
    for side, tokens in ((a, pair_a[equal]), (b, pair_b[equal])):
        cut = np.zeros(len(side.ids), np.int64)
        cut[tokens] = 1
        numbers.append(np.cumsum(cut) - cut)
    return numbers[0], numbers[1]


def _distinct(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with the sums of their times."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(times[order], first) if len(first) else times


class Aligned:
    """Several documents' alignment; documents without tokens (no text, or bytes that differ) have zeros."""

    def __init__(self, texts: list[str], a_model, b_model, a_surfaces: Surfaces, b_surfaces: Surfaces):
        raw = [(" " + t).encode() if t else b"" for t in texts]
        a_ids = [a_model.packed(" " + t) if t else b"" for t in texts]
        b_ids = [b_model.packed(t) for t in texts]
        for k in self._differing(raw, a_ids, a_surfaces) | self._differing(raw, b_ids, b_surfaces):
            a_ids[k] = b_ids[k] = b""
        self.n = len(texts)
        self.a, self.b = Side(a_ids, a_surfaces), Side(b_ids, b_surfaces)
        self.group_a, self.group_b = token_groups(self.a, self.b)
        n_groups = int(self.group_a[-1]) + 1 if len(self.group_a) else 0
        self.size_a = np.bincount(self.group_a, minlength=n_groups)
        self.size_b = np.bincount(self.group_b, minlength=n_groups)
        self.first_b = np.cumsum(self.size_b) - self.size_b
        self.group_doc = self.a.doc[np.cumsum(self.size_a) - self.size_a] if n_groups else np.zeros(0, np.int64)
        self.n_groups = np.bincount(self.group_doc, minlength=self.n)
        links = np.zeros(self.n, np.int64)
        np.add.at(links, self.group_doc, self.size_a * self.size_b)
        self.n_links = links

    @staticmethod
    def _differing(raw: list[bytes], packed: list[bytes], surfaces: Surfaces) -> set[int]:
        """The documents whose joined token bytes are not their text's."""
        ids = np.frombuffer(b"".join(packed), "<u4")
        got = np.concatenate([[0], np.cumsum(surfaces.lengths[ids])])[np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])])]
        want = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
        if np.array_equal(got, want):
            wrong = np.flatnonzero(surfaces.joined(ids) != np.frombuffer(b"".join(raw), np.uint8))
            return set((np.searchsorted(want, np.unique(wrong), "right") - 1).tolist())
        return {k for k, (r, p) in enumerate(zip(raw, packed)) if surfaces.joined(np.frombuffer(p, "<u4")).tobytes() != r}

    def spelled(self, decimals: Surfaces) -> list[memoryview]:
        """Per document its groups as a1,a2|b1;a3|b2,b3 (``decimals``: per id its digits and ',', then '|', then ';')."""
        at_a = np.arange(len(self.a.ids)) + self.first_b[self.group_a]
        at_b = np.arange(len(self.b.ids)) + np.cumsum(self.size_a)[self.group_b]
        codes = np.empty(len(at_a) + len(at_b), np.int64)
        codes[at_a], codes[at_b] = 3 * self.a.ids, 3 * self.b.ids
        codes[at_a[np.cumsum(self.size_a) - 1]] += 1
        codes[at_b[np.cumsum(self.size_b) - 1]] += 2
        letters = memoryview(decimals.joined(codes))
        tokens = np.concatenate([[0], np.cumsum(self.a.counts + self.b.counts)])
        ends = np.concatenate([[0], np.cumsum(decimals.lengths[codes])])[tokens]
        return [letters[lo:max(lo, hi - 1)] for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist())]

    def pairs(self, b_size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(document, distinct id pairs as a * b_size + b, their numbers of links); a document of very many links in parts that share no pair."""
        a_ends = np.cumsum(self.a.counts)
        lo = 0
        while lo < self.n:
            hi = max(lo + 1, int(np.searchsorted(np.cumsum(self.n_links[lo:]), LINKS_AT_A_TIME, "right")) + lo)
            tokens = np.arange(a_ends[lo] - self.a.counts[lo], a_ends[hi - 1])
            if self.n_links[lo] > LINKS_AT_A_TIME:
                yield from ((lo, k, t) for k, t in self._large(tokens, b_size))
            elif len(tokens):
                n_b = self.size_b[self.group_a[tokens]]
                which = np.repeat(np.arange(len(tokens)), n_b)
                b_tokens = np.arange(len(which)) - np.repeat(np.cumsum(n_b) - n_b - self.first_b[self.group_a[tokens]], n_b)
                own = self.a.ids[tokens][which] * b_size + self.b.ids[b_tokens]
                span = b_size * (int(self.a.ids[tokens].max()) + 1)
                keys, times = _distinct((self.a.doc[tokens][which] - lo) * span + own, np.ones(len(own), np.int64))
                cuts = np.searchsorted(keys, np.arange(hi - lo + 1) * span)
                for k in range(hi - lo):
                    if cuts[k] < cuts[k + 1]:
                        yield lo + k, keys[cuts[k]:cuts[k + 1]] - k * span, times[cuts[k]:cuts[k + 1]]
            lo = hi

    def _large(self, tokens: np.ndarray, b_size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """A document's pairs by ranges of A ids; tokens of one id and group count together on either side."""
        groups = np.arange(self.group_a[tokens[0]], self.group_a[tokens[-1]] + 1)
        b_tokens = np.arange(self.first_b[groups[0]], self.first_b[groups[-1]] + self.size_b[groups[-1]])
        b_keys, b_times = _distinct((self.group_b[b_tokens] - groups[0]) * b_size + self.b.ids[b_tokens], np.ones(len(b_tokens), np.int64))
        b_first = np.searchsorted(b_keys, (groups - groups[0]) * b_size)
        b_count = np.diff(np.append(b_first, len(b_keys)))
        a_keys, a_times = _distinct(self.a.ids[tokens] * len(groups) + self.group_a[tokens] - groups[0], np.ones(len(tokens), np.int64))
        a_id, group = a_keys // len(groups), a_keys % len(groups)
        work = np.cumsum(b_count[group])
        lo = 0
        while lo < len(a_id):
            hi = max(lo + 1, int(np.searchsorted(work, (work[lo - 1] if lo else 0) + LINKS_AT_A_TIME, "right")))
            hi = int(np.searchsorted(a_id, a_id[hi - 1], "right"))  # no id in two parts
            n = b_count[group[lo:hi]]
            which = np.repeat(np.arange(lo, hi), n)
            b_at = np.arange(len(which)) - np.repeat(np.cumsum(n) - n - b_first[group[lo:hi]], n)
            yield _distinct(a_id[which] * b_size + b_keys[b_at] % b_size, a_times[which] * b_times[b_at])
            lo = hi


_ROWS = pa.schema([("block", pa.int64()), ("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                   ("n_links", pa.int64()), ("groups", pa.string()), ("pairs", pa.binary()), ("times", pa.binary()),
                   ("asked", pa.list_(pa.int64())), ("docs", pa.list_(pa.int64()))])
_ROWS_DDL = ("block long, row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs binary, times binary, "
             "asked array<long>, docs array<long>")


class Block:
    """The distinct pairs of the documents since the last block, with their numbers of documents."""

    def __init__(self, number: int):
        self.number, self.chars, self.rows = number, 0, 0
        self._keys, self._docs = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._new: list[np.ndarray] = []
        self._n_new = 0

    def add(self, keys: np.ndarray) -> None:
        self._new.append(keys)
        self._n_new += len(keys)
        if self._n_new > max(len(self._keys), LINKS_AT_A_TIME):
            self._fold()

    def _fold(self) -> None:
        keys = np.concatenate([self._keys, *self._new])
        self._keys, self._docs = _distinct(keys, np.concatenate([self._docs, np.ones(self._n_new, np.int64)]))
        self._new, self._n_new = [], 0

    def summary(self) -> pa.RecordBatch:
        self._fold()
        return _batch({"block": [self.number], "asked": [self._keys], "docs": [self._docs]})


def _batch(columns: dict[str, list]) -> pa.RecordBatch:
    n = len(columns["block"])
    return pa.RecordBatch.from_arrays([pa.array(columns.get(f.name, [None] * n), f.type) for f in _ROWS], schema=_ROWS)


def _pair_type(a_size: int, b_size: int) -> str:
    return "<u4" if a_size * b_size < 1 << 32 else "<u8"


def aligned(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """Per row of ``docs`` its alignment, and per block of rows the pairs it asks the corpus for.

    A is a byte-level BPE file and encodes a space and the text, B a piece
    model, which puts the space itself.  Rows with doc_id: n_a, n_b,
    n_groups, n_links, groups (a1,a2|b1;a3|b2,b3, or with ``digest`` its
    SHA-256 in hexadecimal; '' without tokens), pairs and times (distinct id
    pairs a * size of B + b and their links, packed; a row of very
    many links goes on in further rows of the same block and row, where only
    these two are set).  Other rows, one a block: asked, docs (its distinct
    pairs and how many of its rows hold each).

    Null or empty texts, and texts whose tokens' bytes are not a space and
    the text, have zeros and ''; null ids and repeated rows stay as they are;
    an empty table gives no rows; other columns are not read.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_model, b_model, a_surfaces, b_surfaces = _models(a_path, b_path)
        b_size = len(b_model.surface)
        pair_type = _pair_type(len(a_model.surface), b_size)
        decimals = Surfaces([b"%d%c" % (i, c) for i in range(max(len(a_model.surface), b_size)) for c in b",|;"])
        block = Block(TaskContext.get().partitionId() << 33)
        for rows in blocks(batches):
            texts = rows["text"]
            found = Aligned(texts, a_model, b_model, a_surfaces, b_surfaces)
            groups = [(hashlib.sha256(s).hexdigest() if digest else bytes(s).decode()) if s else "" for s in found.spelled(decimals)]
            pairs, times = [b""] * found.n, [b""] * found.n
            for k, own, links in found.pairs(b_size):
                block.add(own)
                if pairs[k]:
                    yield _batch({"block": [block.number], "row": [block.rows + k], "pairs": [pairs[k]], "times": [times[k]]})
                pairs[k], times[k] = own.astype(pair_type).tobytes(), links.astype("<u4").tobytes()
            yield _batch({"block": [block.number] * found.n, "row": range(block.rows, block.rows + found.n), "doc_id": rows["doc_id"],
                          "n_a": found.a.counts, "n_b": found.b.counts, "n_groups": found.n_groups, "n_links": found.n_links, "groups": groups,
                          "pairs": pairs, "times": times})
            block.rows += found.n
            block.chars += sum(map(len, texts))
            if block.chars >= BLOCK_CHARS:
                yield block.summary()
                block = Block(block.number + 1)
        if block.rows:
            yield block.summary()

    return id_and_text(docs, id_col, text_col).mapInArrow(run, _ROWS_DDL)


def pair_counts(asks: DataFrame, b_size: int) -> DataFrame:
    """Per id pair of ``asks`` (asker, pair, docs): n_docs, the documents that hold it, and best, whether no pair of its A id is held by more."""
    counts = saved(asks.groupBy("pair").agg(F.sum("docs").alias("n_docs")), "pairs")
    a_id = F.floor(F.col("pair") / b_size)
    most = counts.groupBy(a_id.alias("a_id")).agg(F.max("n_docs").alias("most"))
    # one row for each A id at most: bounded by the vocabulary
    return counts.withColumn("a_id", a_id).join(F.broadcast(most), "a_id").select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))


def link_scores(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups (see ``aligned``).

    A pair's count is the number of rows that hold it linked; n_best counts
    the row's links whose count no other pair of their A id exceeds,
    count_sum adds the counts over the row's links.
    """
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    b_size = SentencePieceProcessor(model_file=b_path).get_piece_size()
    pair_type = _pair_type(Tokenizer.from_file(a_path).get_vocab_size(with_added_tokens=True), b_size)
    rows = saved(aligned(docs, a_path, b_path, id_col, text_col, digest), "aligned")
    asks = rows.where("asked IS NOT NULL").select(F.col("block").alias("asker"), F.explode(F.arrays_zip("asked", "docs")).alias("ask"))
    asks = asks.select("asker", F.col("ask.asked").alias("pair"), F.col("ask.docs").alias("docs"))
    answers = asks.join(pair_counts(asks, b_size), "pair").select("asker", "pair", "n_docs", "best")
    held = rows.where("asked IS NULL").drop("asked", "docs")

    def score(own: pa.Table, told: pa.Table) -> pa.Table:
        pair = told["pair"].to_numpy()
        order = np.argsort(pair)
        pair, n_docs, best = pair[order], told["n_docs"].to_numpy()[order], told["best"].to_numpy()[order]
        number = own["row"].to_numpy()
        n_best, count_sum = np.zeros(number.max() + 1, np.int64), np.zeros(number.max() + 1, np.int64)
        for part in own.select(["row", "pairs", "times"]).to_batches(max_chunksize=2000):
            pairs = part["pairs"].to_pylist()
            times = np.frombuffer(b"".join(part["times"].to_pylist()), "<u4").astype(np.int64)
            at = np.searchsorted(pair, np.frombuffer(b"".join(pairs), pair_type).astype(np.int64))
            row = np.repeat(part["row"].to_numpy(), [len(p) // np.dtype(pair_type).itemsize for p in pairs])
            np.add.at(n_best, row, times * best[at])
            np.add.at(count_sum, row, times * n_docs[at])
        first = own.filter(pyarrow.compute.is_valid(own["n_a"]))
        number = first["row"].to_numpy()
        out = first.select(["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"])
        return out.append_column("n_best", pa.array(n_best[number])).append_column("count_sum", pa.array(count_sum[number]))

    # a task for each block, however many there are
    n_blocks = max(1, rows.where("asked IS NOT NULL").count())
    held, answers = held.repartition(n_blocks, "block"), answers.repartition(n_blocks, "asker")
    return held.groupBy("block").cogroup(answers.groupBy("asker")).applyInArrow(
        score, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, n_best long, count_sum long")


def query(spark, sf_dir: str) -> DataFrame:
    """op11: every document's alignment in figures, its groups as their SHA-256."""
    import public_tokenizers

    found = link_scores(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")
