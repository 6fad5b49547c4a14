"""Stupid-backoff language-model scores of all documents, from n-gram counts of all documents.

Documents are dealt to blocks by hash.  Each block asks for the corpus count
of its distinct n-grams; the count table is partitioned by n-gram hash, and a
partition sums what all blocks have of an n-gram and answers each block.
Joined with its answers, a block scores its documents and sums per document.
So an n-gram travels once per block that has it, however often it occurs, as
a few bytes of a packed array; a very common one is a row per block, and no
task holds more than a block or a partition of the table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualis.llm.bagminhash import mixed
from qualis.llm.common import id_and_text, table

ORDER, ALPHA = 2, 0.4
#: Characters a block has on average, and distinct n-grams a partition of the count table receives (estimated).
BLOCK_CHARS, PART_NGRAMS = 8_000_000, 1_000_000


class Ngrams:
    """The n-grams up to an order of a list of texts; the empty one, of order 0, occurs once per word.

    ``hashes`` are the distinct ones in ascending order, ``counts`` how often
    each occurs, ``at[k][i]`` the place of the k-gram that ends at word i (-1
    where the text has fewer words before).
    """

    def __init__(self, texts: list[str], order: int):
        split = [t.encode("utf-8", "surrogatepass").split() for t in texts]
        self.n = np.array([len(w) for w in split], np.int64)
        self.doc = np.repeat(np.arange(len(texts)), self.n)
        flat = [w for own in split for w in own]
        del split
        known = {w: xxhash.xxh3_64_intdigest(w) for w in set(flat)}
        words = np.fromiter(map(known.__getitem__, flat), np.uint64, len(flat))
        del flat, known
        place = np.arange(len(words)) - (np.cumsum(self.n) - self.n)[self.doc]
        gram, grams, valid = np.zeros(len(words), np.uint64), [np.zeros(len(words), np.uint64)], [np.ones(len(words), bool)]
        for k in range(1, order + 1):
            gram = mixed(np.concatenate([np.zeros(1, np.uint64), gram[:-1]]) * np.uint64(0x9E3779B97F4A7C15) + words) if k > 1 else mixed(words)
            grams.append(gram)
            valid.append(place >= k - 1)
        every = np.concatenate([g[v] for g, v in zip(grams, valid)])
        self.hashes, inverse, self.counts = np.unique(every, return_inverse=True, return_counts=True)
        self.at, start = [], 0
        for v in valid:
            own = np.full(len(words), -1, np.int64)
            own[v] = inverse[start:start + int(v.sum())]
            start += int(v.sum())
            self.at.append(own)

    def own_counts(self, k: int) -> np.ndarray:
        """How often the text of word i has the k-gram that ends there."""
        if k == 0:
            return self.n[self.doc]
        key = self.doc * np.int64(len(self.hashes) + 1) + self.at[k]
        _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
        return counts[inverse]


def score(texts: list[str], grams: Ngrams, totals: np.ndarray, order: int, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """(sum of log scores, number of words scored below the longest n-gram) per text.

    ``totals`` are corpus counts; what the text itself has is taken off.  A
    word scores count(n-gram) / count(its context) for the longest n-gram
    that other texts have, times alpha for each step down from the longest
    that its place allows; a word that no other text has counts as one in a
    corpus larger by one, another step down.
    """
    n_words = len(grams.doc)
    rest = [np.where(at >= 0, totals[np.maximum(at, 0)] - grams.own_counts(k), 0) for k, at in enumerate(grams.at)]
    longest = np.zeros(n_words, np.int64)
    for k in range(1, order + 1):
        longest[grams.at[k] >= 0] = k
    log, level = np.full(n_words, np.nan), np.zeros(n_words, np.int64)
    for k in range(order, 0, -1):
        take = np.isnan(log) & (grams.at[k] >= 0) & (rest[k] > 0)
        i = np.flatnonzero(take)
        # the context of the k-gram that ends at i is the (k-1)-gram that ends at i - 1; of order 0: all words
        context = rest[0][i] if k == 1 else _context(grams, totals, k - 1, i)
        log[i] = np.log(rest[k][i] / np.maximum(context, rest[k][i]))
        level[i] = k
    none = np.isnan(log)
    log[none] = -np.log(rest[0][none] + 1.0)
    steps = longest - level
    log += steps * np.log(alpha)
    n = len(texts)
    return np.bincount(grams.doc, weights=log, minlength=n), np.bincount(grams.doc, weights=steps > 0, minlength=n).astype(np.int64)


def _context(grams: Ngrams, totals: np.ndarray, k: int, i: np.ndarray) -> np.ndarray:
    return totals[grams.at[k][i - 1]] - grams.own_counts(k)[i - 1]


def _slices(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Where each partition's range of hashes begins, and the end."""
    width = (1 << 64) // parts + 1
    return np.concatenate([np.searchsorted(hashes, np.array([p * width for p in range(parts)], np.uint64)), [len(hashes)]])


def pack_ascending(x: np.ndarray) -> bytes:
    """Ascending unsigned 64-bit integers as steps of as many bytes as the largest needs."""
    steps = np.diff(x, prepend=np.uint64(0))
    size = max(1, (int(steps.max(initial=0)).bit_length() + 7) // 8)
    return bytes([size]) + np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]).tobytes()


def unpack_ascending(data: bytes) -> np.ndarray:
    size = data[0]
    steps = np.zeros(((len(data) - 1) // size, 8), np.uint8)
    steps[:, :size] = np.frombuffer(data, np.uint8, offset=1).reshape(-1, size)
    return np.cumsum(steps.reshape(-1).view("<u8"), dtype=np.uint64)


def pack_counts(x: np.ndarray) -> bytes:
    """Counts as a byte each; those of 255 and more follow as 8 bytes each."""
    return np.minimum(x, 255).astype(np.uint8).tobytes() + x[x >= 255].astype("<i8").tobytes()


def unpack_counts(data: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(data, np.uint8, count=n).astype(np.int64)
    out[out == 255] = np.frombuffer(data, "<i8", offset=n)
    return out


_REQUEST = pa.schema([("block", pa.int64()), ("part", pa.int64()), ("n", pa.int64()), ("hashes", pa.binary()), ("counts", pa.binary())])


def _ask(order: int, parts: int):
    """A block's documents to its distinct n-grams and their counts, a row per partition of the table."""

    def run(block: pa.Table) -> pa.Table:
        grams = Ngrams(block.column("text").to_pylist(), order)
        cuts = _slices(grams.hashes, parts)
        number = block.column("block")[0].as_py()
        rows = [(number, p, j - i, pack_ascending(grams.hashes[i:j]), pack_counts(grams.counts[i:j])) for p, (i, j) in enumerate(zip(cuts, cuts[1:])) if j > i]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 5, _REQUEST.types)], schema=_REQUEST)

    return run


def _answer(requests: pa.Table) -> pa.Table:
    """All requests of one partition of the table to (block, part, n, counts): the sums over all blocks."""
    blocks, sizes = requests.column("block").to_pylist(), requests.column("n").to_pylist()
    hashes = [unpack_ascending(h) for h in requests.column("hashes").to_pylist()]
    counts = [unpack_counts(c, n) for c, n in zip(requests.column("counts").to_pylist(), sizes)]
    _, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
    totals = np.bincount(inverse, weights=np.concatenate(counts)).astype(np.int64)[inverse]
    ends = np.cumsum(sizes)
    return pa.table({"block": pa.array(blocks, pa.int64()), "part": requests.column("part"), "n": pa.array(sizes, pa.int64()),
                     "totals": pa.array([pack_counts(totals[e - n:e]) for e, n in zip(ends, sizes)], pa.binary())})


_SCORES = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_backed_off", pa.int64()), ("log_score", pa.float64())])


def _score_block(order: int, alpha: float):
    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        texts = block.column("text").to_pylist()
        if not texts:
            return _SCORES.empty_table()
        grams = Ngrams(texts, order)
        parts = sorted(zip(answers.column("part").to_pylist(), answers.column("n").to_pylist(), answers.column("totals").to_pylist()))
        totals = np.concatenate([unpack_counts(t, n) for _, n, t in parts]) if parts else np.zeros(0, np.int64)
        log, backed = score(texts, grams, totals, order, alpha)
        return pa.table([block.column("doc_id").combine_chunks(), pa.array(grams.n), pa.array(backed), pa.array(log)], schema=_SCORES)

    return run


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, alpha: float = ALPHA,
              block_chars: int = BLOCK_CHARS, part_ngrams: int = PART_NGRAMS) -> DataFrame:
    """Every row's score: doc_id, n_words, n_backed_off, log_score (summed over words), mean_log_score.

    Counts come from all rows but the scored one (a copy of it counts).
    Texts without words (null, empty, blank) score 0 with a null mean.  Null
    ids stay null; repeated rows are scored each, as copies of each other.  An
    empty table gives no rows.  n-grams are told apart by a 64-bit hash.
    """
    rows = id_and_text(docs, id_col, text_col)
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n_blocks = chars // block_chars + 1
    parts = max(64, chars * order // 6 // part_ngrams)  # about six characters a word; most n-grams of a block are distinct
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).cast("long"))
    requests = dealt.groupBy("block").applyInArrow(_ask(order, parts), "block long, part long, n long, hashes binary, counts binary")
    answers = requests.groupBy("part").applyInArrow(_answer, "block long, part long, n long, totals binary")
    scored = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _score_block(order, alpha), "doc_id long, n_words long, n_backed_off long, log_score double")
    return scored.withColumn("mean_log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")))


def query(spark, sf_dir: str) -> DataFrame:
    """op9: scores of all documents."""
    return lm_scores(table(spark, sf_dir, "documents"))
