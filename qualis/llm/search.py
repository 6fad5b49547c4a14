"""Ranked lexical search: an inverted index in shards, searched by Block-Max MaxScore.

``build`` turns documents into a table of postings.  A shard is a run of
rows of one task, bounded by its texts' length.  Each term's postings in a
shard are cut into blocks of 128; a block keeps, beside its packed postings,
the pairs of (occurrences, document length) that no other of its postings
beats.  From them its highest possible score follows for any corpus
statistics, which are known only when all shards exist.

``search`` sends the query terms' blocks of a shard to one task and runs
every query there.  Documents go by in windows:

* the lists with the lowest bounds whose sum stays below the 50th best score
  so far are non-essential: a document that is only in them cannot enter;
* the other, essential, lists are summed for all documents of the window;
* a document goes on to the non-essential lists, highest bound first, as long
  as its sum, the maximum of the block it would be in and the bounds of the
  lists after that can still reach the 50th best score; blocks without such
  a document are never unpacked.

A shard gives at most 50 documents a query; the shards' lists are merged by
rank.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qualis.llm.common import id_and_text, saved, slices, table, text_of

#: Postings of a block; documents of a window; characters of texts in a shard.
BLOCK, WINDOW, SHARD_CHARS = 128, 2048, 24_000_000
#: Distinct (query, term) pairs that are searched in one pass over the index; more queries take more passes.
PASS_TERMS = 200_000
#: A term is a maximal run of ASCII letters and digits and of characters beyond ASCII; A-Z count as a-z.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_SEPARATORS = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))
_FOLD = _SEPARATORS.lower()

INDEX = ("shard long, term string, block int, first int, last int, postings int, terms long, rows binary, times binary, "
         "best_times binary, best_lengths binary")
_ARROW = pa.schema([("shard", pa.int64()), ("term", pa.string()), ("block", pa.int32()), ("first", pa.int32()), ("last", pa.int32()),
                    ("postings", pa.int32()), ("terms", pa.int64()), ("rows", pa.binary()), ("times", pa.binary()),
                    ("best_times", pa.binary()), ("best_lengths", pa.binary())])
_COLUMNS = ("term", "block", "first", "last", "postings", "rows", "times", "best_times", "best_lengths")


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def packed(values: np.ndarray) -> bytes:
    """Whole numbers in the narrowest of 1, 2 and 4 bytes each; the first byte tells which."""
    top = int(values.max()) if len(values) else 0
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


@lru_cache(maxsize=10_000)
def _one(value: int) -> bytes:
    return packed(np.array([value]))


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


class ShardIndex:
    """The postings of a run of documents, by term numbers in order of appearance."""

    def __init__(self, number: int):
        self.number, self.chars = number, 0
        self.doc_ids: list[int | None] = []
        self.lengths: list[int] = []
        self._terms: dict[bytes, int] = {}
        self._found: list[np.ndarray] = []

    def add(self, doc_id: int | None, text: bytes) -> None:
        number = self._terms
        words = terms_of(text)
        for w in set(words):
            if w not in number:
                number[w] = len(number)
        self._found.append(np.array(list(map(number.__getitem__, words)), np.int32))
        self.doc_ids.append(doc_id)
        self.lengths.append(len(words))
        self.chars += len(text)

    def batches(self) -> Iterator[pa.RecordBatch]:
        """The header row and the blocks."""
        lengths = np.array(self.lengths, np.int64)
        ids = pa.array(self.doc_ids, pa.int64())
        yield self._batch({"postings": [int((lengths > 0).sum())], "terms": [int(lengths.sum())], "times": [lengths.astype("<i8").tobytes()],
                           "rows": [ids.fill_null(0).to_numpy().astype("<i8").tobytes() + np.packbits(np.array(ids.is_valid())).tobytes()]})
        n = len(lengths)
        keys = np.concatenate([np.zeros(0, np.int32), *self._found]).astype(np.int64) * n + np.repeat(np.arange(n), lengths)
        self._found.clear()
        keys.sort()
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        times = np.diff(np.append(first, len(keys)))
        term, row = np.divmod(keys[first], n)
        starts = np.flatnonzero(np.diff(term, prepend=-1)).tolist()
        names = [w.decode() for w in self._terms]
        out: list[tuple] = []
        for lo, hi in zip(starts, [*starts[1:], len(term)]):
            name = names[term[lo]]
            if hi - lo == 1:  # most terms
                once = _one(int(times[lo]))
                out.append((name, 0, row[lo], row[lo], 1, _one(0), once, once, _one(self.lengths[row[lo]])))
                continue
            for at in range(lo, hi, BLOCK):
                own, often = row[at:min(at + BLOCK, hi)], times[at:min(at + BLOCK, hi)]
                best = _unbeaten(often, lengths[own])
                out.append((name, (at - lo) // BLOCK, own[0], own[-1], len(own), packed(np.diff(own, prepend=own[0])), packed(often),
                            packed(often[best]), packed(lengths[own[best]])))
        for at in range(0, len(out), 20_000):
            yield self._batch(dict(zip(_COLUMNS, zip(*out[at:at + 20_000]))))

    def _batch(self, columns: dict) -> pa.RecordBatch:
        n = len(columns["postings"])
        full = {"shard": [self.number] * n, **columns}
        return pa.RecordBatch.from_arrays([pa.array(full.get(f.name, [None] * n), f.type) for f in _ARROW], schema=_ARROW)


def _unbeaten(times: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The postings that no other of the block beats by more occurrences in a document no longer."""
    if len(times) == 1:
        return np.zeros(1, np.int64)
    order = np.lexsort((-times, lengths))
    top = np.maximum.accumulate(times[order])
    return order[np.concatenate([[True], top[1:] > top[:-1]])]


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index of all rows of ``docs`` (columns INDEX): per shard a header row, and the blocks of all terms.

    The header has no term; its postings are the documents that have terms,
    terms counts these with repeats, rows holds all documents' ids and which
    of them are known, times their lengths.

    A null or empty text has no terms; null ids and repeated rows are
    documents each; other columns are not read.  Write it as a table before
    searching: shard numbers hold the partition number.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = ShardIndex(TaskContext.get().partitionId() << 33)
        for part in slices(batches):
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()):
                shard.add(doc_id, text)
            if shard.chars >= SHARD_CHARS:
                yield from shard.batches()
                shard = ShardIndex(shard.number + 1)
        if shard.doc_ids:
            yield from shard.batches()

    return id_and_text(docs, id_col, text_col).mapInArrow(run, INDEX)


class Scale:
    """The part of a score that a document has in it, from the corpus' documents with terms and their terms."""

    def __init__(self, n_docs: int, n_terms: int):
        self._docs, self._terms = n_docs, max(n_terms, 1)

    def norm(self, lengths: np.ndarray) -> np.ndarray:
        return 100 - 50 + 50 * lengths * self._docs // self._terms

    @staticmethod
    def impact(times: np.ndarray, norm: np.ndarray) -> np.ndarray:
        return 1_000_000_000 * times // (1000 * times + 20 * norm)

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self._docs + 2) / (2 * df + 1)))


class Postings:
    """One term's blocks in a shard, with their highest scores."""

    def __init__(self, blocks: list[dict], weight: int, scale: Scale, norm: np.ndarray):
        self._blocks = sorted(blocks, key=lambda b: b["block"])
        self._weight, self._norm = weight, norm
        self.firsts = np.array([b["first"] for b in self._blocks])
        self.lasts = np.array([b["last"] for b in self._blocks])
        self.maxima = weight * np.array([scale.impact(unpacked(b["best_times"]), scale.norm(unpacked(b["best_lengths"]))).max() for b in self._blocks])
        self.bound = int(self.maxima.max())
        self.opened: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of block ``k``, unpacked at its first use."""
        if k not in self.opened:
            b = self._blocks[k]
            rows = np.cumsum(unpacked(b["rows"])) + b["first"]
            self.opened[k] = rows, self._weight * Scale.impact(unpacked(b["times"]), self._norm[rows])
        return self.opened[k]

    def add_all(self, sums: np.ndarray, lo: int) -> None:
        """Adds the scores of the rows lo.. to ``sums``."""
        hi = lo + len(sums)
        for k in range(int(np.searchsorted(self.lasts, lo)), int(np.searchsorted(self.firsts, hi))):
            rows, scores = self.block(k)
            if self.firsts[k] < lo or self.lasts[k] >= hi:
                a, b = np.searchsorted(rows, (lo, hi))
                rows, scores = rows[a:b], scores[a:b]
            sums[rows - lo] += scores

    def add_some(self, sums: np.ndarray, lo: int, rows: np.ndarray, least: int) -> np.ndarray:
        """Adds the scores of the ascending ``rows`` whose sums can reach ``least`` with their block's maximum; returns these rows."""
        k = np.searchsorted(self.lasts, rows)
        inside = k < len(self.lasts)
        inside[inside] = self.firsts[k[inside]] <= rows[inside]
        most = np.where(inside, self.maxima[np.minimum(k, len(self.lasts) - 1)], 0)
        hopeful = sums[rows - lo] + most >= least
        rows, k, inside = rows[hopeful], k[hopeful], inside[hopeful]
        for block in np.unique(k[inside]).tolist():
            own, scores = self.block(block)
            asked = rows[inside & (k == block)]
            at = np.searchsorted(own, asked)
            held = own[at] == asked
            sums[asked[held] - lo] += scores[at[held]]
        return rows


class Best:
    """The ``n`` best documents so far; equal scores by id."""

    def __init__(self, n: int, ids: np.ndarray):
        self._n, self._ids = n, ids
        self.rows, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        #: The least score with which a document may still enter.
        self.least = 1

    def offer(self, rows: np.ndarray, scores: np.ndarray) -> None:
        good = scores >= self.least
        rows, scores = np.concatenate([self.rows, rows[good]]), np.concatenate([self.scores, scores[good]])
        order = np.lexsort((self._ids[rows], -scores))[:self._n]
        self.rows, self.scores = rows[order], scores[order]
        if len(order) == self._n:
            self.least = int(self.scores[-1])


def best_of(lists: list[Postings], n_rows: int, best: Best) -> Best:
    """Block-Max MaxScore over the rows of a shard."""
    lists = sorted(lists, key=lambda p: p.bound)
    upto = np.cumsum([p.bound for p in lists]).tolist()
    for lo in range(0, n_rows, WINDOW):
        n_other = int(np.searchsorted(upto, best.least))  # non-essential: together below the least score
        if n_other == len(lists):
            break
        sums = np.zeros(min(WINDOW, n_rows - lo), np.int64)
        for p in lists[n_other:]:
            p.add_all(sums, lo)
        rest = upto[n_other - 1] if n_other else 0
        rows = np.flatnonzero((sums > 0) & (sums + rest >= best.least)) + lo
        for k in range(n_other - 1, -1, -1):
            if not len(rows):
                break
            rows = lists[k].add_some(sums, lo, rows, best.least - (upto[k - 1] if k else 0))
        best.offer(rows, sums[rows - lo])
    return best


def _search_shard(queries: list[list[str]], weights: dict[str, int], scale: Scale, top: int):
    """Arrow function of one shard's rows: per query its best documents there."""
    def run(shard: pa.Table) -> pa.Table:
        blocks: dict[str | None, list[dict]] = {}
        for row in shard.to_pylist():
            blocks.setdefault(row["term"], []).append(row)
        header = blocks.pop(None)[0]
        lengths = np.frombuffer(header["times"], "<i8")
        n = len(lengths)
        ids = np.frombuffer(header["rows"], "<i8", n)
        known = np.unpackbits(np.frombuffer(header["rows"], np.uint8, offset=8 * n), count=n).astype(bool)
        order = np.where(known, ids, np.iinfo(np.int64).max)
        norm = scale.norm(lengths)
        lists = {t: Postings(b, weights[t], scale, norm) for t, b in blocks.items()}
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for q, terms in enumerate(queries):
            own = [lists[t] for t in terms if t in lists]
            if own:
                best = best_of(own, n, Best(top, order))
                out.append((np.full(len(best.rows), q), best.rows, best.scores))
        none = np.zeros(0, np.int64)
        q, rows, scores = (np.concatenate([none, *c]) for c in zip(*out)) if out else (none, none, none)
        return pa.table({"query": pa.array(q, pa.int32()), "doc_id": pa.array(ids[rows], pa.int64(), mask=~known[rows]), "score": pa.array(scores, pa.int64())})

    return run


def terms_column(items: DataFrame, text_col: str):
    """The distinct terms of a query's whole text, natively."""
    lowered = F.translate(text_of(items, text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_distinct(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0)))


def search(index: DataFrame, items: DataFrame, top: int = 50, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Per item its ``top`` highest-scoring documents above 0: item_id, rank, doc_id, score.

    Equal scores stand by ascending doc_id, null ids last; repeated documents
    are ranked each.  Items that agree in id and text are one item, items of
    one id (null included) with different texts are ranked each.  Items
    without a term that a document holds, and all items over an empty index,
    give no rows.  Other columns are not read.

    Items are searched in passes over the index, of about PASS_TERMS distinct
    terms each; a pass keeps its items' terms and weights on the driver.
    """
    spark = items.sparkSession
    asked = items.select(items[id_col].alias("item_id"), text_of(items, text_col).alias("_text"), terms_column(items, text_col).alias("terms")).distinct()
    asked = asked.where(F.size("terms") > 0)
    stats = index.where("term IS NULL").agg(F.coalesce(F.sum("postings"), F.lit(0)).alias("docs"), F.coalesce(F.sum("terms"), F.lit(0)).alias("terms"),
                                            F.count(F.lit(1)).alias("shards")).first()
    scale = Scale(stats["docs"], stats["terms"])
    n_passes = (asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // PASS_TERMS + 1
    found = []
    for k in range(n_passes):
        own = asked.where(F.pmod(F.xxhash64("item_id", "_text"), F.lit(n_passes)) == k).select("item_id", "terms")
        rows = own.collect()
        terms = F.broadcast(own.select(F.explode("terms").alias("term")).distinct().withColumn("asked", F.lit(True)))
        wanted = index.join(terms, "term", "left").where("asked OR term IS NULL").drop("asked")
        held = wanted.where("term IS NOT NULL").groupBy("term").agg(F.sum("postings").alias("df")).collect()
        weights = {r["term"]: scale.weight(r["df"]) for r in held}
        queries = [[t for t in r["terms"] if t in weights] for r in rows]
        best = wanted.repartition(max(1, stats["shards"]), "shard").groupBy("shard").applyInArrow(
            _search_shard(queries, weights, scale, top), "query int, doc_id long, score long")
        place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
        best = best.withColumn("rank", place).where(F.col("rank") <= top)
        numbers = spark.createDataFrame([(q, r["item_id"]) for q, r in enumerate(rows)], f"query int, item_id {own.schema['item_id'].dataType.simpleString()}")
        found.append(best.join(F.broadcast(numbers), "query").select("item_id", "rank", "doc_id", "score"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def query(spark, sf_dir: str) -> DataFrame:
    """op13: the 50 best documents of every benchmark item."""
    return search(saved(build(table(spark, sf_dir, "documents")), "index"), table(spark, sf_dir, "benchmark"))


_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

ORACLE = f"""
WITH words AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
held AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
sized AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM held GROUP BY doc_id),
totals AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM sized),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*)::BIGINT AS df FROM held WHERE term IN (SELECT term FROM asked) GROUP BY term), totals
),
norms AS (SELECT doc_id, 100 - 50 + (50 * n * n_docs) // n_terms AS m FROM sized, totals),
scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN held USING (term) JOIN norms USING (doc_id)
  GROUP BY item_id, doc_id
)
SELECT item_id, rank, doc_id, score
FROM (SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score FROM scored WHERE score > 0)
WHERE rank <= 50
"""
