"""Line deduplication by a deletion-neighbourhood join.

Two lines are within one edit (insertion, deletion or substitution of a
character) exactly if they have a variant in common, a variant being the
line itself or the line without one character.  Variants are emitted as
hashed keys and equal keys are joined:

* substitution: both lines leave the same variant by deleting at the same
  place, so the key is (variant, place).  All lines under one such key are
  within one edit of each other, so each is joined to the earliest only;
* insertion or deletion: one line is itself a variant of the other, so under
  the hash of a line meet that line and the earliest one that has it as a
  variant.

No key needs all pairs of its lines, and a key that very many lines share is
one aggregate.  Every link is verified by edit distance.

A line of n characters has n variants by deletion.  To emit them only where
it can matter, lines first emit coarse variants, with a whole quarter
deleted instead of one character: lines within one edit agree on one of
those, so a line that agrees with no other has no partner.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualis.llm.common import WORD, blocks, checkpointed, id_and_text, table, text_of

#: Parts of a line, one of which a coarse variant leaves out.
PARTS = 4
#: Shorter lines are compared exactly only: one edit changes too much of them.
MIN_CHARS = 20
BASE = 0x9E3779B97F4A7C15
#: Tables of keys that different lines share (8 bytes a row) are broadcast up to so many rows, else shuffled.
BROADCAST_KEYS = 2_000_000


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers."""
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0, 1, ... n modulo 2**64; the longest table so far is kept per process."""
    if len(_POWERS.get(base, ())) <= n:
        steps = np.full(max(n, 1 << 16) + 1, base, np.uint64)
        steps[0] = 1
        _POWERS[base] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[base][:n + 1]


class SliceHashes:
    """Hashes of any slice of any of a list of lines: polynomials modulo 2**64 from prefix sums."""

    def __init__(self, lines: list[str]):
        codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        codes += np.uint64(1)
        self.length = np.array([len(x) for x in lines], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.up = _powers(BASE, len(codes) + 1)
        codes *= _powers(pow(BASE, -1, 1 << 64), len(codes))[:-1]
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes, dtype=np.uint64)])

    def of(self, start: np.ndarray, end: np.ndarray, origin: np.ndarray) -> np.ndarray:
        """Hash of characters start..end (places in the joined lines), the one at ``origin`` having power 0."""
        return (self.sums[end] - self.sums[start]) * self.up[origin]


def coarse_variants(lines: list[str]) -> np.ndarray:
    """A row of 2 * PARTS keys per line: its hashes without each part, as the shorter and as the longer of a pair.

    For two lines within one edit the parts are those of the shorter length
    s, taken from the start for the head and from the end for the tail; the
    edit lies in one part and the rest agrees.
    """
    h = SliceHashes(lines)
    first, n = h.start[:, None], h.length[:, None]
    out = []
    for s in (n, n - 1):
        cuts = np.arange(PARTS + 1)[None, :] * s // PARTS
        head_end, tail_start = first + cuts[:, :-1], first + n - (s - cuts[:, 1:])
        head = h.of(np.broadcast_to(first, head_end.shape), head_end, first)
        tail = h.of(tail_start, np.broadcast_to(first + n, tail_start.shape), tail_start)
        tag = _mixed(s.astype(np.uint64) * np.uint64(PARTS) + np.arange(PARTS, dtype=np.uint64))
        out.append(_mixed(_mixed(head ^ tag) + tail))
    return np.concatenate(out, axis=1)


def variants(line: str) -> np.ndarray:
    """The hash of the line, then of the line without character 0, 1, ..."""
    h = SliceHashes([line])
    at, zero = np.arange(h.length[0]), np.zeros(1, np.int64)
    whole = h.of(zero, h.length, zero)
    without = h.of(np.zeros_like(at), at, np.zeros_like(at)) + h.of(at + 1, np.full_like(at, h.length[0]), np.ones_like(at))
    return _mixed(_mixed(np.concatenate([h.length, np.full_like(at, h.length[0] - 1)]).astype(np.uint64)) ^ np.concatenate([whole, without]))


def _emit_coarse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to (key, h1), each distinct line of a block once."""
    for block in blocks(batches, max_chars=1_000_000):
        lines = list({line for text in block["text"] for line in text.split("\n") if len(line) >= MIN_CHARS})
        if lines:
            hashes = np.array([xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass"), 42) for x in lines], np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(coarse_variants(lines).ravel().view(np.int64)), pa.array(np.repeat(hashes, 2 * PARTS).view(np.int64))],
                                             names=["key", "h1"])


def _emit_variants(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h1, line) to (variant, cut, h1); cut is the character left out, -1 for the line itself."""
    for batch in batches:
        for h1, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            keys = variants(line)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(np.arange(-1, len(keys) - 1, dtype=np.int32)), pa.array(np.full(len(keys), h1))],
                                             names=["variant", "cut", "h1"])


def lines_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", by_text: bool = False) -> DataFrame:
    """Every line with a word in it: h1, h2 (together its 128-bit digest), at (its place), line.

    ``by_text``: places also hold the hash of the text (row), after the id.
    """
    lines = id_and_text(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("row"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    at = F.struct("doc_id", "row", "line_no") if by_text else F.struct("doc_id", "line_no")
    return (lines.where(F.btrim("line", F.lit(" \t\x0b\x0c\r")) != "")
            .select(F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"), at.alias("at"), "line"))


def _only(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in the checkpointed table of keys: broadcast if it is small, else a shuffled join."""
    return rows.join(F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys, key, "left_semi")


def _shared(rows: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs with different lines."""
    different = rows.groupBy(key).agg(F.min("h1").alias("low"), F.max("h1").alias("high")).where("low < high").select(key)
    return _only(rows, checkpointed(different), key)


def near_links(docs: DataFrame, occurrences: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """h1, h2, near: for each distinct line the place of the earliest earlier line that is one edit away.

    ``occurrences`` has h1, h2 and place of every line.
    """
    texts = id_and_text(docs, id_col, text_col).select("text")
    keys = texts.mapInArrow(_emit_coarse, "key long, h1 long")
    able = checkpointed(_shared(keys, "key").select("h1").distinct())
    lines = lines_of(docs, id_col, text_col).where(F.length("line") >= MIN_CHARS)
    partners = checkpointed(
        _only(lines.select("h1", "h2", "line"), able, "h1").groupBy("h1", "h2").agg(F.min("line").alias("line"))
        .join(_only(occurrences, able, "h1").groupBy("h1", "h2").agg(F.min("at").alias("first")), ["h1", "h2"]))

    found = _shared(partners.select("h1", "line").mapInArrow(_emit_variants, "variant long, cut int, h1 long"), "variant")
    found = checkpointed(found.join(partners.select("h1", "h2", "first"), "h1"))
    whole, rest = F.col("cut") == -1, F.col("cut") >= 0
    replaced = found.where(rest).groupBy("variant", "cut").agg(F.min("first").alias("near"))
    shorter = (found.groupBy("variant").agg(F.min(F.when(whole, F.col("first"))).alias("whole"), F.min(F.when(rest, F.col("first"))).alias("longer"))
               .where("whole is not null and longer is not null"))
    links = (
        found.where(rest).join(replaced, ["variant", "cut"]).select("h1", "h2", "first", "near")
        .unionByName(found.join(shorter, "variant").select("h1", "h2", "first", F.when(whole, F.col("longer")).otherwise(F.col("whole")).alias("near")))
        .where("near < first").groupBy("h1", "h2").agg(F.min("near").alias("near")))
    other = partners.select(F.col("first").alias("near"), F.col("line").alias("other"))
    return (links.join(partners.select("h1", "h2", "line"), ["h1", "h2"]).join(other, "near")
            .where(F.levenshtein("line", "other", 1) >= 0).select("h1", "h2", "near"))


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", by_text: bool = False) -> DataFrame:
    """Lines that go, one row each: at (their place), h1, of (the place of the line that they repeat), edits.

    Lines are what "\\n" separates; those without a word always stay.  Places
    are ordered by id (null first), then line number.  A line goes if an equal
    line occurs earlier (edits 0), or, from MIN_CHARS characters on, a line one
    edit away first occurs before the line itself first does (edits 1; then
    all its occurrences go).  ``of`` is the earliest such line; it may itself
    go, in favour of a line one edit from it.

    Null and empty texts have no lines.  Rows that share an id are one
    document listed several times: equal lines at the same place of them do
    not repeat each other.  With ``by_text`` that holds for rows that also share
    the text only; other texts of an id (or without one) are documents of their
    own, in the order of their hashes.  An empty table gives no rows.
    """
    lines = checkpointed(lines_of(docs, id_col, text_col, by_text).select("h1", "h2", "at"))
    distinct = lines.groupBy("h1", "h2").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    # a table of its own, so that AQE can split the rows of a very common line in the join
    repeats = checkpointed(distinct.join(near_links(docs, lines, id_col, text_col), ["h1", "h2"], "left").where("near is not null or first < last"))
    edits = F.when(F.col("near").isNull(), 0).otherwise(1)
    return (lines.join(repeats, ["h1", "h2"]).where("near is not null or first < at")
            .select("at", "h1", F.coalesce("near", "first").alias("of"), edits.alias("edits")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the text of each row reduced to the lines that stay (null stays null)."""
    # one document's lines are a group, not all lines of an id, which may be null or shared by very many rows
    gone = dropped_lines(docs, id_col, text_col, by_text=True)
    gone = gone.groupBy(F.col("at.doc_id").alias("_id"), F.col("at.row").alias("_row")).agg(F.collect_set(F.struct("at.line_no", "h1")).alias("_gone"))
    joined = docs.join(gone, docs[id_col].cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64(text_of(docs, text_col)) == F.col("_row")), "left")
    stays: Column = F.filter(F.split(text_col, "\n"), lambda line, i: ~F.array_contains(F.col("_gone"), F.struct(i.alias("line_no"), F.xxhash64(line).alias("h1"))))
    text = F.when(F.col("_gone").isNull(), F.col(text_col)).otherwise(F.array_join(stays, "\n"))
    return joined.withColumn(text_col, text).select(docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    """op4: the lines of all documents that repeat an earlier line."""
    gone = dropped_lines(table(spark, sf_dir, "documents"))
    return gone.select("at.doc_id", "at.line_no", F.col("of.doc_id").alias("of_doc_id"), F.col("of.line_no").alias("of_line_no"), "edits")


ORACLE = f"""
WITH l AS (
  SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, lines[i] AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i FROM documents)
  WHERE regexp_matches(lines[i], '{WORD}')),
d AS (SELECT line, length(line) AS n, min((doc_id, line_no)) AS first, count(*) AS occurrences FROM l GROUP BY line),
p AS (
  SELECT a.line, min(b.first) AS near FROM d a JOIN d b ON b.n BETWEEN a.n - 1 AND a.n + 1 AND b.first < a.first
  WHERE a.n >= {MIN_CHARS} AND b.n >= {MIN_CHARS}
    AND (left(a.line, CAST(least(a.n, b.n) // 2 AS INTEGER)) = left(b.line, CAST(least(a.n, b.n) // 2 AS INTEGER))
         OR right(a.line, CAST(least(a.n, b.n) - least(a.n, b.n) // 2 - 1 AS INTEGER)) = right(b.line, CAST(least(a.n, b.n) - least(a.n, b.n) // 2 - 1 AS INTEGER)))
    AND levenshtein(a.line, b.line) = 1
  GROUP BY a.line),
r AS (SELECT d.line, d.first, p.near FROM d LEFT JOIN p USING (line))
SELECT doc_id, line_no, coalesce(near, first)[1] AS of_doc_id, coalesce(near, first)[2] AS of_line_no, CAST(CASE WHEN near IS NULL THEN 0 ELSE 1 END AS INTEGER) AS edits
FROM l JOIN r USING (line) WHERE near IS NOT NULL OR (doc_id, line_no) > first
"""
