"""Substring deduplication by content-defined chunks.

A gear rolling hash (a sum of one random number per byte, shifted by the
byte's distance) is taken over every text; a chunk ends where its low bits
are zero.  Chunk ends depend on the bytes right before them only, so a
passage is cut alike wherever it occurs, whatever was inserted before it.
Chunks are deduplicated by a 128-bit digest; neighbouring repeated chunks
form a span.  A span is then extended to either side as far as the text goes
on like the one it repeats, and those of at least MIN_WORDS words are reported.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qualis.llm.common import blocks, checkpointed, id_and_text, table

#: A chunk ends with probability 1/32 a byte; chunks have 8 to 256 bytes.
MASK_BITS, LEAST, MOST = 5, 8, 256
#: Bytes that the hash depends on: its low MASK_BITS + shift see the last WINDOW bytes.
WINDOW = 16
#: Repeated spans of fewer words are left alone.
MIN_WORDS = 15
#: Bytes beside a span that are compared first; spans that agree on all of them go on with so many times more.
REACH, MORE = 64, 8
#: Tables of a row a document are broadcast up to so many bytes, counted over their rows and arrays, else shuffled.
BROADCAST_BYTES = 96_000_000
ROW_BYTES, ELEMENT_BYTES = 64, 32

_GEAR = np.random.Generator(np.random.PCG64(2024)).integers(0, 2**32, 256, dtype=np.uint32)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """At every byte, the gear hash of the WINDOW bytes that end there (fewer at the start).

    hash[i] = sum of gear[byte[i - k]] << k for k < WINDOW, by doubling: the
    sum over 2n bytes is that over n bytes plus the one n bytes earlier,
    shifted by n.
    """
    h, n = _GEAR[data], 1
    while n < WINDOW:
        h[n:] = h[n:] + (h[:-n] << np.uint32(n))
        n *= 2
    return h


def chunk_ends(data: bytes) -> list[int]:
    """Ends of the chunks of one text; a chunk has LEAST to MOST bytes, the last one at least one."""
    n = len(data)
    if not n:
        return []
    # the bits above WINDOW see all bytes of the window
    hashes = gear_hashes(np.frombuffer(data, np.uint8))
    marks = np.flatnonzero((hashes >> np.uint32(WINDOW)) & np.uint32((1 << MASK_BITS) - 1) == 0) + 1
    ends, last = [], 0
    for mark in marks.tolist():
        while mark - last > MOST:
            last += MOST
            ends.append(last)
        if mark - last >= LEAST:
            ends.append(mark)
            last = mark
    while n - last > MOST:
        last += MOST
        ends.append(last)
    if last < n:
        ends.append(n)
    return ends


def _emit_chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, text) to (d1, d2, row, at): the digest of every chunk; at = 1024 * its first byte + its size."""
    for block in blocks(batches, max_chars=2_000_000):
        rows, places, digests = [], [np.zeros(0, np.int64)], []
        for row, text in zip(block["row"], block["text"]):
            data = text.encode("utf-8", "surrogatepass")
            ends = chunk_ends(data)
            begins = [0, *ends[:-1]]
            rows += [row] * len(ends)
            places.append(np.array(ends, np.int64) + np.array(begins[:len(ends)], np.int64) * 1023)
            digests += [xxhash.xxh3_128_digest(data[b:e]) for b, e in zip(begins, ends)]
        halves = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(rows, pa.int64()), pa.array(np.concatenate(places))],
                                         names=["d1", "d2", "row", "at"])


def _known(df: DataFrame, array: str | None = None) -> DataFrame:
    """A checkpointed table, marked for broadcast if its rows and the elements of its ``array`` are few bytes."""
    elements = F.lit(0) if array is None else F.coalesce(F.sum(F.size(array)), F.lit(0))
    rows, inside = df.agg(F.count(F.lit(1)), elements).first()
    return F.broadcast(df) if rows * ROW_BYTES + inside * ELEMENT_BYTES <= BROADCAST_BYTES else df


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Spans of text that repeat an earlier place: doc_id, row, start, end (characters), n_words, of_doc_id.

    Places are ordered by id (null first), then the hash of the row, then
    within the text, so a passage that a document repeats itself is reported
    at all its places but the first.  A chunk repeats if an earlier place has
    it too; of_doc_id is the smallest id of the earliest places of the span's
    chunks.  Neighbouring repeated chunks make a span.  Its first chunk is
    extended to the left, its last one to the right, as far as the text agrees
    with that around the chunk's earliest place; spans that then touch are
    one.  Spans of fewer than ``min_words`` words are left out.  A passage
    that has no whole chunk in common with an earlier place is not found.

    Null and empty texts have no chunks.  Rows that agree in id and text are
    one document.  An empty table gives no rows.
    """
    rows = id_and_text(docs, id_col, text_col).withColumn("row", F.xxhash64("doc_id", "text"))
    chunks = rows.select("row", "text").mapInArrow(_emit_chunks, "d1 long, d2 long, row long, at long")
    # chunks that occur once go first; half of the digest does for that
    shared = checkpointed(chunks.groupBy("d1").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("d1"))
    ids = checkpointed(rows.select("row", "doc_id").distinct())
    # as many digests as text grows them: a sort-merge join at every size, whose skewed partitions AQE splits
    found = checkpointed(chunks.join(shared.hint("merge"), "d1", "left_semi").join(_known(ids), "row"))
    # a table of its own, so that AQE can split the rows of a very common chunk in the join
    place = F.struct("doc_id", "row", "at")
    firsts = checkpointed(found.groupBy("d1", "d2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last").drop("last"))
    repeats = found.join(firsts, ["d1", "d2"]).where(place > F.col("first"))
    begin, size = F.shiftright("at", 10), F.col("at") % 1024
    before = Window.partitionBy("row").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    spans = checkpointed(
        repeats.select("row", begin.alias("begin"), size.alias("size"), F.col("first.doc_id").alias("of"), F.col("first.row").alias("src"),
                       F.shiftright("first.at", 10).alias("src_begin")).distinct()
        # the bytes between repeated chunks so far: the same for neighbours
        .withColumn("run", F.col("begin") - F.coalesce(F.sum("size").over(before), F.lit(0)))
        .groupBy("row", "run").agg(F.min("begin").alias("begin"), F.max(F.col("begin") + F.col("size")).alias("end"), F.min(F.struct("of")).alias("of"),
                                   F.min_by(F.struct("src", F.col("src_begin").alias("place")), "begin").alias("left"),
                                   F.max_by(F.struct("src", (F.col("src_begin") + F.col("size")).alias("place")), "begin").alias("right")))
    sides = F.explode(F.array(F.struct(F.lit(-1).cast("long").alias("side"), F.col("begin").alias("place"), F.col("left").alias("from")),
                              F.struct(F.lit(1).cast("long").alias("side"), F.col("end").alias("place"), F.col("right").alias("from"))))
    ends = spans.select("row", "run", "of.of", sides.alias("s")).select("row", "run", "of", "s.side", "s.place", F.col("s.from.src").alias("src"), F.col("s.from.place").alias("src_place"))
    grown = (
        _grown(rows, ends).groupBy("row", "run").agg(F.min("place").alias("from"), F.max("place").alias("to"), F.min(F.struct("of")).alias("of"))
        .select("row", "from", "to", F.col("of.of").alias("of_doc_id"))
        .groupBy("row").agg(F.collect_list(F.struct("from", "to", "of_doc_id")).alias("spans")))
    # back to the text, to give places in characters and to count words
    texts = rows.join(_known(checkpointed(grown), "spans"), "row").select("doc_id", "row", "text", "spans")
    placed = texts.mapInArrow(_place_spans, "doc_id long, row long, start long, end long, n_words long, of_doc_id long")
    return placed.where(F.col("n_words") >= min_words).distinct()


_ENDS = ("row", "run", "of", "side", "place", "src", "src_place")


def _grown(rows: DataFrame, ends: DataFrame) -> DataFrame:
    """Ends of spans (side -1: begin, 1: end), moved outwards as far as the bytes there agree with those at src_place of row src.

    Only the bytes beside the ends meet, never whole texts; ends that agree on all of them go on from there.
    """
    done, reach = [], REACH
    while True:
        asked = ends.select("row", "side", "place").union(ends.select("src", "side", "src_place")).distinct()
        asked = asked.groupBy("row").agg(F.collect_list(F.struct("side", "place")).alias("places"))
        texts = rows.select("row", "text").join(_known(checkpointed(asked), "places"), "row")
        # rows that agree in id and text answer alike
        beside = checkpointed(texts.mapInArrow(_emit_beside(reach), "row long, side long, place long, beside binary").dropDuplicates(["row", "side", "place"]))
        other = beside.select(F.col("row").alias("src"), "side", F.col("place").alias("src_place"), F.col("beside").alias("other"))
        met = ends.join(beside, ["row", "side", "place"]).join(other, ["src", "side", "src_place"]).select(*_ENDS, "beside", "other")
        moved = checkpointed(met.mapInArrow(_move_ends(reach), ", ".join(f"{c} long" for c in _ENDS) + ", more boolean"))
        done.append(moved.where("not more").drop("more"))
        ends = moved.where("more").drop("more")
        if ends.isEmpty():
            break
        reach *= MORE
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def _emit_beside(reach: int):
    """(row, text, places) to (row, side, place, beside): up to ``reach`` bytes from each place on, outwards."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, max_chars=2_000_000):
            out = []
            for row, text, places in zip(block["row"], block["text"], block["places"]):
                data = text.encode("utf-8", "surrogatepass")
                for p in places:
                    side, place = p["side"], p["place"]
                    out.append((row, side, place, data[place:place + reach] if side > 0 else data[max(0, place - reach):place][::-1]))
            columns = zip(*out) if out else [()] * 4
            types = [pa.int64()] * 3 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["row", "side", "place", "beside"])

    return run


def _move_ends(reach: int):
    """Ends with the bytes beside either place to ends moved by what agrees; more: all of ``reach`` bytes did."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = np.array([len(commonprefix(pair)) for pair in zip(batch.column("beside").to_pylist(), batch.column("other").to_pylist())], np.int64)
            step = same * batch.column("side").to_numpy()
            columns = [pa.array(batch.column(c).to_numpy() + step) if c in ("place", "src_place") else batch.column(c) for c in _ENDS]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(same == reach)], names=[*_ENDS, "more"])

    return run


def _place_spans(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of a text's bytes to spans of whole characters, with the words that lie within; those that touch become one."""
    for block in blocks(batches, max_chars=2_000_000):
        out = []
        for doc_id, row, text, spans in zip(block["doc_id"], block["row"], block["text"], block["spans"]):
            data = text.encode("utf-8", "surrogatepass")
            joined: list[list] = []
            for begin, end, of in sorted(((s["from"], s["to"], s["of_doc_id"]) for s in spans), key=lambda s: s[:2]):
                if joined and begin <= joined[-1][1]:
                    last = joined[-1]
                    last[1], last[2] = max(last[1], end), None if last[2] is None or of is None else min(last[2], of)
                else:
                    joined.append([begin, end, of])
            byte = place = 0
            for begin, end, of in joined:
                while begin < end and data[begin] & 0xC0 == 0x80:
                    begin += 1
                while begin < end < len(data) and data[end] & 0xC0 == 0x80:
                    end -= 1
                inside = data[begin:end]
                start = place + len(data[byte:begin].decode("utf-8", "surrogatepass"))
                byte, place = end, start + len(inside.decode("utf-8", "surrogatepass"))
                out.append((doc_id, row, start, place, len(inside.split()), of))
        columns = zip(*out) if out else [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "row", "start", "end", "n_words", "of_doc_id"])


def query(spark, sf_dir: str) -> DataFrame:
    """op10: repeated spans of all documents."""
    return repeated_spans(table(spark, sf_dir, "documents")).select("doc_id", "start", "end", "n_words", "of_doc_id")
