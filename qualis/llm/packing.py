"""Vector bin packing of documents or instruction examples into training sequences.

Every sequence obeys three limits at once: tokens, segments (pieces) and
loss-bearing tokens.  Each task tokenizes and packs the rows it scans, so
nothing is shuffled and a task holds only a window of pieces and a fixed
number of open sequences:

* a text is cut into full-length pieces as long as it fills sequences alone;
* the rest goes, largest first, to the open sequence whose remaining room
  has the greatest dot product with the piece's demand (all three taken as
  shares of their limits);
* a piece that fits nowhere is cut to fill the tightest open sequence;
* what is still open at the end of a task is merged, and the one sequence
  left over is cut at powers of two, which need no padding.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualis.llm.common import blocks, table, text_of
from qualis.llm.tokens import tokenizer

END_ID = 1
SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, loss_tokens long, "
          "sequence_id long, offset long, segment int")


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 128
    loss: int = 2048


@dataclass(frozen=True)
class Piece:
    """Tokens start..end of one text; its first ``prompt`` tokens bear no loss."""

    doc_id: int | None
    ids: bytes
    prompt: int
    start: int
    end: int

    @property
    def length(self) -> int:
        return self.end - self.start

    @property
    def loss(self) -> int:
        return max(0, self.end - max(self.start, self.prompt))

    def cut(self, tokens: int, loss: int) -> tuple[Piece | None, Piece | None]:
        """The longest head with at most so many tokens and loss-bearing tokens, and the tail."""
        at = min(self.end, self.start + tokens, max(self.start, self.prompt) + loss)
        head = Piece(self.doc_id, self.ids, self.prompt, self.start, at) if at > self.start else None
        tail = Piece(self.doc_id, self.ids, self.prompt, at, self.end) if at < self.end else None
        return head, tail


@dataclass
class Sequence:
    limits: Limits
    pieces: list[Piece] = field(default_factory=list)
    tokens: int = 0
    loss: int = 0

    def add(self, piece: Piece) -> None:
        self.pieces.append(piece)
        self.tokens += piece.length
        self.loss += piece.loss

    def room(self) -> tuple[int, int, int]:
        return self.limits.tokens - self.tokens, self.limits.segments - len(self.pieces), self.limits.loss - self.loss

    @property
    def closed(self) -> bool:
        return min(self.room()) <= 0


class Packer:
    """Packs pieces one window at a time; ``emit`` receives each closed sequence."""

    def __init__(self, limits: Limits, emit: Callable[[list[Piece]], None], open_sequences: int = 64, window: int = 2048):
        self.limits, self.emit, self.window = limits, emit, window
        self.caps = np.array([limits.tokens, limits.segments, limits.loss], float)
        self.open = [Sequence(limits) for _ in range(open_sequences)]
        self.rooms = np.tile(self.caps, (open_sequences, 1))
        self.waiting: list[Piece] = []

    def add(self, piece: Piece | None) -> None:
        while piece is not None:
            head, tail = piece.cut(self.limits.tokens, self.limits.loss)
            if head.length < self.limits.tokens:  # does not fill a sequence alone
                self.waiting.append(head)
            else:
                self.emit([head])
            piece = tail
        if len(self.waiting) >= self.window:
            self.place_waiting()

    def place_waiting(self) -> None:
        for piece in sorted(self.waiting, key=lambda p: -p.length):
            while piece is not None:
                piece = self._place(piece)
        self.waiting = []

    def _place(self, piece: Piece) -> Piece | None:
        """Place the piece, or its head where it fits nowhere whole; returns what is left of it."""
        need = np.array([piece.length, 1, piece.loss], float)
        fits = (self.rooms >= need).all(axis=1)
        if fits.any():
            share = need / self.caps
            at = int(np.where(fits, (self.rooms / self.caps) @ share, -1.0).argmax())
            head, tail = piece, None
        else:
            at = int(self.rooms[:, 0].argmin())
            head, tail = piece.cut(int(self.rooms[at, 0]), int(self.rooms[at, 2]))
        if head is not None:
            self.open[at].add(head)
            self.rooms[at] = self.open[at].room()
        if head is None or self.open[at].closed:
            self.emit(self.open[at].pieces)
            self.open[at], self.rooms[at] = Sequence(self.limits), self.caps
        return tail

    def finish(self) -> None:
        self.place_waiting()
        last = Sequence(self.limits)
        for sequence in sorted(self.open, key=lambda s: -s.tokens):
            for piece in sequence.pieces:
                while piece is not None:
                    head, piece = piece.cut(last.room()[0], last.room()[2])
                    if head is not None:
                        last.add(head)
                    if head is None or last.closed:
                        self.emit(last.pieces)
                        last = Sequence(self.limits)
        rest = list(last.pieces)
        while rest:
            room, taken = 1 << (sum(p.length for p in rest).bit_length() - 1), []
            while room and rest:
                head, tail = rest.pop(0).cut(room, self.limits.loss)
                taken.append(head)
                room -= head.length
                if tail is not None:
                    rest.insert(0, tail)
            self.emit(taken)


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         prompt_col: str | None = None, limits: Limits = Limits()) -> DataFrame:
    """Pieces of all rows of ``docs`` and their places in packed sequences.

    A row's tokens are those of its prompt (if ``prompt_col`` is given; they
    bear no loss), of its text, and id 1.  Returns per piece: doc_id, start
    (tokens of its row before it), length, ids (little-endian unsigned 32-bit,
    packed), doc_tokens, loss_tokens, sequence_id, offset and segment (its
    place and rank in the sequence).

    Null or empty texts are one piece of id 1; a null id stays null; repeated
    rows are packed each; an empty table gives no rows.  Sequence ids hold the
    partition number, so a rerun task gives the same ones as long as its input
    rows come in the same order (a table scan's do).
    """
    prompt = text_of(docs, prompt_col) if prompt_col else F.lit("")
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), prompt.alias("prompt"), text_of(docs, text_col).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = tokenizer(tokenizer_path), np.array([END_ID], "<u4").tobytes()
        out: list[tuple] = []
        next_id = TaskContext.get().partitionId() << 33

        def emit(pieces: list[Piece]) -> None:
            nonlocal next_id
            offset = 0
            for k, p in enumerate(pieces):
                out.append((p.doc_id, p.start, p.length, p.ids[4 * p.start:4 * p.end], len(p.ids) // 4, p.loss, next_id, offset, k))
                offset += p.length
            next_id += 1

        packer = Packer(limits, emit)
        for block in blocks(batches):
            for doc_id, prompt_text, text in zip(block["doc_id"], block["prompt"], block["text"]):
                head = words.packed(prompt_text) if prompt_text else b""
                ids = head + words.packed(text) + end
                packer.add(Piece(doc_id, ids, len(head) // 4, 0, len(ids) // 4))
            yield from _rows(out)
        packer.finish()
        yield from _rows(out)

    return rows.mapInArrow(run, SCHEMA)


_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()),
                    ("loss_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("segment", pa.int32())])


def _rows(out: list[tuple]) -> Iterator[pa.RecordBatch]:
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), _ARROW.types)], schema=_ARROW)
        out.clear()


def query(spark, sf_dir: str) -> DataFrame:
    """op1: all documents in sequences of 2048 tokens, ids as their CRC-32."""
    import public_tokenizers

    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
                         "segment", "loss_tokens")
