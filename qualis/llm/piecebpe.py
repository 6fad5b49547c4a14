"""Exact merge-type encoding and decoding with SentencePiece BPE models.

A merge-type model joins, again and again, the adjacent pair whose joined
piece scores highest (the leftmost of equals).  Its result on a text is the
one sequence of pieces in which every two neighbours, merged anew by
themselves, come out as those two.  So a text is encoded by backtracking:

* one Aho-Corasick pass finds the longest piece that starts at each place;
* from left to right the longest piece is tried, then its shorter prefixes;
  a piece fits if it and its neighbour on the left stand that check, which
  replays their own merges and looks for one across (remembered by pair);
* a place from which no piece fits is marked in a bitfield and never tried
  again: the pieces before a place are the same on every way to it;
* what fits nowhere takes back the piece before it.

Where no piece holds a space after another character, texts fall apart
before spaces, and the units between them are encoded once each and
remembered.  Characters without a piece become their bytes.
"""

from __future__ import annotations

import codecs
import re
import string
import struct
from array import array
from collections.abc import Callable, Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualis.llm.common import blocks, id_and_text, table

SPACE = "▁"
#: Units and pairs that a worker remembers in each of two generations (bounds memory, not results).
CACHE_UNITS = 400_000
CACHE_PAIRS = 200_000
#: Longer units are encoded each time they occur.
CACHED_CHARS = 64
#: The score of a pair that is no piece.
NEVER = float("-inf")


def _one_byte(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("qualis_one_byte", _one_byte)  # a byte that starts no character becomes U+FFFD by itself


class Remembered(dict):
    """key -> make(key); of the keys that were not asked for lately the least recent go (two generations of at most ``bound`` each)."""

    def __init__(self, make: Callable, bound: int):
        super().__init__()
        self._make, self._bound, self._older = make, bound, {}

    def __missing__(self, key):
        value = self._older.get(key)
        if value is None:
            value = self._make(key)
        if len(self) >= self._bound:
            self._older = dict(self)
            self.clear()
        self[key] = value
        return value


class PieceModel:
    """Encodes whole texts to packed little-endian unsigned 32-bit ids, and decodes them."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        if model.normalize(" Ａ  b ") != f"{SPACE}{SPACE}Ａ{SPACE}{SPACE}b{SPACE}":
            raise ValueError(f"{path}: only models that keep texts as they are and put one space before them")
        size = model.get_piece_size()
        special = {i for i in range(size) if model.is_control(i) or model.is_unknown(i)}
        byte_ids = [i for i in range(size) if model.is_byte(i)]
        if len(byte_ids) != 256:
            raise ValueError(f"{path}: only models with byte fallback")
        self.begin, self.end = model.bos_id(), model.eos_id()
        self.ids = {model.id_to_piece(i): i for i in range(size) if i not in special and not model.is_byte(i)}
        self.scores = {p: model.get_score(i) for p, i in self.ids.items()}
        self.byte_ids = sorted(byte_ids, key=model.id_to_piece)
        #: id -> bytes of its text; control ids have none.
        self.surface = [b""] * size
        for piece, i in self.ids.items():
            self.surface[i] = piece.replace(SPACE, " ").encode()
        for byte, i in enumerate(self.byte_ids):
            self.surface[i] = bytes([byte])
        for i in range(size):
            if model.is_unknown(i):
                self.surface[i] = " ⁇ ".encode()
        self._spaced = {i for p, i in self.ids.items() if p.startswith(SPACE)}
        self._silent = np.array([not s for s in self.surface])
        self._matches = ahocorasick.Automaton()
        # a node's characters are searched in the order they came in: the space, letters, then by code point
        for piece in sorted(self.ids, key=lambda p: (not p.startswith(SPACE), not "a" <= p[0] <= "z", p)):
            self._matches.add_word(piece, len(piece))
        self._matches.make_automaton()
        self._edges: dict[str, tuple[list, list] | None] = {}
        self._shorter = Remembered(self._next_shorter, CACHE_PAIRS)
        self._fitting = Remembered(self._next_fitting, CACHE_PAIRS)
        self._alphabet = {c for p in self.ids for c in p}
        self._between = next(c for c in map(chr, range(1, 0x110000)) if c not in self._alphabet)
        self._units = self._unit_pattern()
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def _unit_pattern(self) -> re.Pattern:
        """Units, over whose ends no piece reaches: before a space, before a mark after a letter or digit, around a line break."""
        inside = {(a, b) for p in self.ids for a, b in zip(p, p[1:])}
        if any(b == SPACE != a for a, b in inside):
            return re.compile("(?s).+")
        alphabet = self._alphabet
        alone = re.escape("".join(c for c in "\t\n\r" if c not in alphabet))
        apart = re.escape("".join(c for c in string.punctuation if not any(b == c and a.isalnum() for a, b in inside)))
        if not apart:
            return re.compile(f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" + (f"|[{alone}]" if alone else ""))
        # a unit begins with any character; a mark that no piece has after a letter or digit goes on only after something else
        body = f"[^{SPACE}{alone}](?:[^{SPACE}{alone}{apart}]+|(?<![^\\W_])[{apart}])*"
        return re.compile(f"{SPACE}*{body}|{SPACE}+" + (f"|[{alone}]" if alone else ""))

    def merged(self, text: str) -> tuple[list[str], list, list]:
        """A short text's pieces by merging pair after pair; what stood at its left and at its right end, each until which score.

        Of two texts side by side, either's merges go on in their own order
        as long as none reaches over.  So a merge is due, seen from the other
        text, when the lowest score up to it is (NEVER: never).
        """
        parts, score = list(text), self.scores.get
        joins = [score(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        left, right, due = [], [], float("inf")
        while joins and (best := max(joins)) > NEVER:
            k, due = joins.index(best), min(due, best)
            if k == 0:
                left.append((parts[0], due))
            if k == len(joins) - 1:
                right.append((parts[-1], due))
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
            del joins[k]
            if k:
                joins[k - 1] = score(parts[k - 1] + parts[k], NEVER)
            if k < len(joins):
                joins[k] = score(parts[k] + parts[k + 1], NEVER)
        return parts, [*left, (parts[0], NEVER)], [*right, (parts[-1], NEVER)]

    def _ends(self, piece: str) -> tuple[list, list] | None:
        """What stands at the ends of a piece while it is merged; None if merging its text does not give it."""
        if piece not in self._edges:
            if len(self._edges) >= CACHE_PAIRS:  # characters of no piece
                self._edges.clear()
            parts, left, right = self.merged(piece)
            self._edges[piece] = (left, right) if parts == [piece] else None
        return self._edges[piece]

    def adjacent(self, left: str, right: str) -> bool:
        """Whether ``right`` can follow ``left`` (empty: begin a unit): merged anew, side by side, nothing joins across."""
        ends = self._ends(right)
        if ends is None or not left:
            return ends is not None
        before, after = self._ends(left)[1], ends[0]
        score, i, j = self.scores.get, 0, 0
        while True:
            x, x_until = before[i]
            y, y_until = after[j]
            join = score(x + y, NEVER)
            if join > x_until and join >= y_until and join > NEVER:  # the leftmost of equals goes first
                return False
            if x_until == y_until == NEVER:
                return True
            if x_until >= y_until:
                i += 1
            else:
                j += 1

    def _next_shorter(self, piece: str) -> str:
        """The longest piece that is a proper prefix of ``piece``; its first character may be none, and '' ends the row."""
        return next((piece[:n] for n in range(len(piece) - 1, 1, -1) if piece[:n] in self.scores), piece[:1] if len(piece) > 1 else "")

    def _next_fitting(self, pair: tuple[str, str]) -> str:
        """Of a piece and its shorter prefixes the longest that can follow the piece before ('' if none can)."""
        before, piece = pair
        while piece and not self.adjacent(before, piece):
            piece = self._shorter[piece]
        return piece

    def _longest(self, units: list[str]) -> array:
        """At each place of the units, each followed by a character of no piece: the length of the longest piece that starts there."""
        text = self._between.join(units)
        longest = array("i", [1]) * (len(text) + 1)
        for end, size in self._matches.iter(text):
            longest[end - size + 1] = size  # ends ascend, so the longest comes last
        return longest

    def pieces(self, unit: str, longest: array | None = None, base: int = 0) -> list[str]:
        """The merge-type encoding of ``unit``, whose longest pieces stand from ``base`` on, by backtracking."""
        n = len(unit)
        if longest is None:
            longest = self._longest([unit])
        failed: bytearray | None = None
        fitting, shorter = self._fitting, self._shorter
        out: list[str] = []
        at, before, piece = 0, "", unit[:longest[base]]
        while True:
            piece = fitting[before, piece]
            if piece:
                end = at + len(piece)
                if failed and failed[end >> 3] >> (end & 7) & 1:
                    piece = shorter[piece]
                    continue
                out.append(piece)
                if end == n:
                    return out
                at, before, piece = end, piece, unit[end:end + longest[base + end]]
            else:
                failed = failed or bytearray(n // 8 + 1)
                failed[at >> 3] |= 1 << (at & 7)
                last = out.pop()
                at -= len(last)
                before = out[-1] if out else ""
                piece = shorter[last]

    def _encoded(self, units: list[str]) -> Iterator[bytes]:
        longest, base, ids_of = self._longest(units), 0, self.ids.get
        for unit in units:
            ids: list[int] = []
            for piece in self.pieces(unit, longest, base):
                i = ids_of(piece)
                if i is None:  # a character of no piece
                    ids += [self.byte_ids[b] for b in piece.encode()]
                else:
                    ids.append(i)
            yield struct.pack(f"<{len(ids)}I", *ids)
            base += len(unit) + 1

    def packed(self, text: str) -> bytes:
        """Packed ids of a text, without begin and end ids."""
        units = self._units.findall(SPACE + text.replace(" ", SPACE)) if text else []
        known = self._known
        new = [u for u in set(units) if u not in known]
        if len(known) + len(new) > CACHE_UNITS:
            self._older, self._known = known, {}
            known, new = self._known, list(set(units))
        if new:
            older = self._older
            known.update((u, older[u]) for u in new if u in older)
            fresh = [u for u in new if u not in older]
            known.update(zip(fresh, self._encoded(fresh)))
        ids = b"".join(map(known.__getitem__, units))
        for unit in new:
            if len(unit) > CACHED_CHARS:
                del known[unit]
        return ids

    def decoded(self, packed: bytes) -> str:
        """The text of packed ids: control ids give nothing, one space before the first piece goes."""
        ids = np.frombuffer(packed, "<u4")
        loud = np.flatnonzero(~self._silent[ids])
        if not len(loud):
            return ""
        if len(loud) == loud[-1] - loud[0] + 1:
            runs = [ids[loud[0]:loud[-1] + 1].tolist()]
        else:  # bytes on both sides of a control id are no character
            runs = [r.tolist() for r in np.split(ids[loud], np.flatnonzero(np.diff(loud) > 1) + 1)]
        texts = [b"".join(map(self.surface.__getitem__, r)) for r in runs]
        if runs[0][0] in self._spaced:
            texts[0] = texts[0][1:]
        return "".join(t.decode("utf-8", "qualis_one_byte") for t in texts)


_LOADED: dict[str, PieceModel] = {}


def piece_model(path: str) -> PieceModel:
    """One model per worker process and file."""
    if path not in _LOADED:
        _LOADED[path] = PieceModel(path)
    return _LOADED[path]


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", bos: bool = True, eos: bool = True, back: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id and ids (little-endian unsigned 32-bit, packed), exactly the library's.

    With ``back`` also text, what the ids are decoded to: as ``decode`` gives
    it, in the same task.
    A null or empty text has the begin and end ids only; a null id stays
    null; repeated rows are encoded each; an empty table gives no rows; other
    columns are not read.  Texts are encoded whole, whatever their length.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        head = np.array([model.begin] if bos else [], "<u4").tobytes()
        tail = np.array([model.end] if eos else [], "<u4").tobytes()
        for block in blocks(batches):
            ids = [head + model.packed(t) + tail for t in block["text"]]
            columns = {"doc_id": pa.array(block["doc_id"], pa.int64()), "ids": pa.array(ids, pa.binary())}
            if back:
                columns["text"] = pa.array([model.decoded(i) for i in ids], pa.string())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids binary" + (", text string" if back else ""))


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with the column text, exactly the library's decode(ids); null ids give an empty text."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        for block in blocks(batches, "ids", 8_000_000):
            texts = [model.decoded(i) for i in block["ids"]]
            yield pa.RecordBatch.from_arrays([pa.array(block["doc_id"], pa.int64()), pa.array(block["ids"], pa.binary()), pa.array(texts, pa.string())],
                                             ["doc_id", "ids", "text"])

    known = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("ids", F.lit(b"")).alias("ids"))
    return known.mapInArrow(run, "doc_id long, ids binary, text string")


def query(spark, sf_dir: str) -> DataFrame:
    """op12: every document encoded with begin and end ids, and decoded again, as digests."""
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    found = encode(table(spark, sf_dir, "documents"), path, back=True)
    return found.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
