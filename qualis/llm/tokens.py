"""Token ids of texts, as packed little-endian unsigned 32-bit integers.

``WordTokenizer`` gives exactly what ``Tokenizer.encode(text,
add_special_tokens=False)`` gives for tokenizer files whose pre-tokenizer
splits words off and drops white space, but looks each distinct word up
only once: the pieces of a word do not depend on its neighbours.  Texts
with characters outside a plain Latin alphabet, where normalisation rules
could matter, and texts that may hold a special token go through the full
tokenizer.
"""

from __future__ import annotations

import os
import re

import numpy as np

#: The word pattern of the tokenizer file, written for lower-case plain Latin text.
LATIN_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\t-\r 0-9a-zß-öø-ÿ]+")
NOT_PLAIN = re.compile(r"[^\t-\r\x20-\x7eÀ-ÖØ-öø-ÿß–—‘’“”…]|<\|")
#: Words whose ids a worker remembers; beyond that it starts anew (bounds memory, not results).
CACHE_WORDS = 300_000


def _byte_letters() -> list[str]:
    """The printable letter that byte-level BPE files use for each byte."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, extra = [], 256
    for b in range(256):
        letters.append(chr(b if b in plain else extra))
        extra += b not in plain
    return letters


class WordTokenizer(dict):
    """word -> packed ids; also the tokenizer of whole texts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer

        super().__init__()
        self._full = Tokenizer.from_file(path)
        self._pieces = self._full.model.tokenize
        self._letters = dict(enumerate(_byte_letters()))

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        spelled = word.encode().decode("latin-1").translate(self._letters)
        ids = np.array([t.id for t in self._pieces(spelled)], "<u4").tobytes()
        if len(word) <= 64:
            self[word] = ids
        return ids

    def packed(self, text: str) -> bytes:
        if NOT_PLAIN.search(text):
            return np.array(self._full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.__getitem__, LATIN_WORDS.findall(text.lower())))


_LOADED: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One tokenizer per worker process and file."""
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]
