"""A cuckoo filter over live digests with the digests themselves beside it.

Each digest has two possible buckets of four slots.  The filter keeps a
16-bit fingerprint per slot; the content keeps, in the same slot, the whole
digest and its values.  Lookups read fingerprints first and verify a hit
against the content of that slot, so false positives never show.  A digest
that finds no slot doubles the table, which is refilled from the stored
digests.
"""

from __future__ import annotations

import pickle

SLOTS = 4
MAX_KICKS = 200


class CuckooIndex:
    """digest (at least 16 bytes) -> value; insertion, lookup and deletion in constant time."""

    def __init__(self, buckets: int = 64):
        self.n = 0
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.fingerprints = bytearray(2 * SLOTS * buckets)  # 0: free
        self.keys: list[bytes | None] = [None] * (SLOTS * buckets)
        self.values: list = [None] * (SLOTS * buckets)

    def _places(self, digest: bytes) -> tuple[bytes, int, int]:
        mark = digest[:2] if digest[:2] != b"\0\0" else b"\0\1"
        one = int.from_bytes(digest[4:12], "little") & self.mask
        return mark, one, self._other(one, mark)

    def _other(self, bucket: int, mark: bytes) -> int:
        return (bucket ^ (int.from_bytes(mark, "little") * 0x5BD1E995)) & self.mask

    def _find(self, digest: bytes) -> int:
        """Slot that holds the digest, or -1.  Only fingerprint hits look at the content."""
        mark, one, two = self._places(digest)
        for bucket in (one, two):
            for slot in range(SLOTS * bucket, SLOTS * bucket + SLOTS):
                if self.fingerprints[2 * slot:2 * slot + 2] == mark and self.keys[slot] == digest:
                    return slot
        return -1

    def get(self, digest: bytes):
        slot = self._find(digest)
        return None if slot < 0 else self.values[slot]

    def put(self, digest: bytes, value) -> None:
        """Insert the digest, or replace its value."""
        slot = self._find(digest)
        if slot >= 0:
            self.values[slot] = value
            return
        self.n += 1
        if self.n > 0.95 * len(self.keys):
            self._grow()
        left = self._insert(digest, value)
        while left is not None:
            self._grow()
            left = self._insert(*left)

    def delete(self, digest: bytes) -> bool:
        slot = self._find(digest)
        if slot >= 0:
            self._set(slot, b"\0\0", None, None)
            self.n -= 1
        return slot >= 0

    def items(self):
        return ((k, self.values[i]) for i, k in enumerate(self.keys) if k is not None)

    def _set(self, slot: int, mark: bytes, key, value) -> None:
        self.fingerprints[2 * slot:2 * slot + 2] = mark
        self.keys[slot], self.values[slot] = key, value

    def _insert(self, key: bytes, value) -> tuple | None:
        """Place a digest that is not there, moving others as needed; returns the one left over, if any."""
        mark, one, two = self._places(key)
        for bucket in (one, two):
            for slot in range(SLOTS * bucket, SLOTS * bucket + SLOTS):
                if self.keys[slot] is None:
                    self._set(slot, mark, key, value)
                    return None
        bucket = two
        for kick in range(MAX_KICKS):
            slot = SLOTS * bucket + (kick * 7 + mark[0]) % SLOTS
            old = bytes(self.fingerprints[2 * slot:2 * slot + 2]), self.keys[slot], self.values[slot]
            self._set(slot, mark, key, value)
            mark, key, value = old
            bucket = self._other(bucket, mark)
            for slot in range(SLOTS * bucket, SLOTS * bucket + SLOTS):
                if self.keys[slot] is None:
                    self._set(slot, mark, key, value)
                    return None
        return key, value

    def _grow(self) -> None:
        """Double the buckets and refill them from the stored digests, until all have a slot."""
        kept, buckets = list(self.items()), self.mask + 1
        while True:
            buckets *= 2
            self._clear(buckets)
            if all(self._insert(k, v) is None for k, v in kept):
                return

    def dump(self) -> bytes:
        return pickle.dumps((self.mask + 1, self.n, bytes(self.fingerprints), self.keys, self.values), protocol=5)

    @classmethod
    def load(cls, data: bytes) -> CuckooIndex:
        self = cls(1)
        buckets, self.n, marks, self.keys, self.values = pickle.loads(data)
        self.mask, self.fingerprints = buckets - 1, bytearray(marks)
        return self
