"""A cuckoo filter whose slots carry the stored keys, for one shard of a digest index."""

from __future__ import annotations

from array import array
from collections.abc import Iterator

SLOTS = 4
MAX_KICKS = 128


class CuckooIndex:
    """Live digests of one shard.

    The filter holds 16-bit fingerprints in buckets of four slots; a digest lives in
    one of two buckets. Beside each slot lies the stored entry, so that a hit is
    verified against the content of the bucket and a full table is rebuilt at twice
    its size from the stored keys.
    """

    def __init__(self, buckets: int = 64) -> None:
        self.buckets = 1 << max(1, (buckets - 1).bit_length())
        self.live = 0
        self.resizes = 0
        self._clear()

    def _clear(self) -> None:
        self.marks = array("H", bytes(2 * SLOTS * self.buckets))
        self.entries: list[list | None] = [None] * (SLOTS * self.buckets)

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[:2], "little") or 1
        first = int.from_bytes(digest[2:10], "little") & (self.buckets - 1)
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x5BD1E995)) & (self.buckets - 1)

    def may_contain(self, digest: bytes) -> bool:
        """The filter alone: never false for a live digest."""
        mark, first, second = self._places(digest)
        marks = self.marks
        return any(marks[SLOTS * b + i] == mark for b in (first, second) for i in range(SLOTS))

    def find(self, digest: bytes) -> list | None:
        """Entry [digest, keep_id, copies] of a live digest: filter hits, each verified on its stored key."""
        mark, first, second = self._places(digest)
        for bucket in (first, second):
            for slot in range(SLOTS * bucket, SLOTS * bucket + SLOTS):
                if self.marks[slot] == mark and self.entries[slot][0] == digest:
                    return self.entries[slot]
        return None

    def insert(self, digest: bytes, keep_id: int | None, copies: int = 1) -> None:
        """Add copies of a digest; the smallest id represents it, a null id only if there is no other."""
        entry = self.find(digest)
        if entry is None:
            self.live += 1
            self._place([digest, keep_id, copies])
            return
        entry[2] += copies
        if keep_id is not None and (entry[1] is None or keep_id < entry[1]):
            entry[1] = keep_id

    def delete(self, digest: bytes, copies: int = 1) -> bool:
        """Take copies away; the digest goes with its last copy. False if it is not live."""
        entry = self.find(digest)
        if entry is None:
            return False
        entry[2] -= copies
        if entry[2] <= 0:
            slot = next(s for s in self._slots(digest) if self.entries[s] is entry)
            self.marks[slot], self.entries[slot] = 0, None
            self.live -= 1
        return True

    def _slots(self, digest: bytes) -> Iterator[int]:
        _, first, second = self._places(digest)
        for bucket in (first, second):
            yield from range(SLOTS * bucket, SLOTS * bucket + SLOTS)

    def _place(self, entry: list) -> None:
        mark, bucket, second = self._places(entry[0])
        for slot in self._slots(entry[0]):
            if self.entries[slot] is None:
                self.marks[slot], self.entries[slot] = mark, entry
                return
        bucket = second
        for kick in range(MAX_KICKS):
            slot = SLOTS * bucket + kick % SLOTS
            entry, self.entries[slot] = self.entries[slot], entry
            mark, self.marks[slot] = self.marks[slot], mark
            bucket = self._other(bucket, mark)
            for free in range(SLOTS * bucket, SLOTS * bucket + SLOTS):
                if self.entries[free] is None:
                    self.marks[free], self.entries[free] = mark, entry
                    return
        self._resize(entry)

    def _resize(self, waiting: list) -> None:
        """Overflow: twice the buckets, filled again from the stored keys."""
        stored = [waiting, *self.items()]
        self.buckets *= 2
        self.resizes += 1
        self._clear()
        for entry in stored:
            self._place(entry)

    def items(self) -> Iterator[list]:
        """All live entries."""
        return (entry for entry in self.entries if entry is not None)
