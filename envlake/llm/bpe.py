"""Byte-level BPE as a tree reduction, and its inverse.

A match of the splitting pattern is encoded by halves: each half becomes the ids of its
bytes, and neighbours are joined. A join encodes a window around the seam again, growing
it until it provably needs no more: ids are the encoding of their bytes exactly if every
two neighbours are the encoding of the bytes of the two (merges only ever act between
neighbours, and each id is reached from its own bytes). Within the window this holds as it
was just encoded, outside as the halves were, so only its two seams are looked at.
Decoding concatenates the bytes of the ids up a tree.

Null texts count as empty and have no ids. Repeated rows are encoded each; an empty table
gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator, Sequence

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from envlake.llm.tables import read_table, small_batches
from envlake.llm.tokens import PartCache, per_process

# Entries kept of joined pairs and of short byte strings.
MEMO = 1 << 18


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of byte strings in a rank file: base64 text and rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class TreeCodec:
    """Encoder and decoder of byte strings over a table of ranks."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.short: dict[bytes, list[int]] = {}
        self.windows: dict[bytes, list[int]] = {}

    def _window(self, data: bytes) -> list[int]:
        """Ids of a window, kept for short ones."""
        if len(data) > 12:
            return self._merge(data)
        found = self.windows.get(data)
        if found is None:
            if len(self.windows) >= MEMO:
                self.windows.clear()
            found = self.windows[data] = self._merge(data)
        return found

    def _merge(self, data: bytes) -> list[int]:
        """Ids of a byte string: the lowest-ranked pair merges first, the leftmost among equals."""
        ranks, n = self.ranks, len(data)
        ends = list(range(1, n + 1))  # end of the part that begins here
        before = list(range(-1, n - 1))  # begin of the part ahead of it
        alive = bytearray(b"\x01" * n)
        heap: list[tuple[int, int, int]] = []

        def offer(at: int) -> None:
            if at >= 0 and ends[at] < n:
                stop = ends[ends[at]]
                rank = ranks.get(data[at:stop])
                if rank is not None:
                    heapq.heappush(heap, (rank, at, stop))

        for at in range(n - 1):
            offer(at)
        while heap:
            _, at, stop = heapq.heappop(heap)
            if not alive[at] or ends[at] >= n or ends[ends[at]] != stop:
                continue
            alive[ends[at]] = 0
            ends[at] = stop
            if stop < n:
                before[stop] = at
            offer(before[at])
            offer(at)
        return [ranks[data[at : ends[at]]] for at in range(n) if alive[at]]

    def _stable(self, left: int, right: int) -> bool:
        """Whether two neighbours are the encoding of their bytes."""
        found = self.pairs.get((left, right))
        if found is None:
            if len(self.pairs) >= MEMO:
                self.pairs.clear()
            found = self._merge(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
            self.pairs[left, right] = found
        return found

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Encoding of two neighbouring byte strings from their encodings."""
        if not left or not right:
            return left or right
        if self._stable(left[-1], right[0]):
            return left + right
        i = j = 1
        while True:
            window = self._window(self.decode(left[-i:]) + self.decode(right[:j]))
            whole_left = i == len(left) or self._stable(left[-i - 1], window[0])
            whole_right = j == len(right) or self._stable(window[-1], right[j])
            if whole_left and whole_right:
                return left[:-i] + window + right[j:]
            if not whole_left:
                i = min(2 * i, len(left))
            if not whole_right:
                j = min(2 * j, len(right))

    def encode(self, data: bytes) -> list[int]:
        """Ids of one match of the splitting pattern."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        return self._tree(data) if data else []

    def _tree(self, data: bytes) -> list[int]:
        if len(data) == 1:
            return [self.ranks[data]]
        found = self.short.get(data) if len(data) <= 8 else None
        if found is None:
            middle = len(data) // 2
            found = self.join(self._tree(data[:middle]), self._tree(data[middle:]))
            if len(data) <= 8:
                if len(self.short) >= MEMO:
                    self.short.clear()
                self.short[data] = found
        return found

    def decode(self, ids: Sequence[int]) -> bytes:
        """Bytes of ids, halves concatenated up a tree."""
        if len(ids) <= 8:
            return b"".join([self.bytes_of[one] for one in ids])
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


def text_codec(path: str, pattern: str) -> tuple[TreeCodec, regex.Pattern]:
    """Codec and splitting pattern of a rank file."""
    return TreeCodec(read_ranks(path)), regex.compile(pattern)


def encode_texts(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids (array) of every whole text."""
    small_batches(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, split = text_codec(path, pattern)
        cache = PartCache(lambda parts: [[i for m in split.findall(p) for i in codec.encode(m.encode())] for p in parts])
        for batch in batches:
            for doc_id, found in zip(batch.column(0), cache.of([t or "" for t in batch.column(1).to_pylist()]), strict=True):
                ids = pa.array([[i for part in found for i in part]], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array([doc_id.as_py()], pa.int64()), ids], ["doc_id", "ids"])

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, ids array<int>")


def round_trips(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256 (decimal ids joined by a space), decoded_sha256 (decoded bytes)."""
    small_batches(documents.sparkSession)

    def cached() -> PartCache:
        codec, split = text_codec(path, pattern)

        def trip(match: str) -> tuple[int, str, bytes]:
            ids = codec.encode(match.encode())
            return len(ids), " ".join(map(str, ids)), codec.decode(ids)

        def make(parts: list[str]) -> list[tuple[int, str, bytes]]:
            known: dict[str, tuple[int, str, bytes]] = {}
            made = []
            for part in parts:
                trips = []
                for match in split.findall(part):
                    if match not in known:
                        known[match] = trip(match)
                    trips.append(known[match])
                made.append(
                    trips[0]
                    if len(trips) == 1
                    else (sum(t[0] for t in trips), " ".join([t[1] for t in trips]), b"".join([t[2] for t in trips]))
                )
            return made

        return PartCache(make)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = per_process(("bpe", path, pattern), cached)
        for batch in batches:
            rows = []
            for found in cache.of([text or "" for text in batch.column(1).to_pylist()]):
                ids = " ".join([part[1] for part in found if part[0]])
                decoded = b"".join([part[2] for part in found])
                rows.append(
                    (sum(part[0] for part in found), hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded).hexdigest())
                )
            columns = list(zip(*rows, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )


def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of ids and decoded bytes of all documents."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return round_trips(read_table(spark, folder, "documents"), path, public_tokenizers.PATTERN)
