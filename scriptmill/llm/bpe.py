"""Byte-level BPE in two tiers.

Tier one: a minimal perfect hash over the vocabulary answers, in one probe,
whether a whole pre-token is itself an entry (its id needs no merges). Tier
two: a miss is merged by rank with a heap over a doubly linked list of bytes,
O(n log n) in the length of the pre-token. Results are remembered in two
bounded generations, because pre-tokens follow Zipf's law.

Defined cases: a null text is the empty text (no ids, empty bytes); texts of
any length are encoded whole; rows are independent, so repeated rows, ties and
further columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession

from scriptmill.llm.batches import map_texts, schema_of

MEMO = 500_000  # entries of a generation
_MASK = (1 << 64) - 1


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file by id; ids must be 0, 1, 2, ..."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens = [b""] * len(pairs)
    for word, rank in pairs:
        tokens[int(rank)] = base64.b64decode(word)
    return tokens


def unicode_space(pattern: str) -> str:
    r"""The pattern with ``\s`` read as the Unicode White_Space property, as the reference library's regex engine does; ``regex`` would add U+001C to U+001F."""
    inside = pattern.replace(r"[^\s", r"[^\p{White_Space}")
    return inside.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")


class PerfectHash:
    """Minimal perfect hash by hash-and-displace: ``len(keys)`` slots, one displacement a bucket.

    A bucket of several keys stores the seed under which they fall on free
    slots; a bucket of one key stores its slot directly, as a negative number.
    """

    def __init__(self, keys: list[bytes]):
        n, m = len(keys), max(1, len(keys) // 3)
        self.n, self.m = n, m
        self.slots, self.shift = np.full(n, -1, np.int64), np.zeros(m, np.int64)
        hashes = [xxhash.xxh64_intdigest(k) for k in keys]
        buckets: dict[int, list[int]] = {}
        for i, h in enumerate(hashes):
            buckets.setdefault(h % m, []).append(i)
        taken = bytearray(n)
        free = None
        for b, members in sorted(buckets.items(), key=lambda x: (-len(x[1]), x[0])):
            if len(members) == 1:
                if free is None:
                    free = iter([i for i in range(n) if not taken[i]])
                at = next(free)
                self.shift[b], self.slots[at] = -1 - at, members[0]
                continue
            d = 1
            while True:
                places = {self._place(hashes[i], d) for i in members}
                if len(places) == len(members) and not any(taken[p] for p in places):
                    break
                d += 1
            self.shift[b] = d
            for i in members:
                p = self._place(hashes[i], d)
                taken[p], self.slots[p] = 1, i
        self.shift, self.slots = self.shift.tolist(), self.slots.tolist()

    def _place(self, h: int, d: int) -> int:
        x = ((h ^ (d * 0x9E3779B97F4A7C15)) & _MASK) * 0xD6E8FEB86659FD93 & _MASK
        return ((x ^ (x >> 32)) * 0xD6E8FEB86659FD93 & _MASK) * self.n >> 64

    def index(self, key: bytes) -> int:
        """The only key number that ``key`` can have; the caller compares."""
        if not self.n:
            return -1
        h = xxhash.xxh64_intdigest(key)
        d = self.shift[h % self.m]
        return self.slots[-1 - d] if d < 0 else self.slots[self._place(h, d)]


class Vocabulary:
    """Token bytes by id with the perfect hash; built on the driver, broadcast to the executors."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens, self.pattern = tokens, unicode_space(pattern)
        self.hash = PerfectHash(tokens)

    def id_of(self, piece: bytes) -> int:
        i = self.hash.index(piece)
        return i if i >= 0 and self.tokens[i] == piece else -1


class Encoder(dict):
    """Maps a pre-token to its ids as little-endian 32-bit integers; holds the memo of the pre-tokens seen."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.v, self.old = vocabulary, {}
        self.ranks = {t: i for i, t in enumerate(vocabulary.tokens)}  # of merges, by their bytes
        self.split = regex.compile(vocabulary.pattern).findall

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = np.array(self.merge(piece.encode()), "<u4").tobytes()
        if len(piece) <= 64:
            if len(self) >= MEMO:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def merge(self, piece: bytes) -> list[int]:
        whole = self.v.id_of(piece)
        if whole >= 0:
            return [whole]
        rank, n = self.ranks.get, len(piece)
        bits = n.bit_length()
        mask = (1 << bits) - 1
        parts = [piece[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # an entry holds a rank and, in its low bits, the place of the left part
        heap = [r << bits | i for i in range(n - 1) if (r := rank(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            entry = heapq.heappop(heap)
            i = entry & mask
            if parts[i] is None or (j := after[i]) >= n:
                continue
            joined = parts[i] + parts[j]
            if rank(joined) != entry >> bits:
                continue  # one side has been merged since
            k = after[j]
            parts[i], parts[j], after[i] = joined, None, k
            if k < n:
                before[k] = i
                if (r := rank(joined + parts[k])) is not None:
                    heapq.heappush(heap, r << bits | i)
            if (h := before[i]) >= 0 and (r := rank(parts[h] + joined)) is not None:
                heapq.heappush(heap, r << bits | h)
        return [self.ranks[p] for p in parts if p is not None]

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.split(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.v.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_ENCODERS: dict[int, Encoder] = {}  # of this Python worker, by broadcast


def _encoder(shared) -> Encoder:
    key = id(shared.value)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(shared.value)
    return _ENCODERS[key]


def vocabulary(spark: SparkSession, path: str, pattern: str):
    """Broadcast of a rank file's vocabulary (tens of thousands of entries, whatever the corpus)."""
    return spark.sparkContext.broadcast(Vocabulary(read_ranks(path), pattern))


def encode(df: DataFrame, path: str, pattern: str, keep: list[str], text: str = "text") -> DataFrame:
    """Kept columns and ``ids``: binary, little-endian unsigned 32-bit."""
    shared = vocabulary(df.sparkSession, path, pattern)

    def make():
        e = _encoder(shared)
        return lambda texts: {"ids": [e.encode(x) for x in texts]}

    return map_texts(df, make, keep, text, schema_of(df, keep, "ids binary"))


def encode_decode(df: DataFrame, path: str, pattern: str, keep: list[str], text: str = "text") -> DataFrame:
    """Kept columns, ``n_tokens``, and digests of the ids and of the bytes decoded from them."""
    shared = vocabulary(df.sparkSession, path, pattern)

    def make():
        e = _encoder(shared)

        def fn(texts):
            ids = [e.encode(x) for x in texts]
            sha = lambda x: hashlib.sha256(x).hexdigest()
            return {"n_tokens": [len(x) // 4 for x in ids], "ids_sha256": [sha(x) for x in ids], "decoded_sha256": [sha(e.decode(x)) for x in ids]}

        return fn

    return map_texts(df, make, keep, text, schema_of(df, keep, "n_tokens long, ids_sha256 string, decoded_sha256 string"))
