"""Byte-level byte-pair ids of whole texts, and the texts of ids, in two tiers.

A text is cut into pre-tokens by a pattern.  Tier one is a minimal perfect hash of the vocabulary:
every token has a slot of its own among as many slots as there are tokens, and a pre-token that is
the token in its slot has that token's id.  Tier two takes the misses: the bytes are a linked
list, a heap holds the mergeable neighbours by rank and place, and the least is merged until the
heap is empty.  Both give what the rank file's own library gives.

Work goes by segments: a run of other characters with the one space before it, or white space.
Pre-tokens never reach across their ends, so the ids of a text are those of its segments, and each
worker keeps the ids of the segments it met in two generations of bounded size.

Defined results: null counts as empty, and an empty text has no ids; a text of any length is one
row, its segments are encoded one after the other; repeated rows and ids are encoded each for
itself, a null id stays null; an empty table gives an empty result; columns other than the id and
the text are ignored, whatever their names.  Ids outside the vocabulary cannot be decoded and raise.
"""

from __future__ import annotations

import base64
import re
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from basketry.llm.common import python_rows

RANKS, CHUNK_BYTES, CACHE_SEGMENTS = "byte_bpe_50k.tiktoken", 4 << 20, 400_000
ID_SCHEMA = "doc_id bigint, ids binary"
# Fixed: the characters with Unicode's White_Space property.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SEGMENT = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
_KEYS_PER_BUCKET = 2
_TRIES = np.arange(64, dtype=np.int64)[:, None]


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path(RANKS)


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PerfectHash:
    """Slots 0 .. n - 1 for n keys, by hash and displace.

    A key's hash names its bucket and its free place; the bucket's displacement moves that place
    until no key of the bucket meets a taken slot.  Buckets go from the largest to the smallest.
    The last ones have one key and simply name a slot that is left, as a negative number.
    """

    def __init__(self, keys: list[bytes]):
        self.size = n = len(keys)
        self.buckets = max(1, n // _KEYS_PER_BUCKET)
        self.displace = np.zeros(self.buckets, dtype=np.int64)
        self.slots: list[int] = [0] * n
        self.keys: list[bytes | None] = [None] * max(1, n)
        hashes = self.hashes(keys)
        if len(np.unique(hashes)) < n:
            raise ValueError("two tokens are equal, or equal in all 64 bits of their hashes")
        members: list[list[int]] = [[] for _ in range(self.buckets)]
        for i, b in enumerate((hashes % np.uint64(self.buckets)).tolist()):
            members[b].append(i)
        taken = np.zeros(n, dtype=bool)
        order = sorted(range(self.buckets), key=lambda b: -len(members[b]))
        free = None
        for b in order:
            found = members[b]
            if not found:
                break
            if len(found) == 1:
                free = free or iter(np.flatnonzero(~taken).tolist())
                places, d = [next(free)], None
                self.displace[b] = -1 - places[0]
            else:
                own, d = hashes[found], 0
                while True:  # displacements are tried a row of them at a time
                    tried = self._place(own[None], d + _TRIES)
                    clash = taken[tried].any(axis=1)
                    for row in np.flatnonzero(~clash).tolist():
                        places = tried[row].tolist()
                        if len(set(places)) == len(places):
                            d += row
                            break
                    else:
                        d += len(_TRIES)
                        continue
                    break
                self.displace[b] = d
                taken[places] = True
            for i, place in zip(found, places, strict=True):
                self.slots[i], self.keys[place] = place, keys[i]

    @staticmethod
    def hashes(keys: list[bytes]) -> np.ndarray:
        return np.array(list(map(xxhash.xxh3_64_intdigest, keys)), dtype=np.uint64)

    def _place(self, hashes: np.ndarray, displace: np.ndarray) -> np.ndarray:
        mixed = (hashes ^ hashes >> np.uint64(32)) + displace.view(np.uint64) * np.uint64(
            0x9E3779B97F4A7C15)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        return ((mixed ^ mixed >> np.uint64(29)) % np.uint64(max(1, self.size))).astype(np.int64)

    def find(self, keys: list[bytes]) -> list[int]:
        """The slot of each key, -1 for what is no key."""
        if not self.size or not keys:
            return [-1] * len(keys)
        hashes = self.hashes(keys)
        d = self.displace[(hashes % np.uint64(self.buckets)).astype(np.int64)]
        slots = np.where(d < 0, -1 - d, self._place(hashes, np.maximum(d, 0))).tolist()
        held = self.keys
        return [s if held[s] == k else -1 for s, k in zip(slots, keys, strict=True)]


def merged(word: bytes, rank_of: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token that is no token: least rank first, of equal ranks the leftmost."""
    n = len(word)
    get = rank_of.get
    after, before = list(range(1, n + 1)), list(range(-1, n))
    best = [get(word[i:i + 2], -1) for i in range(n - 1)] + [-1]
    shift = n.bit_length()
    low = (1 << shift) - 1
    heap = [r << shift | i for i, r in enumerate(best) if r >= 0]
    heapify(heap)
    while heap:
        least = heappop(heap)
        i = least & low
        if best[i] != least >> shift:
            continue  # a neighbour was merged meanwhile
        gone = after[i]
        end = after[i] = after[gone]
        before[end] = i
        best[gone] = -1
        best[i] = r = get(word[i:after[end]], -1) if end < n else -1
        if r >= 0:
            heappush(heap, r << shift | i)
        p = before[i]
        if p >= 0:
            best[p] = r = get(word[p:end], -1)
            if r >= 0:
                heappush(heap, r << shift | p)
    ids, i = [], 0
    while i < n:
        ids.append(rank_of[word[i:after[i]]])
        i = after[i]
    return ids


class BytePairs:
    """The two tiers, and the way back."""

    def __init__(self, path: str, pattern: str | None = None, cache: int = CACHE_SEGMENTS):
        import regex

        self.rank_of = read_ranks(path)
        tokens = list(self.rank_of)
        self.hash = PerfectHash(tokens)
        self.id_at = [0] * len(tokens)
        for slot, token in zip(self.hash.slots, tokens, strict=True):
            self.id_at[slot] = self.rank_of[token]
        self.text_of = {rank: token for token, rank in self.rank_of.items()}
        self.pattern = regex.compile(pattern or default_pattern())
        self.cache = cache
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _resolve(self, words: list[bytes]) -> dict[bytes, list[int]]:
        """Ids of pre-tokens: the perfect hash first, then the heap."""
        found = {}
        for word, slot in zip(words, self.hash.find(words), strict=True):
            found[word] = [self.id_at[slot]] if slot >= 0 else merged(word, self.rank_of)
        return found

    def _meet(self, segments: set[str]) -> None:
        """Have the ids of these segments at hand."""
        if len(self.known) > self.cache:
            self.known, self.older = {}, self.known
        known, older, new = self.known, self.older, []
        for s in segments.difference(known):
            if (ids := older.get(s)) is None:
                new.append(s)
            else:
                known[s] = ids
        if not new:
            return
        cut = [[m.encode() for m in self.pattern.findall(s)] for s in new]
        ids_of = self._resolve(list({w for words in cut for w in words}))
        for s, words in zip(new, cut, strict=True):
            ids = ids_of[words[0]] if len(words) == 1 else [i for w in words for i in ids_of[w]]
            known[s] = np.array(ids, dtype="<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids, each four bytes with the least first."""
        parts = list(map(_SEGMENT.findall, texts))
        self._meet({s for p in parts for s in p})
        get = self.known.__getitem__
        return [b"".join(map(get, p)) for p in parts]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.text_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_LOADED: dict[tuple[str, str | None], BytePairs] = {}


def worker_pairs(path: str, pattern: str | None = None) -> BytePairs:
    """One per worker process, rank file and pattern."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = BytePairs(path, pattern)
    return _LOADED[path, pattern]


def _slices(batch: pa.RecordBatch, name: str, size: int = CHUNK_BYTES):
    """Parts of a batch of some megabytes of text each; a longer text is a part of its own."""
    held = np.cumsum(pc.binary_length(batch.column(name)).fill_null(0).to_numpy(
        zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        limit = (held[start - 1] if start else 0) + size
        end = max(start + 1, int(np.searchsorted(held, limit, side="right")))
        yield batch.slice(start, end - start)
        start = end


def _encode_step(path: str, pattern: str | None):
    def step(batches):
        pairs = worker_pairs(path, pattern)
        for batch in batches:
            for part in _slices(batch, "text"):
                ids = pairs.encode(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.binary())],
                                                 names=["doc_id", "ids"])
    return step


def _decode_step(path: str, pattern: str | None):
    def step(batches):
        pairs = worker_pairs(path, pattern)
        for batch in batches:
            for part in _slices(batch, "ids"):
                body = [None if i is None else pairs.decode(i)
                        for i in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("ids"), pa.array(body, pa.binary())],
                    names=["doc_id", "ids", "body"])
    return step


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
           ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """``(doc_id, ids)``: the ids of each text as little-endian 32-bit integers."""
    texts = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    return python_rows(texts, _encode_step(ranks or default_ranks(), pattern), ID_SCHEMA)


def decode(encoded: DataFrame, *, ranks: str | None = None,
           pattern: str | None = None) -> DataFrame:
    """``(doc_id, ids, body)``: the bytes that the ids stand for; null ids give null."""
    return python_rows(encoded.select("doc_id", "ids"),
                       _decode_step(ranks or default_ranks(), pattern),
                       f"{ID_SCHEMA}, body binary")


def digests(decoded: DataFrame) -> DataFrame:
    """Counts and checksums of :func:`decode`'s rows."""
    return decoded.select("doc_id", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("body", 256).alias("decoded_sha256"))
