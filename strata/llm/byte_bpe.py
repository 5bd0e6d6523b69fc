"""Byte-level BPE encoding and decoding with numpy matrices.

Every match of the split pattern (a piece) is encoded separately. The distinct pieces of a
slice of texts that are not in the task's cache go into matrices, one per length bucket (powers of two),
padded to the longest piece: one row per piece, one byte's id per cell. In each
round every row finds its leftmost pair of minimum rank by a hashed pair lookup
(multiplicative hash, linear probing, vectorised over all cells), merges it, and is
compacted; rows without a pair leave. Only pairs around the merge are looked up again.
A document's ids are those of its pieces, one after another; decoding maps ids to bytes.

Pieces longer than ``LONG`` bytes (a text without a break) would need as many rounds as they have
merges; they merge the same pairs in the same order from a heap of (rank, position).

The cache maps pieces to packed ids and takes at most ``CACHE_BYTES`` of memory (and one
slice's pieces) in each of two generations, so memory does not grow with the input; ids are decoded from
the table of tokens. Defined cases: null text encodes as empty (no ids); rows are kept
one to one, repeated rows get equal results; special tokens are ordinary text; other
columns are ignored. The vocabulary's path is a parameter; every task reads the ranks from
a broadcast copy (under 2 MB).
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from strata.llm.common import ranges, slices, utf8

LONG = 512
#: Memory of a generation of the cache, and ids joined at once.
CACHE_BYTES, JOINED = 32 << 20, 1 << 18
# The letters, numbers and blanks below U+0250, where Python's own (faster)
# regular expressions need them spelled out.
_NARROW = {r"\p{L}": "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", r"\p{N}": "0-9\u00b2\u00b3\u00b9\u00bc-\u00be", r"\s": "\t-\r \u0085\u00a0"}
_WIDE = re.compile("[^\x00-\u024f]")
_NONE = np.int32(np.iinfo(np.int32).max)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PairTable:
    """Rank of the token made of two tokens, by open addressing in two numpy arrays."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        key, value = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    key.append(a << 32 | b)
                    value.append(rank)
        keys, values = np.array(key, dtype=np.uint64), np.array(value, dtype=np.int32)
        bits = max(4, int(len(keys) * 3).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, np.iinfo(np.uint64).max, dtype=np.uint64)
        self.values = np.full(1 << bits, _NONE, dtype=np.int32)
        slot, left = self._slot(keys), np.arange(len(keys))
        self.probes = 0
        while len(left):
            self.probes += 1
            at = slot[left]
            free = self.keys[at] == np.iinfo(np.uint64).max
            owner, first = np.unique(at[free], return_index=True)
            won = left[free][first]
            self.keys[owner], self.values[owner] = keys[won], values[won]
            left = np.setdiff1d(left, won, assume_unique=True)
            slot[left] = (slot[left] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def look_up(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of the pairs, ``_NONE`` where they make no token (also for negative ids)."""
        keys = a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64) & np.uint64(0xFFFFFFFF)
        slot = self._slot(keys)
        out = np.full(keys.shape, _NONE, dtype=np.int32)
        left = np.arange(keys.size)
        keys, slot, flat = keys.ravel(), slot.ravel(), out.ravel()
        for _ in range(self.probes):
            found = self.keys[slot[left]]
            hit = found == keys[left]
            flat[left[hit]] = self.values[slot[left[hit]]]
            left = left[~hit & (found != np.iinfo(np.uint64).max)]
            if not len(left):
                break
            slot[left] = (slot[left] + 1) & self.mask
        return flat.reshape(out.shape)


def narrowed(pattern: str) -> str:
    """The pattern with its classes spelled out, for texts below U+0250."""
    out, inside = [], False
    for part in re.findall(r"\\p\{\w\}|\\.|.", pattern, re.S):
        inside = (inside or part == "[") and part != "]"
        named = _NARROW.get(part)
        if part == r"\S":
            out.append(f"[^{_NARROW[chr(92) + 's']}]")
        else:
            out.append(part if named is None else named if inside else f"[{named}]")
    return "".join(out)


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.wide, self.narrow, self.ranks = regex.compile(pattern), re.compile(narrowed(pattern)), ranks
        self.pairs = PairTable(ranks)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.tokens = token_bytes(ranks)
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    # ---- matrices -----------------------------------------------------------

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of every (non-empty) piece."""
        out: list[list[int]] = [[]] * len(pieces)
        length = np.array([len(p) for p in pieces], dtype=np.int64)
        bucket = np.ceil(np.log2(np.maximum(length, 1))).astype(np.int64)
        for width in np.unique(bucket[length <= LONG]):
            rows = np.flatnonzero((bucket == width) & (length <= LONG))
            step = max(1, (1 << 19) >> int(width))
            for at in range(0, len(rows), step):
                part = rows[at : at + step]
                for k, ids in zip(part.tolist(), self._matrix([pieces[k] for k in part.tolist()]), strict=True):
                    out[k] = ids
        for k in np.flatnonzero(length > LONG):
            out[k] = self._long(pieces[k])
        return out

    def _matrix(self, pieces: list[bytes]) -> list[list[int]]:
        size = np.array([len(p) for p in pieces])
        width = int(size.max())
        cells = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), dtype=np.uint8).reshape(len(pieces), width)
        ids = self.byte_ids[cells]
        ids[np.arange(width) >= size[:, None]] = -1
        rank = np.full((len(pieces), width), _NONE, dtype=np.int32)
        if width > 1:
            both = ids[:, 1:] >= 0
            rank[:, :-1][both] = self.pairs.look_up(ids[:, :-1][both], ids[:, 1:][both])
        done: list[list[int]] = [[]] * len(pieces)
        row = np.arange(len(pieces))
        while len(row):
            at = rank.argmin(axis=1)  # the leftmost minimum
            every = np.arange(len(row))
            least = rank[every, at]
            if (over := least == _NONE).any():
                for k, cells, n in zip(row[over], ids[over], size[over], strict=True):
                    done[k] = cells[:n].tolist()
                keep = ~over
                ids, rank, size, row, at, least = ids[keep], rank[keep], size[keep], row[keep], at[keep], least[keep]
                if not len(row):
                    break
                every = np.arange(len(row))
            # merge, and move everything behind it one cell to the left
            ids[every, at] = least
            width = ids.shape[1]
            source = np.arange(width) + (np.arange(width) > at[:, None])
            source[:, -1] = np.minimum(source[:, -1], width - 1)
            ids = np.take_along_axis(ids, source, axis=1)
            rank = np.take_along_axis(rank, source, axis=1)
            size = size - 1
            ids[every, size] = -1
            rank[every, np.maximum(size - 1, 0)] = _NONE
            rank[every, size] = _NONE
            if (width := int(size.max())) < ids.shape[1]:
                ids, rank = ids[:, :width], rank[:, :width]
            for k, inside in ((at, at + 1 < size), (at - 1, at > 0)):
                r = every[inside]
                rank[r, k[inside]] = self.pairs.look_up(ids[r, k[inside]], ids[r, k[inside] + 1])
        return done

    def _long(self, piece: bytes) -> list[int]:
        """One long piece: leftmost pairs of minimum rank from a heap, in n log n steps."""
        ids = self.byte_ids[np.frombuffer(piece, dtype=np.uint8)]
        rank = self.pairs.look_up(ids[:-1], ids[1:])
        ids = ids.tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(int(rank[i]), i, ids[i], ids[i + 1]) for i in np.flatnonzero(rank != _NONE).tolist()]
        heapq.heapify(heap)
        tokens, ranks = self.tokens, self.ranks
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= len(ids) or ids[j] != b:
                continue  # one of the two has been merged since
            ids[i], ids[j] = r, -1
            after[i] = k = after[j]
            if k < len(ids):
                before[k] = i
            for x, y in ((before[i], i), (i, k)):
                if x >= 0 and y < len(ids):
                    made = ranks.get(tokens[ids[x]] + tokens[ids[y]])
                    if made is not None:
                        heapq.heappush(heap, (made, x, ids[x], ids[y]))
        return [i for i in ids if i >= 0]

    # ---- texts --------------------------------------------------------------

    def learn(self, pieces: set[str]) -> None:
        """Put the pieces' packed ids into the cache.

        A full cache becomes the old one, from which pieces still in use are taken over.
        """
        if self.held > CACHE_BYTES:
            self.old, self.known, self.held = self.known, {}, 0
        new = pieces.difference(self.known)
        for piece in new.intersection(self.old):
            self._put(piece, self.old[piece])
            new.discard(piece)
        new = list(new)
        for piece, ids in zip(new, self.encode_pieces([p.encode() for p in new]), strict=True):
            self._put(piece, np.array(ids, dtype="<i4").tobytes())

    def _put(self, piece: str, ids: bytes) -> None:
        self.known[piece] = ids
        # both objects, and their places in the dictionary
        self.held += sys.getsizeof(piece) + sys.getsizeof(ids) + 100

    def split(self, text: str) -> list[str]:
        return (self.wide if _WIDE.search(text) else self.narrow).findall(text)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text."""
        split = [self.split(t) for t in texts]
        self.learn(set().union(*split))
        return [np.frombuffer(b"".join(map(self.known.__getitem__, pieces)), dtype="<i4") for pieces in split]


class Strings:
    """Byte strings by number, joined for many numbers at once."""

    def __init__(self, strings: list[bytes]) -> None:
        self.data = np.frombuffer(b"".join(strings), dtype=np.uint8)
        self.size = np.array([len(s) for s in strings], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size

    def joined(self, numbers: np.ndarray) -> bytes:
        parts = [
            self.data[ranges(self.start[part], self.size[part])].tobytes()
            for part in (numbers[at : at + JOINED] for at in range(0, len(numbers), JOINED))
        ]
        return b"".join(parts)


def token_bytes(ranks: dict[bytes, int]) -> list[bytes]:
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


def encode_decode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value, pattern)
        token, decimal = Strings(encoder.tokens), Strings([b"%d " % k for k in range(len(encoder.tokens))])
        for part in slices(batches):
            made = [
                (len(ids), hashlib.sha256(decimal.joined(ids)[:-1]).hexdigest(), hashlib.sha256(token.joined(ids)).hexdigest())
                for ids in encoder.encode(utf8(part.column("text")).to_pylist())
            ]
            n, ids, decoded = zip(*made, strict=True)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``(doc_id, ids)`` for every row: the token ids themselves."""
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value, pattern)
        for part in slices(batches):
            ids = encoder.encode(utf8(part.column("text")).to_pylist())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decoded(ids: DataFrame, path: str) -> DataFrame:
    """``(doc_id, bytes)`` of rows ``(doc_id, ids)``: the inverse of :func:`encoded` (null ids: no bytes)."""
    shared = ids.sparkSession.sparkContext.broadcast(token_bytes(read_ranks(path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = Strings(shared.value)
        for rows in batches:
            made = [token.joined(np.array(row or [], dtype=np.int64)) for row in rows.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(made, pa.binary())], names=["doc_id", "bytes"])

    return ids.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")
