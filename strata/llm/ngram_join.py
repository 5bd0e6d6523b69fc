"""N-gram Jaccard join with signature trees.

A document's set holds its distinct ``width``-word shingles (words are runs without
space or tab..CR, A-Z lower-cased; a document with fewer words has its whole word
sequence as its only shingle; one without words has the empty set and links with
nothing). Documents link when ``100 * |intersection| >= percent * |union|``.

The join is exact (up to collisions of hashes: 64 bits for classes and signatures, 48 bits where two
sets are compared, and up to the chance ``MISS`` below) and has four steps:

1. one pass over the texts gives every document its set's size and 64-bit key;
   documents of equal keys are one class.
2. a second pass posts signatures of every class (once per task). Two linked sets of at most ``a``
   shingles differ in at most ``D = floor(2a * (100 - percent) / (100 + percent))`` shingles.
   Shingles are dealt into parts by their hash, and the hash of a part's shingles is a signature
   (:func:`schemes`); linked sets agree in a part that no difference falls into. Where D is large, so many parts are
   taken that the chance of no such part of at least ``SHARED`` shingles is below ``MISS`` for two sets just at the limit;
   where D is small, more than D parts, so that there is one for certain (unless a set's shingles lie in too few parts; then the
   sets of its size also post their prefix, the first ``n - ceil(t * n) + 1`` shingles in order of hashes, of
   which linked sets share one). Long sets that merely have a passage in common rarely agree in a part of several shingles;
   short ones, whose parts are small, often do. So the classes of a signature are a *group*, in which they are compared by
   sketches of ``SKETCH`` bits (groups with the same members once, a large group in salted blocks): a bit tells whether an odd number of
   shingles falls on it, so two sets differ in at least as many shingles as their sketches do in bits. Classes that
   may still link are chained, and connected components of the chain are the *forests* in which links can exist.
3. the full sets of a forest come together (a second pass over the texts, of which a bitmap of
   fixed size drops most classes in no forest before the shuffle; a set goes as its hashes or as its
   text compressed, whichever is shorter), in salted blocks by size class where a forest is
   large, and every block (or pair of blocks) is joined by a signature tree.
4. components of the links found, carried back to all documents.

Signature tree: classes sorted by size, leaves of ``LEAF``, ``FANOUT`` children per inner
node; a node holds the OR of its members' bitmaps, its size range and the most
shingles that one member has on one bit. Two nodes are compared only while the
largest possible overlap can reach the required one; pairs of members are
bounded by their own bitmaps and then checked on the sets. Nodes whose members are all
in one component already are skipped, so a group of copies costs its spanning
links, not its pairs. Every component is found whole.

Defined cases: null text counts as empty; rows that share a ``doc_id`` are one
document; a row with a null ``doc_id`` links with nothing and has a null component;
only the columns ``doc_id`` and ``text`` are read, other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import by_key, compressed, connected_components, decompressed, mix64, shingles, slices, stored, text_bytes

#: Ratio of the sizes at which two schemes of parts start, and most schemes.
STEP, SCHEMES = 1.5, 60
#: Chance of having no large enough equal part, and least shingles of a part where that chance is used.
MISS, SHARED = 1e-13, 3
BITS = 4096
LEAF = 64
FANOUT = 8
#: Least and most classes, and most shingles, that one block should hold (fewer blocks copy less, more spread better).
LEAST_BLOCK, BLOCK = 2048, 8192
BLOCK_SHINGLES = 3_000_000
#: More than the chunks that a size class can have; numbers of chunks are unique within a forest.
MOST_CHUNKS = 1 << 40
#: Bits of a sketch, those looked at first (both in words of 64), and classes of a group's salt.
SKETCH, FIRST = 1024, 512
GROUP_BLOCK = 4096
#: Classes that a task remembers as posted, and bits of the filter of wanted classes (4 MB).
POSTED = 100_000
FILTER_BITS = 1 << 25


def required_overlap(a, b, percent: int):
    """Smallest intersection with ``100 * i >= percent * (a + b - i)``."""
    return -(-percent * (a + b) // (100 + percent))


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    """(ids, sorted distinct shingles of every row) per slice of texts."""
    for part in slices(batches):
        hashes, bounds = shingles(*text_bytes(part.column("text")), width)
        yield part.column("doc_id"), [np.unique(hashes[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]


def class_key(values: np.ndarray) -> int:
    """A 64-bit key of a set."""
    return int(mix64(values.sum(keepdims=True, dtype=np.uint64) * np.uint64(2 * len(values) + 1)).view(np.int64)[0])


def packed(values: np.ndarray) -> bytes:
    """The upper 48 bits of every hash (they are what is shuffled, and random bits do not compress)."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), dtype=np.uint8)
    out[:, 2:] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel().astype(np.uint64)


@lru_cache(maxsize=None)
def parts_for(most: int) -> int:
    """Parts for sets with up to ``most`` differences: the fewest (from 16 on) of which one stays without any, up to a
    chance of ``MISS``; ``most`` and some more where that takes more. About a seventh of the equal parts may be too small."""
    if most <= 0:
        return 0
    certain = 3 + most + most // 10
    low, high = min(16, certain), certain
    while low < high:  # the chance falls with the number of parts
        middle = (low + high) // 2
        if middle * math.log1p(-0.85 * math.exp(-most / middle)) <= math.log(MISS):
            high = middle
        else:
            low = middle + 1
    return low


def schemes(n: np.ndarray, percent: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(scheme, parts, differences, least) per set size for each scheme that a size may have (parts 0: none).

    Scheme c has the sizes from ``STEP**c`` to the largest that links with one below ``STEP**(c+1)``, so two linked
    sets have one in common. ``differences``: the most that a set has to a smaller or equal one linked with it (-1 where there
    are no more parts than that, so that chance decides). ``least``: the shingles from which a part counts.
    """
    c = np.floor(np.log(np.maximum(n, 1)) / math.log(STEP) + 1e-9).astype(np.int64)
    bound = 2 * (100 - percent)
    own = bound * n.astype(np.int64) // (100 + percent)
    out = []
    for scheme in (c - back for back in range(1 + math.ceil(math.log(100 / percent) / math.log(STEP)))):
        high = np.floor(STEP ** (scheme + 1.0) * (100 / percent) + 1e-6).astype(np.int64)
        most = np.where((n <= high) & (scheme >= 0), bound * high // (100 + percent), 0)
        parts = np.array([parts_for(m) for m in most.tolist()], dtype=np.int64)
        chance = parts <= most
        out.append((np.minimum(scheme, SCHEMES), parts, np.where(chance, -1, own), np.where(chance, SHARED, 1)))
    return out


def _parted(sets: list[np.ndarray], scheme: np.ndarray, parts: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signatures, row, parts in use per row) of the sets by their scheme (sets of 0 parts have none)."""
    rows = np.flatnonzero(parts)
    size = np.array([len(sets[r]) for r in rows], dtype=np.int64)
    ends = np.cumsum(parts[rows])
    used = np.zeros(len(sets), dtype=np.int64)
    if not len(rows):
        return np.empty(0, dtype=np.uint64), rows, used
    h = np.concatenate([sets[r] for r in rows])
    number = np.repeat(parts[rows].astype(np.uint64), size)
    place = ((h & np.uint64(0xFFFFFFFF)) * number >> np.uint64(32)).astype(np.int64) + np.repeat(ends - parts[rows], size)
    total = np.zeros(int(ends[-1]), dtype=np.uint64)
    np.add.at(total, place, mix64(h + np.uint64(0x9E3779B97F4A7C15)))
    row = np.repeat(rows, parts[rows])
    full = np.bincount(place, minlength=len(total)) >= least[row]
    part = np.arange(len(total)) - np.repeat(ends - parts[rows], parts[rows])
    mark = mix64(part.astype(np.uint64) * np.uint64(2 * SCHEMES + 1) + scheme[row].astype(np.uint64) + np.uint64(1))
    used += np.bincount(row[full], minlength=len(sets))
    return mix64(total[full] + mark[full]), row[full], used


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """``SKETCH`` bits per set, in words of 64: whether an odd number of its hashes falls on the bit."""
    out = np.zeros((len(sets), SKETCH // 64), dtype=np.uint64)
    if len(sets):
        bit = np.concatenate(sets) >> np.uint64(64 - SKETCH.bit_length() + 1)
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        np.bitwise_xor.at(out.reshape(-1), row * (SKETCH // 64) + (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    return out


_KEYED = "doc_id long, n int, key long, thin long, sketch binary"


def _keyed(width: int, percent: int):
    """Rows (doc_id, n, key, thin, sketch): the bits of ``thin`` are schemes in which the set has too few parts in use.

    A class has its sketch once per task (and where there are many classes, a few times).
    """

    def run(batches):
        told: set[int] = set()  # classes of this task; emptied when it grows large
        for ids, sets in _sets(batches, width):
            n = np.array([len(s) for s in sets], dtype=np.int64)
            thin = np.zeros(len(sets), dtype=np.int64)
            for scheme, parts, differences, least in schemes(n, percent):
                parts = np.where(differences < 0, 0, parts)
                few = (parts > 0) & (_parted(sets, scheme, parts, least)[2] <= differences)
                thin[few] |= np.int64(1) << scheme[few]
            keys = [class_key(s) if len(s) else None for s in sets]
            if len(told) > POSTED:
                told.clear()
            new = {key: row for row, key in enumerate(keys) if key is not None and key not in told}
            told.update(new)
            sketch: list[bytes | None] = [None] * len(sets)
            for row, bits in zip(new.values(), sketches([sets[row] for row in new.values()]), strict=True):
                sketch[row] = bits.tobytes()
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n.astype(np.int32)), pa.array(keys, pa.int64()), pa.array(thin), pa.array(sketch, pa.binary())],
                names=["doc_id", "n", "key", "thin", "sketch"])

    return run


def _signatures(width: int, percent: int, thin: int, wanted=None):
    """Rows (token, key, n): the signatures of every class, once per task, and prefixes in the schemes of ``thin``.

    ``wanted``: a broadcast bitmap (:func:`wanted_bits`) of the classes that post, by default all.
    """

    def run(batches):
        bits = None if wanted is None else wanted.value
        posted: set[int] = set()  # classes of this task, so copies post once; emptied when it grows large
        for _, sets in _sets(batches, width):
            if len(posted) > POSTED:
                posted.clear()
            new: dict[int, np.ndarray] = {}
            for s in sets:
                if len(s) and (key := class_key(s)) not in posted and (bits is None or _has(bits, key)):
                    new.setdefault(key, s)
            posted.update(new)
            sets = list(new.values())
            keys, n = np.array(list(new), dtype=np.int64), np.array([len(s) for s in sets], dtype=np.int64)
            for scheme, parts, _, least in schemes(n, percent) if sets else []:
                tokens, row, _ = _parted(sets, scheme, parts, least)
                for r in np.flatnonzero((parts > 0) & (thin >> scheme & 1 == 1)):
                    prefix = sets[r][: len(sets[r]) - -(-percent * len(sets[r]) // 100) + 1]
                    tokens = np.append(tokens, mix64(prefix + np.uint64(scheme[r] + 1)))
                    row = np.append(row, np.full(len(prefix), r))
                if len(tokens):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(tokens.view(np.int64)), pa.array(keys[row]), pa.array(n[row].astype(np.int32))], names=["token", "key", "n"])

    return run


_POSTED = "token long, key long, n int"


def _in_several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (token, key): those of tokens with several keys, equal rows once.

    One row is carried from batch to batch, however many rows a token has.
    """
    carried, told = np.empty((0, 3), dtype=np.int64), False
    for batch in batches:
        rows = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("token", "key", "n")], axis=1)
        rows = np.concatenate([carried, rows])
        new = np.ones(len(rows), dtype=bool)
        new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
        rows = rows[new]
        if not len(rows):
            continue
        same = rows[1:, 0] == rows[:-1, 0]
        several = np.append(same, False) | np.append(False, same)
        several[0] |= told  # the carried row's token has been found in several before
        out = several.copy()
        out[0] &= not told
        last_told = bool(several[-1])
        carried, told = rows[-1:], last_told
        rows = rows[out]
        if len(rows):
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[:, 0].copy()), pa.array(rows[:, 1].copy()), pa.array(rows[:, 2].astype(np.int32))], names=["token", "key", "n"])


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (token, key): rows (a, b) of the smallest key of a token and each other one."""
    token, first = None, 0  # of the last row
    for batch in _in_several(batches):
        tokens, keys = (batch.column(c).to_numpy() for c in ("token", "key"))
        new = np.append(tokens[0] != token, tokens[1:] != tokens[:-1])
        at = np.maximum.accumulate(np.where(new, np.arange(len(new)), -1))
        firsts = np.where(at < 0, first, keys[at])
        token, first = tokens[-1], firsts[-1]
        if not new.all():
            a, b = np.unique(np.stack([firsts[~new], keys[~new]]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(a.copy()), pa.array(b.copy())], names=["a", "b"])


_GROUPED = "group long, i int, j int, key long"


def _runs(batches: Iterator[pa.RecordBatch], names: list[str], by: int) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """(columns, starts of runs) of whole runs of rows equal in the first ``by`` columns, many runs at once.

    Columns are numbers, or bytes of ``SKETCH`` bits (as rows of words). The last run waits for the next batch.
    """

    def column(c: pa.Array) -> np.ndarray:
        if not pa.types.is_binary(c.type):
            return c.to_numpy(zero_copy_only=False)
        return np.frombuffer(b"".join(c.to_pylist()), dtype=np.uint64).reshape(-1, SKETCH // 64)

    held: list[list[np.ndarray]] = []  # parts of one run
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [column(batch.column(c)) for c in names]
        new = np.ones(batch.num_rows, dtype=bool)
        new[0] = not held or any(a[0] != b[-1] for a, b in zip(rows[:by], held[-1][:by], strict=True))
        new[1:] = np.any([c[1:] != c[:-1] for c in rows[:by]], axis=0)
        starts = np.flatnonzero(new)
        if not len(starts):
            held.append(rows)
            continue
        held.append([c[: starts[-1]] for c in rows])
        whole = [np.concatenate(c) for c in zip(*held, strict=True)]
        before = len(whole[0]) - starts[-1]
        if len(whole[0]):
            yield whole, np.unique(np.append(0, starts[:-1] + before))
        held = [[c[starts[-1] :] for c in rows]]
    if held:
        yield [np.concatenate(c) for c in zip(*held, strict=True)], np.zeros(1, dtype=np.int64)


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (token, key): rows (group, i, j, key) for the tokens with several keys.

    ``group`` depends on the keys only, so tokens with the same keys are one group. A group of more than
    ``GROUP_BLOCK`` keys is dealt into salts, of which every two meet in a block (i, j).
    """

    def rows(group, i, j, key):
        return pa.RecordBatch.from_arrays(
            [pa.array(group), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(key)], names=["group", "i", "j", "key"])

    for (_, keys), starts in _runs(_in_several(batches), ["token", "key"], 1):
        mixed = mix64(keys.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        size = np.diff(np.append(starts, len(keys)))
        group = mix64(np.add.reduceat(mixed, starts) + size.astype(np.uint64)).view(np.int64)
        small = np.repeat(size <= GROUP_BLOCK, size)
        zero = np.zeros(int(small.sum()), dtype=np.int32)
        yield rows(np.repeat(group, size)[small], zero, zero, keys[small])
        for at in np.flatnonzero(size > GROUP_BLOCK):
            own = slice(starts[at], starts[at] + size[at])
            salts = -(-size[at] // GROUP_BLOCK)
            salt = (mixed[own] % np.uint64(salts)).astype(np.int64)
            for other in range(salts):
                met = salt != other
                of = salt[met]
                yield rows(np.full(len(of), group[at]), np.minimum(of, other), np.maximum(of, other), keys[own][met])


def may_link(n: np.ndarray, bits: np.ndarray, x, y, percent: int) -> np.ndarray:
    """Whether the sizes and sketches of the sets ``x`` and ``y`` (places, or one place) leave a link possible."""
    a, b = n[x], n[y]
    most = a + b - 2 * required_overlap(a, b, percent)
    ok = np.minimum(a, b) * 100 >= np.maximum(a, b) * percent
    for words in (slice(0, FIRST // 64), slice(None)):
        at = np.flatnonzero(ok)
        p, q = (v if np.ndim(v) == 0 else v[at] for v in (x, y))
        ok[at] = np.bitwise_count(bits[p, words] ^ bits[q, words]).sum(axis=1, dtype=np.int64) <= most[at]
    return ok


def _alike(n: np.ndarray, bits: np.ndarray, percent: int) -> np.ndarray:
    """The component of every set, by the pairs that may link (:func:`may_link`); its number is one of its sets."""
    out = np.arange(len(n))
    rest = out.copy()  # in no component yet
    while len(rest) > 1:
        first, rest = rest[0], rest[1:]
        waiting = [first]
        while waiting and len(rest):
            near = may_link(n, bits, waiting.pop(), rest, percent)
            out[rest[near]] = first
            waiting += rest[near].tolist()
            rest = rest[~near]
    return out


def _compared(percent: int):
    """Of rows (group, i, j, key, n, sketch) sorted by (group, i, j): rows (a, b) that chain the classes of a block which may link."""

    def parts(batches):
        """Rows (token, key, n): a number for each component of a block, sorted."""
        number = 0
        for (_, _, _, keys, n, bits), starts in _runs(batches, ["group", "i", "j", "key", "n", "sketch"], 3):
            n = n.astype(np.int64)
            size = np.diff(np.append(starts, len(keys)))
            of = np.arange(len(keys))
            pairs = starts[size == 2]
            joined = pairs[may_link(n, bits, pairs, pairs + 1, percent)]
            of[joined + 1] = joined
            for a, k in zip(starts[size > 2].tolist(), size[size > 2].tolist(), strict=True):
                of[a : a + k] = a + _alike(n[a : a + k], bits[a : a + k], percent)
            order = np.lexsort((keys, of))
            yield pa.RecordBatch.from_arrays(
                [pa.array(of[order] + number), pa.array(keys[order]), pa.array(n[order].astype(np.int32))], names=["token", "key", "n"])
            number += len(keys)

    return lambda batches: _chain(parts(batches))


def _bitmap(bits: DataFrame, size: int, label: str) -> np.ndarray:
    """A bitmap of ``size`` bits with every ``bit`` (0 to size - 1) set.

    Aggregated on the executors, where the bits are dealt by their part of the bitmap; the
    result's size is fixed, whatever the number of rows.
    """
    one = F.col("bit") + 1
    dealt = bits.select(F.bitmap_bucket_number(one).alias("bucket"), F.bitmap_bit_position(one).alias("position")).repartition("bucket")
    parts = stored(dealt.groupBy("bucket").agg(F.bitmap_construct_agg("position").alias("bits")), label)
    out = np.zeros(size // 8, dtype=np.uint8)
    for row in parts.toLocalIterator():
        part = np.frombuffer(bytes(row["bits"]), dtype=np.uint8)
        out[(row["bucket"] - 1) * len(part) : row["bucket"] * len(part)] = part
    return out


def wanted_bits(keys: DataFrame) -> np.ndarray:
    """A bitmap of fixed size with the bits of the column ``key``: no key is missed, others may seem to be in it."""
    return _bitmap(keys.select(F.pmod("key", F.lit(FILTER_BITS)).alias("bit")), FILTER_BITS, "ngram-wanted")


def _has(bits: np.ndarray, key: int) -> bool:
    bit = key % FILTER_BITS
    return bool(bits[bit >> 3] >> (bit & 7) & 1)


def _whole_sets(width: int, wanted):
    """Sets of the documents whose class may be wanted (its bit is set), one row per class and task.

    A set goes as its hashes, or as its text (compressed) where that is shorter.
    """

    def run(batches):
        bits = wanted.value
        sent: set[int] = set()  # classes of this task, so copies are sent once; emptied when it grows large
        for part in slices(batches):
            hashes, bounds = shingles(*text_bytes(part.column("text")), width)
            found: dict[int, tuple[int, bytes]] = {}
            if len(sent) > POSTED:
                sent.clear()
            for row, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                values = np.unique(hashes[a:b])
                if len(values) and (key := class_key(values)) not in sent and _has(bits, key):
                    found[key] = row, packed(values)
            sent.update(found)
            members: list[bytes | None] = [m for _, m in found.values()]
            texts: list[bytes | None] = compressed(part.column("text").take(pa.array([r for r, _ in found.values()], pa.int64())))
            for k, (m, t) in enumerate(zip(members, texts, strict=True)):
                (texts if len(m) <= len(t) else members)[k] = None
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.int64()), pa.array(members, pa.binary()), pa.array(texts, pa.binary())], names=["key", "members", "packed"])

    return run


def _received(rows: pa.Table, width: int) -> list[np.ndarray]:
    """The sets of rows (members, packed), of 48-bit hashes."""
    sets = [None if m is None else unpacked(m) for m in rows["members"].to_pylist()]
    open_rows = [k for k, s in enumerate(sets) if s is None]
    for at, texts in decompressed([x for x in rows["packed"].to_pylist() if x is not None]):
        hashes, bounds = shingles(*text_bytes(texts), width)
        for k, a, b in zip(open_rows[at:], bounds, bounds[1:], strict=False):
            sets[k] = np.unique(hashes[a:b]) >> np.uint64(16) << np.uint64(16)
    return sets


# ---------------------------------------------------------------------------
# Signature tree
# ---------------------------------------------------------------------------


class Tree:
    """Levels of nodes over ``members`` sorted by size; level 0 holds the leaves."""

    def __init__(self, sets: list[np.ndarray], members: np.ndarray) -> None:
        self.members = members
        self.size = np.array([len(sets[m]) for m in members], dtype=np.int64)
        self.bitmap = np.zeros((len(members), BITS // 64), dtype=np.uint64)
        most = np.zeros(len(members), dtype=np.int64)
        for row, m in enumerate(members):
            bit, count = np.unique(sets[m] >> np.uint64(64 - BITS.bit_length() + 1), return_counts=True)
            np.bitwise_or.at(self.bitmap[row], (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
            most[row] = count.max(initial=0)
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        signature, low, high, step = self.bitmap, self.size, self.size, LEAF
        while True:
            cut = np.arange(0, len(low), step)
            signature = np.bitwise_or.reduceat(signature, cut, axis=0)
            low, high, most = np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut), np.maximum.reduceat(most, cut)
            self.levels.append((signature, low, high, most))
            if len(low) == 1:
                return
            step = FANOUT

    def span(self, level: int, node: int) -> tuple[int, int]:
        width = LEAF * FANOUT**level
        return node * width, min(len(self.members), (node + 1) * width)


def tree_join(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray | None, percent: int, root: np.ndarray) -> list[tuple[int, int]]:
    """Spanning links between the sets of ``left`` and ``right`` (or within ``left``).

    ``root`` holds the component of every set found so far and is updated: a pair in one
    component is not looked at. Every component that links among these pairs make is found.
    """

    def order(m: np.ndarray) -> np.ndarray:
        return m[np.lexsort(([sets[x][0] for x in m], [len(sets[x]) for x in m]))]

    a = Tree(sets, order(left))
    b = a if right is None else Tree(sets, order(right))
    found: list[tuple[int, int]] = []

    def near(la: int, i: int, lb: int, j: int) -> bool:
        """Whether the largest possible overlap of the nodes reaches the smallest required one."""
        (sa, lo_a, hi_a, m_a), (sb, lo_b, hi_b, m_b) = a.levels[la], b.levels[lb]
        if 100 * hi_a[i] < percent * lo_b[j] or 100 * hi_b[j] < percent * lo_a[i]:
            return False
        shared = int(np.bitwise_count(sa[i] & sb[j]).sum()) * int(min(m_a[i], m_b[j]))
        return min(shared, int(hi_a[i]), int(hi_b[j])) >= required_overlap(int(lo_a[i]), int(lo_b[j]), percent)

    def leaves(i: int, j: int) -> None:
        (a0, a1), (b0, b1) = a.span(0, i), b.span(0, j)
        for x in range(a0, a1):
            first = max(b0, x + 1) if b is a else b0
            mx = a.members[x]
            rows = np.arange(first, b1)
            rows = rows[root[b.members[rows]] != root[mx]]
            if not len(rows):
                continue
            n, m = a.size[x], b.size[rows]
            need = required_overlap(n, m, percent)
            own, other = a.bitmap[x], b.bitmap[rows]
            overlap = np.minimum(n - np.bitwise_count(own & ~other).sum(axis=1), m - np.bitwise_count(other & ~own).sum(axis=1))
            for y, least in zip(b.members[rows[overlap >= need]], need[overlap >= need], strict=True):
                if root[y] != root[mx] and len(np.intersect1d(sets[mx], sets[y], assume_unique=True)) >= least:
                    found.append((int(mx), int(y)))
                    old, new = max(root[mx], root[y]), min(root[mx], root[y])
                    root[root == old] = new

    def one_component(la: int, i: int, lb: int, j: int) -> bool:
        (a0, a1), (b0, b1) = a.span(la, i), b.span(lb, j)
        first = root[a.members[a0]]
        return bool((root[a.members[a0:a1]] == first).all() and (root[b.members[b0:b1]] == first).all())

    waiting = [(len(a.levels) - 1, 0, len(b.levels) - 1, 0)]
    while waiting:
        la, i, lb, j = waiting.pop()
        if one_component(la, i, lb, j) or not near(la, i, lb, j):
            continue
        if la == lb == 0:
            leaves(i, j)
        elif b is a and la == lb and i == j:
            children = range(i * FANOUT, min((i + 1) * FANOUT, len(a.levels[la - 1][1])))
            waiting += [(la - 1, p, la - 1, q) for p in children for q in children if p <= q]
        elif la >= lb:
            waiting += [(la - 1, p, lb, j) for p in range(i * FANOUT, min((i + 1) * FANOUT, len(a.levels[la - 1][1])))]
        else:
            waiting += [(la, i, lb - 1, q) for q in range(j * FANOUT, min((j + 1) * FANOUT, len(b.levels[lb - 1][1])))]
    return found


def _joined(percent: int, width: int):
    def run(batches):
        for rows in by_key(batches, ["forest", "i", "j"]):
            keys, at = np.unique(rows["key"].to_numpy(), return_index=True)  # a class comes once per task that met it
            if len(keys) < 2:
                continue
            salt = rows["salt"].to_numpy()[at]
            sets = _received(rows.select(["members", "packed"]).take(pa.array(at)), width)
            i, j = rows["i"][0].as_py(), rows["j"][0].as_py()
            root = np.arange(len(sets))
            if i == j:
                links = tree_join(sets, np.arange(len(sets)), None, percent, root)
            else:
                left, right = np.flatnonzero(salt == i), np.flatnonzero(salt == j)
                links = tree_join(sets, left, right, percent, root) if len(left) and len(right) else []
            if links:
                x, y = np.array(links, dtype=np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(keys[x]), pa.array(keys[y])], names=["a", "b"])

    return run


# ---------------------------------------------------------------------------
# The join
# ---------------------------------------------------------------------------


def _placing(inside: DataFrame, block: int) -> DataFrame:
    """``(forest, class, base, chunks, near)``: the salts of a forest's size class, from ``base`` on, and those it meets.

    A forest that fits one block is one chunk; in a larger one only equal and neighbouring
    size classes meet, so a set is copied for their chunks, not for all of the forest.
    """

    def parts(held, total):
        return F.greatest(F.ceil(held / F.lit(block)), F.ceil(total / F.lit(BLOCK_SHINGLES))).cast("long")

    sizes = stored(inside.groupBy("forest", "class").agg(F.count(F.lit(1)).alias("held"), F.sum("n").alias("total")), "ngram-sizes")
    whole = sizes.groupBy("forest").agg(parts(F.sum("held"), F.sum("total")).alias("whole"))
    single = F.col("whole") == 1
    own = sizes.join(whole, "forest").select(
        "forest", "class", single.alias("single"),
        F.when(single, F.lit(0)).otherwise(F.col("class") * MOST_CHUNKS).cast("long").alias("base"),
        F.when(single, F.lit(1)).otherwise(parts(F.col("held"), F.col("total"))).cast("long").alias("chunks"))
    met = F.when(F.col("single"), F.array("class")).otherwise(F.array(F.col("class") - 1, F.col("class"), F.col("class") + 1))
    near = own.select("forest", F.explode(met).alias("class"), F.struct("base", "chunks").alias("part"))
    near = near.groupBy("forest", "class").agg(F.collect_list("part").alias("near"))  # three at most
    return own.join(near, ["forest", "class"]).select("forest", "class", "base", "chunks", "near")


def ngram_components(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` per row: the smallest ``doc_id`` reachable by links."""
    docs = docs.select("doc_id", "text")
    sizes, thin = keyed_sets(docs, width, percent)
    return verified_components(docs, sizes, docs.mapInArrow(_signatures(width, percent, thin), _POSTED), width, percent)


def in_several(posted: DataFrame) -> DataFrame:
    """The rows of ``posted(token, key, n)`` whose token has several keys, equal ones once."""
    return by_token(posted).mapInArrow(_in_several, _POSTED)


def by_token(posted: DataFrame) -> DataFrame:
    """The rows of a token together, sorted by (token, key)."""
    parts = int(posted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return posted.repartition(parts, "token").sortWithinPartitions("token", "key")


def keyed_sets(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, int]:
    """``(doc_id, n, key, sketch)`` per document, and the schemes in which some set has too few parts in use."""
    sizes = stored(docs.mapInArrow(_keyed(width, percent), _KEYED), "ngram-keyed")
    return sizes.drop("thin"), sizes.agg(F.bit_or("thin")).first()[0] or 0


def chained(posted: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """``(a, b)``: chains of the classes that share a token and whose sketches leave a link possible."""
    parts = int(posted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = stored(by_token(posted).mapInArrow(_grouped, _GROUPED).distinct(), "ngram-groups")
    held = sizes.where("sketch IS NOT NULL").join(groups.select("key").distinct(), "key", "left_semi")
    held = held.groupBy("key").agg(F.max("n").alias("n"), F.max("sketch").alias("sketch"))  # a class comes once per task that met it
    blocks = groups.join(held, "key").select("group", "i", "j", "key", "n", "sketch")
    blocks = blocks.repartition(parts, "group", "i", "j").sortWithinPartitions("group", "i", "j")
    return blocks.mapInArrow(_compared(percent), "a long, b long")


def verified_components(docs: DataFrame, sizes: DataFrame, posted: DataFrame, width: int, percent: int) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` per row of ``sizes(doc_id, n, key, sketch)``.

    ``posted(token, key, n)``: what brings classes of sets together; two classes that may link share a token.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    # forests: classes that share a token and may link, chained
    chain = chained(posted, sizes, percent)
    width_of_class = -math.log(percent / 100) * 1.000001
    forests = connected_components(chain, "ngram-forests").select(F.col("node").alias("key"), F.col("component").alias("forest"))

    # the smallest document of every class, and the classes in forests
    classes = stored(sizes.where("key IS NOT NULL").groupBy("key")
                     .agg(F.min("doc_id").alias("first_id"), F.max("n").alias("n")).where("first_id IS NOT NULL"), "ngram-classes")
    inside = stored(classes.join(forests, "key"), "ngram-inside")
    block = max(LEAST_BLOCK, min(BLOCK, inside.count() // max(1, parts)))
    inside = inside.withColumn("class", F.floor(F.log(F.col("n").cast("double")) / F.lit(width_of_class)))
    placing = stored(_placing(inside, block), "ngram-placing")
    inside = inside.join(placing, ["forest", "class"]).select(
        "key", "forest", "near", (F.col("base") + F.pmod(F.xxhash64("key"), F.col("chunks"))).alias("salt"))
    inside = stored(inside, "ngram-inside")
    wanted = spark.sparkContext.broadcast(wanted_bits(inside))
    sets = docs.mapInArrow(_whole_sets(width, wanted), "key long, members binary, packed binary")
    placed = sets.join(inside, "key")
    others = F.flatten(F.transform("near", lambda x: F.sequence(x["base"], x["base"] + x["chunks"] - 1)))
    blocks = placed.select("key", "members", "packed", "forest", "salt", F.explode(others).alias("other")).select(
        "key", "members", "packed", "forest", "salt", F.least("salt", "other").alias("i"), F.greatest("salt", "other").alias("j"))
    blocks = blocks.repartition(parts, F.xxhash64("forest", "i", "j")).sortWithinPartitions("forest", "i", "j")
    links = stored(blocks.mapInArrow(_joined(percent, width), "a long, b long"), "ngram-links")

    # components of classes, named by their smallest document, and back to the documents
    joined = connected_components(links, "ngram-components")
    named = joined.join(classes, joined.node == classes.key).select("node", "component", "first_id")
    named = stored(named, "ngram-named")
    smallest = stored(named.groupBy("component").agg(F.min("first_id").alias("component_id")), "ngram-smallest")
    named = named.join(smallest, "component").select(F.col("node").alias("key"), "component_id")
    classes = stored(classes.select("key", "first_id").join(named, "key", "left")
                     .select("key", F.coalesce("component_id", "first_id").alias("component_id")), "ngram-classes")
    of = classes.select(F.col("key").alias("class"), "component_id")
    out = sizes.join(of, sizes.key == of["class"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), own.alias("component_id"))


def keep_one_of_each(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """The documents without those linked, directly or not, to one with a smaller ``doc_id``.

    All columns are kept; rows of one ``doc_id`` stay or go together; rows without an id stay.
    """
    found = ngram_components(docs, width, percent).where("component_id < doc_id").select("doc_id").distinct()
    return docs.join(stored(found, "ngram-dropped"), "doc_id", "left_anti").select(*docs.columns)
