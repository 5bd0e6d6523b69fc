"""Periodic runs of words: Kruskal's algorithm over common prefixes of suffixes, by decreasing length.

A run is a stretch of consecutive words whose smallest period q it repeats at least ``times`` times, of at
least ``least`` words, that neither neighbour extends with period q.

Within a text, suffixes (one per word) with a common prefix of L words form classes. The pairs of neighbours
in suffix order, taken by decreasing common prefix, unite classes as edges unite trees; a class keeps its
positions in order (:class:`Positions`), and the smaller one is put into the larger. Two positions that become adjacent
by a union have a common prefix of exactly L words; at a distance d <= L they seed a stretch of period d and
length d + L, which no word extends to the right. With ``times`` >= 3 the stretch is a run if no word extends it to the left
and it is long enough: a smaller period would have put another position of the class between
the two, and both ends of every run become adjacent in this way.

A run of period q has suffixes with a common prefix of ``max(least - q, (times - 1) * q)`` words at its
start, so only prefixes of some minimum length ("seed", 16 words for 24 words and 3 times) matter. Texts
in which no sequence of that many words comes twice (by 64-bit hashes, so none is missed) have no run and are done.

Each text is worked on alone, in one task; the suffix order is found by prefix doubling among the positions
that are still tied, so memory is linear in the words of the longest text times the doublings it needs.

Defined cases: null text has no words, no runs and an empty collapsed text; rows are kept one to one,
repeated rows get equal results, a null id is kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import shingles, slices, text_bytes, utf8

LEAST, TIMES = 24, 3
#: Positions in one list of a class; a fuller list is halved.
CHUNK = 2048

# ---------------------------------------------------------------------------
# Suffixes
# ---------------------------------------------------------------------------


def suffix_order(words: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, common): the suffixes that share ``seed`` words with another, in suffix order, and the
    number of words each shares with the next one (0 at the end of a class)."""
    n = len(words)
    order = np.argsort(words, kind="stable")
    new = np.ones(n, dtype=bool)
    new[1:] = words[order[1:]] != words[order[:-1]]
    rank = np.empty(n, dtype=np.int32)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))  # the first place of the class
    levels, width, tied = [rank], 1, np.empty(0, dtype=np.int64)
    while True:
        size = np.bincount(rank, minlength=n)
        active = np.flatnonzero(size[rank] > 1)
        if width <= seed:
            tied = active
        if not len(active):
            break
        behind = active + width
        second = np.where(behind < n, rank[np.minimum(behind, n - 1)], -1)
        first = rank[active]
        order = np.lexsort((second, first))
        a, b, at = first[order], second[order], np.arange(len(active))
        group, part = np.ones(len(a), dtype=bool), np.ones(len(a), dtype=bool)
        group[1:] = a[1:] != a[:-1]
        part[1:] = group[1:] | (b[1:] != b[:-1])
        place = np.maximum.accumulate(np.where(part, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
        rank = rank.copy()
        rank[active[order]] = a + place
        levels.append(rank)
        width *= 2
    order = tied[np.argsort(rank[tied], kind="stable")]
    common = np.zeros(len(order), dtype=np.int64)
    left, right = order[:-1], order[1:]
    for level in range(len(levels) - 1, -1, -1):
        x, y = left + common[:-1], right + common[:-1]
        inside = (x < n) & (y < n)
        same = inside & (levels[level][np.minimum(x, n - 1)] == levels[level][np.minimum(y, n - 1)])
        common[:-1] += same.astype(np.int64) << level
    common[common < seed] = 0
    return order, common


class Positions:
    """An ordered set of integers in lists of bounded length."""

    __slots__ = ("lists", "size")

    def __init__(self, first: int) -> None:
        self.lists, self.size = [[first]], 1

    def __iter__(self) -> Iterator[int]:
        for part in self.lists:
            yield from part

    def _list_of(self, x: int) -> int:
        if len(self.lists) == 1:
            return 0
        return min(bisect_left(self.lists, x, key=lambda part: part[-1]), len(self.lists) - 1)

    def around(self, x: int) -> tuple[int, int]:
        """The neighbours of ``x`` (not in the set); -1 where there is none."""
        k = self._list_of(x)
        part = self.lists[k]
        at = bisect_left(part, x)
        before = part[at - 1] if at else self.lists[k - 1][-1] if k else -1
        after = part[at] if at < len(part) else -1
        return before, after

    def add(self, x: int) -> None:
        k = self._list_of(x)
        part = self.lists[k]
        insort(part, x)
        self.size += 1
        if len(part) > CHUNK:
            self.lists[k : k + 1] = [part[: CHUNK // 2], part[CHUNK // 2 :]]


def adjacent_pairs(order: np.ndarray, common: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(i, j, L) for all positions i < j that a union at common prefix L makes adjacent in their class."""
    place = {p: k for k, p in enumerate(order.tolist())}
    parent = list(range(len(place)))
    sets: list[Positions | None] = [Positions(p) for p in place]
    edges = np.flatnonzero(common)
    for edge in edges[np.argsort(-common[edges], kind="stable")].tolist():
        roots = []
        for k in (edge, edge + 1):
            while parent[k] != k:
                parent[k] = parent[parent[k]]
                k = parent[k]
            roots.append(k)
        large, small = roots if sets[roots[0]].size >= sets[roots[1]].size else roots[::-1]
        shared, into, moved = int(common[edge]), sets[large], list(sets[small])
        last = len(moved) - 1
        for k, x in enumerate(moved):
            before, after = into.around(x)
            if before >= 0 and (k == 0 or moved[k - 1] < before):
                yield before, x, shared
            if after >= 0 and (k == last or moved[k + 1] > after):
                yield x, after, shared
        for x in moved:
            into.add(x)
        parent[small], sets[small] = large, None


def runs_of(words: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence of integers, by start and period."""
    if times < 3:
        raise ValueError("runs of fewer than three periods are not found by adjacent positions")
    seed = shortest_seed(least, times)
    if len(words) < max(least, times):
        return []
    order, common = suffix_order(words, seed)
    found = []
    for i, j, shared in adjacent_pairs(order, common):
        period = j - i
        if period + shared >= max(least, times * period) and (i == 0 or words[i - 1] != words[j - 1]):
            found.append((i, period + shared, period))
    return sorted(found, key=lambda run: (run[0], run[2]))


def shortest_seed(least: int, times: int) -> int:
    """The least common prefix of the two first suffixes of any run."""
    return max(1, min(max(least - q, (times - 1) * q) for q in range(1, max(least, 1) + 1)))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Whether each of n words stays: none behind the first period of a run does."""
    change = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


# ---------------------------------------------------------------------------
# Texts
# ---------------------------------------------------------------------------


def _with_repeats(column: pa.Array, seed: int) -> np.ndarray:
    """Whether some sequence of ``seed`` words comes twice in a text (or seems to, by its hash)."""
    made, bounds = shingles(*text_bytes(column), seed)
    row = np.repeat(np.arange(len(column)), np.diff(bounds))
    order = np.lexsort((made, row))
    made, row = made[order], row[order]
    out = np.zeros(len(column), dtype=bool)
    out[row[1:][(made[1:] == made[:-1]) & (row[1:] == row[:-1])]] = True
    return out


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``(doc_id, runs, collapsed)``: the runs by start and period, and the words that stay joined by blanks."""
    seed = shortest_seed(least, times)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            column = utf8(part.column("text"))
            found, collapsed = [], []
            for text, repeats in zip(column.to_pylist(), _with_repeats(column, seed), strict=True):
                words = text.encode().split()  # at blanks and tab..CR
                runs: list[tuple[int, int, int]] = []
                if repeats:
                    number: dict[bytes, int] = {}
                    runs = runs_of(np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int32), least, times)
                    words = [words[k] for k in np.flatnonzero(kept_words(len(words), runs))] if runs else words
                found.append(runs)
                collapsed.append(b" ".join(words).decode())
            flat = np.array([r for runs in found for r in runs], dtype=np.int64).reshape(-1, 3)
            offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
            structs = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], names=["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), structs), pa.array(collapsed, pa.string())],
                names=["doc_id", "runs", "collapsed"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")


def run_digest(found: DataFrame) -> DataFrame:
    """Per document: number of runs, its run of most periods, and digests of runs and collapsed text."""

    def better(best: Column, x: Column) -> Column:
        # exact: length / period against length / period, in decimals; earlier runs win ties
        more = x["length"].cast("decimal(19)") * best["period"] > best["length"].cast("decimal(19)") * x["period"]
        return F.when(best.isNull() | more, x).otherwise(best)

    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    best = F.aggregate("runs", none, better)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    milli = F.expr("(1000 * best.length) div best.period")
    return rows.select("doc_id", "n_runs", "best.start", "best.length", "best.period", milli.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """The texts of ``docs`` with repeats in a tenth of the documents, chosen and placed by ``crc32(doc_id)``.

    With h the checksum of the decimal id, g = floor(h / 10) and n words: if h is a multiple of ten, words from
    a = g mod n on repeat the p = 1 + floor((n - a) / (3 + g mod 8)) first of them, over and over.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                g, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
                if doc_id is not None and rest == 0 and text:
                    words = text.encode().split()
                    if n := len(words):
                        a = g % n
                        p = 1 + (n - a) // (3 + g % 8)
                        block = words[a : a + p]
                        text = b" ".join(words[:a] + (block * -(-(n - a) // p))[: n - a]).decode()
                texts.append(text)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, text string")
