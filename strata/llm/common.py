"""Helpers shared by the operators: stored intermediate tables, text batches, word
shingles and connected components."""

from __future__ import annotations

import ctypes
import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import checkpoint_root

#: Text handled at once by one call of the vectorised code (a longer text is handled alone).
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name below the session's shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/strata-llm/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet below the shared checkpoint folder and read back, so
    that later steps start from files every executor can read again."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """Rows kept out of training: crc32 of the decimal id leaves 2 modulo 4 (a null id is not held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def unit_hash(*cols: Column) -> Column:
    """A hash of the columns, spread evenly over [0, 1)."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 40)) / float(1 << 40)


# ---------------------------------------------------------------------------
# Text batches
# ---------------------------------------------------------------------------


def utf8(column: pa.Array) -> pa.Array:
    """The column as contiguous strings with 64-bit offsets, nulls as empty strings."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def give_back() -> None:
    """Return freed memory of Arrow and, where the C library can, of numpy to the system.

    Python workers outlive their tasks, and both keep what a task has freed; the next one may not need it.
    """
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES, rows: int | None = None) -> Iterator[pa.RecordBatch]:
    """Row ranges of the batches whose texts hold at most ``limit`` bytes (and which have at most ``rows`` rows), or one row.

    What the work on a batch has freed goes back to the system before the next one, and at the end.
    """
    for batch in batches:
        give_back()
        if not batch.num_rows:
            continue
        size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64))
        at = 0
        while at < batch.num_rows:
            base = size[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(size, base + limit, "right")))
            end = end if rows is None else min(end, at + rows)
            yield batch.slice(at, end - at)
            at = end
    give_back()


def compressed(texts: pa.Array) -> list[bytes]:
    """Each text (null: empty) as a zstandard frame, for a shuffle."""
    pack = zstandard.ZstdCompressor(level=3).compress
    return [pack(x) for x in utf8(texts).cast(pa.large_binary()).to_pylist()]


def decompressed(frames: list[bytes]) -> Iterator[tuple[int, pa.Array]]:
    """(place of the first, texts) of :func:`compressed` frames, at most ``SLICE_BYTES`` of text at once, or one text."""
    unpack, at, texts, size = zstandard.ZstdDecompressor().decompress, 0, [], 0
    for place, frame in enumerate(frames):
        text = unpack(frame)
        if texts and size + len(text) > SLICE_BYTES:
            yield at, pa.array(texts, pa.large_binary()).cast(pa.large_string())
            at, texts, size = place, [], 0
        texts.append(text)
        size += len(text)
    if texts:
        yield at, pa.array(texts, pa.large_binary()).cast(pa.large_string())


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column: row i is ``bytes[offsets[i]:offsets[i + 1]]``."""
    column = utf8(column)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


# ---------------------------------------------------------------------------
# Words and shingles
# ---------------------------------------------------------------------------

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint64) + np.uint64(1)
_FOLD[ord("A") : ord("Z") + 1] += np.uint64(32)
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: list[np.ndarray] = []


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (in place)."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        _POWERS[:] = [
            np.multiply.accumulate(np.append(np.uint64(1), np.full(size - 1, b, dtype=np.uint64)), dtype=np.uint64)
            for b in (_BASE, pow(_BASE, -1, 1 << 64))
        ]
    return _POWERS[0][:n], _POWERS[1][:n]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte ranges of the words (runs without space or tab..CR),
    and the index of each row's first word, with the number of words at the end."""
    if not len(data):
        empty = np.empty(0, dtype=np.int64)
        return empty, empty, np.zeros(len(offsets), dtype=np.int64)
    space = _SPACE[data]
    before = np.empty(len(data), dtype=bool)
    before[0] = True
    before[1:] = space[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    before[inner] = True
    after = np.empty(len(data), dtype=bool)
    after[-1] = True
    after[:-1] = space[1:]
    after[inner - 1] = True
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words with A-Z lower-cased: a polynomial over the bytes modulo
    2**64 (from one running sum over all bytes), scrambled."""
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    power, inverse = _powers(len(data))
    running = np.empty(len(data) + 1, dtype=np.uint64)
    running[0] = 0
    np.cumsum(_FOLD[data] * power, out=running[1:])
    return mix64((running[ends] - running[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def shingles(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): 64-bit hashes of all ``width``-word shingles, repeats included;
    row i has ``hashes[bounds[i]:bounds[i + 1]]``. A row of fewer words has one shingle, its
    whole word sequence; a row without words has none."""
    starts, ends, first = word_bounds(data, offsets)
    words = word_hashes(data, starts, ends)
    count = np.diff(first)
    made = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    bounds = np.concatenate([[0], np.cumsum(made)])
    out = np.empty(bounds[-1], dtype=np.uint64)
    factor = np.uint64(0xD1B54A32D192ED03)
    if len(words) >= width:
        acc = words[: len(words) - width + 1].copy()
        for j in range(1, width):
            acc *= factor
            acc += words[j : len(words) - width + 1 + j]
        long = np.flatnonzero(count >= width)
        if len(long):
            at = np.repeat(first[:-1][long] - bounds[:-1][long], made[long]) + ranges(bounds[:-1][long], made[long])
            out[ranges(bounds[:-1][long], made[long])] = acc[at]
    for n in range(1, width):
        rows = np.flatnonzero(count == n)
        if len(rows):
            acc = words[first[rows]].copy()
            for j in range(1, n):
                acc *= factor
                acc += words[first[rows] + j]
            out[bounds[rows]] = acc + np.uint64(n)
    return mix64(out), bounds


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The integers of all ranges ``[starts[i], starts[i] + lengths[i])``, one after another."""
    total = int(lengths.sum())
    out = np.ones(total, dtype=np.int64)
    if total:
        at = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        keep = lengths > 0
        at, first, last = at[keep], starts[keep], starts[keep] + lengths[keep] - 1
        out[at[0]] = first[0]
        out[at[1:]] = first[1:] - last[:-1]
    return np.cumsum(out)


# ---------------------------------------------------------------------------
# Connected components
# ---------------------------------------------------------------------------


def connected_components(links: DataFrame, label: str = "components") -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``: the smallest node reachable.

    Every round gives each node its smallest neighbour (or itself) as a label, follows the labels' own labels
    to the end (chains shrink by doubling), and goes on with the links between different labels, of
    which at most half as many nodes are left. Rounds are written
    below the checkpoint folder; a node's many neighbours are folded by partial aggregation
    and its rows in the joins can be split.
    """

    def ordered(a: Column, b: Column) -> list[Column]:
        return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]

    links = stored(links.select(*ordered(F.col("a"), F.col("b"))).where("a < b").distinct(), f"{label}-links")
    if links.isEmpty():
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    rounds = []
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("component"))
        labels, moved = stored(labels, label), True
        while moved:
            up = labels.select(F.col("node").alias("root"), F.col("component").alias("above"))
            labels = stored(labels.join(up, labels.component == up.root).select(
                "node", F.col("above").alias("component"), (F.col("above") < F.col("component")).alias("moved")), label)
            moved = not labels.where("moved").isEmpty()
            labels = labels.select("node", "component")
        rounds.append(labels)
        of_a, of_b = (labels.select(F.col("node").alias(f"node_{x}"), F.col("component").alias(f"of_{x}")) for x in "ab")
        links = links.join(of_a, F.col("a") == F.col("node_a")).join(of_b, F.col("b") == F.col("node_b"))
        links = stored(links.select(*ordered(F.col("of_a"), F.col("of_b"))).where("a < b").distinct(), f"{label}-links")
    out = rounds.pop()
    while rounds:  # labels of the earlier rounds, by what became of them
        earlier, up = rounds.pop(), out.select(F.col("node").alias("root"), F.col("component").alias("above"))
        out = stored(earlier.join(up, earlier.component == up.root, "left").select("node", F.coalesce("above", "component").alias("component")), label)
    return out


def by_key(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of a partition sorted by ``keys``, one table per key (only one key is held at a time)."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k) for k in keys]
        change = np.zeros(batch.num_rows, dtype=bool)
        for c in columns:
            v = c.to_numpy(zero_copy_only=False)
            change[1:] |= v[1:] != v[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            key = tuple(c[a].as_py() for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)
