"""Vector code compression: product codes of integer vectors, found by an equal-average search.

Each component x becomes the integer floor(scale * x). Vectors are cut into ``parts`` consecutive
parts; each part position has a codebook of at most ``entries`` integer entries. A vector's code is
the number of the nearest entry (squared Euclidean distance, ties to the lower number) for each part.
Codebooks start as the parts of the vectors of the smallest ids; each round assigns all parts and
replaces every used entry by the componentwise floor of the mean of its parts.

The search (:func:`nearest`): entries are sorted by the sum of their components. By the
inequality of Cauchy and Schwarz the squared distance is at least the squared gap of the sums over the
number of components, so a search expands outward from the part's own sum, the nearer side first, and
stops once that bound strictly exceeds the best distance. All in integers: no ties are lost.

Every round reads the vectors once, in tasks that hold one batch and one table of sums; tasks return
sums and counts per entry (a bounded number of rows), which Spark adds up. Only codebooks
(``entries`` times the dimension) reach the driver.

Defined cases: rows whose vector is null or holds null or non-finite components are dropped; so are
vectors whose length is not the commonest one (ties: the shorter), as they have no parts
in common with the others; lengths that ``parts`` does not divide have first parts one longer; empty
vectors have code 0 and error 0. Integers saturate at :func:`largest`, where squared distances would leave 64 bits.
Null ids sort behind all others, rows of one id by their vectors. Rows are kept one to one,
repeated rows get equal codes; an empty table gives no rows and empty codebooks; other columns than
``vec_id``, ``label`` and ``embedding`` are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
BATCH = 8192


def largest(dim: int, parts: int) -> int:
    """The bound of integers for which all distances and squared gaps of sums fit in 62 bits."""
    return (1 << 30) // max(1, -(-dim // parts), math.isqrt(max(dim - 1, 0)) + 1)


def integers(column: pa.Array, dim: int, parts: int, scale: float) -> np.ndarray:
    """The vectors of a list column (all of length ``dim``, without nulls) as rows of integers."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    most = float(largest(dim, parts))
    with np.errstate(over="ignore"):
        return np.clip(np.floor(values * scale), -most, most).astype(np.int64).reshape(len(column), dim)


def cuts(dim: int, parts: int) -> list[slice]:
    """The parts' places within a vector."""
    size = [dim // parts + (p < dim % parts) for p in range(parts)]
    ends = np.cumsum(size).tolist()
    return [slice(end - n, end) for n, end in zip(size, ends, strict=True)]


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the nearest entry of ``book`` for every row of ``x``."""
    n, width = x.shape
    if not width:
        return np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    total = book.sum(axis=1)
    order = np.argsort(total, kind="stable")
    total, sorted_book, own = total[order], book[order], x.sum(axis=1)
    best = np.full(n, (1 << 62) // width, dtype=np.int64)
    number = np.full(n, len(book), dtype=np.int64)
    above = np.searchsorted(total, own)
    below = above - 1
    row, none = np.arange(n), (1 << 31) + 1
    while len(row):
        down = np.where(below >= 0, own[row] - total[np.maximum(below, 0)], none)
        up = np.where(above < len(book), total[np.minimum(above, len(book) - 1)] - own[row], none)
        gap = np.minimum(down, up)
        go = gap * gap <= best[row] * width
        if not go.all():
            row, below, above, down, up = row[go], below[go], above[go], down[go], up[go]
        lower = down <= up
        place = np.where(lower, below, above)
        apart = x[row] - sorted_book[place]
        distance, entry = np.einsum("ij,ij->i", apart, apart), order[place]
        better = (distance < best[row]) | ((distance == best[row]) & (entry < number[row]))
        best[row[better]], number[row[better]] = distance[better], entry[better]
        below = below - lower
        above = above + ~lower
    return number, best


def _assigned(batches: Iterator[pa.RecordBatch], books: list[np.ndarray], dim: int, scale: float):
    """Per block of at most ``BATCH`` rows: (rows, their integers, numbers and distances per part)."""
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            rows = batch.slice(at, BATCH)
            x = integers(rows.column("embedding"), dim, len(books), scale)
            found = [nearest(x[:, cut], book) for cut, book in zip(cuts(dim, len(books)), books, strict=True)]
            yield rows, x, found


def _sums(books: list[np.ndarray], dim: int, scale: float):
    """Sums and counts (position -1) of the parts assigned to each entry, added up within a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((len(books), len(books[0])), dtype=np.int64)
        total = [np.zeros_like(book) for book in books]
        for _, x, found in _assigned(batches, books, dim, scale):
            for p, (cut, (number, _)) in enumerate(zip(cuts(dim, len(books)), found, strict=True)):
                count[p] += np.bincount(number, minlength=count.shape[1])
                np.add.at(total[p], number, x[:, cut])
        for p, part in enumerate(total):
            entry = np.flatnonzero(count[p])
            both = np.concatenate([count[p][entry, None], part[entry]], axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(both.size, p, dtype=np.int32)), pa.array(np.repeat(entry, both.shape[1]).astype(np.int32)),
                 pa.array(np.tile(np.arange(-1, part.shape[1], dtype=np.int32), len(entry))), pa.array(both.ravel())],
                names=["part", "entry", "position", "total"],
            )

    return run


def _codes(books: list[np.ndarray], dim: int, scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _, found in _assigned(batches, books, dim, scale):
            number = np.stack([n for n, _ in found], axis=1)
            digits = 2 if len(books[0]) <= 256 else 4
            code = [row.tobytes().hex() for row in number.astype(">u1" if digits == 2 else ">u2")]
            error = np.sum([d for _, d in found], axis=0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [rows.column("vec_id"), rows.column("label"), pa.array(code, pa.string()), pa.array(error)],
                names=["vec_id", "label", "code", "error"])

    return run


def kept_vectors(vectors: DataFrame) -> tuple[DataFrame, int]:
    """``(vec_id, label, embedding)`` of the rows that are coded, and their vectors' length."""
    rows = vectors.select("vec_id", "label", "embedding")
    fine = F.forall("embedding", lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False)))
    rows = rows.where(F.coalesce(fine, F.lit(False)))
    common = rows.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    dim = common["dim"] if common else 0
    return rows.where(F.size("embedding") == dim), dim


def codebooks(rows: DataFrame, dim: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: float = SCALE) -> list[np.ndarray]:
    """One array (entries x components) per part position; empty when there are no rows."""
    if not 0 < entries <= 1 << 16:
        raise ValueError("between 1 and 65536 entries")
    first = rows.select("vec_id", "embedding").orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).collect()
    seeds = pa.array([list(r["embedding"]) for r in first], pa.list_(pa.float64()))
    x = integers(seeds, dim, parts, scale)
    books = [x[:, cut].copy() for cut in cuts(dim, parts)]
    for _ in range(rounds if first else 0):
        sums = rows.select("embedding").mapInArrow(_sums(books, dim, scale), "part int, entry int, position int, total long")
        sums = sums.groupBy("part", "entry", "position").agg(F.sum("total").alias("total"))
        # at most entries * (dimension + parts) rows, whatever the input
        found = {(r["part"], r["entry"], r["position"]): r["total"] for r in sums.collect()}
        for (p, entry, position), total in found.items():
            if position >= 0:
                books[p][entry, position] = total // found[p, entry, -1]
    return books


def codes(rows: DataFrame, dim: int, books: list[np.ndarray], scale: float = SCALE) -> DataFrame:
    """``(vec_id, label, code, error)``: numbers in hex by part, squared distances summed over parts."""
    fields = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = f"vec_id {fields['vec_id']}, label {fields['label']}, code string, error long"
    return rows.mapInArrow(_codes(books, dim, scale), schema)


def decoded(code: str, books: list[np.ndarray], scale: float = SCALE) -> np.ndarray:
    """The vector that a code stands for (the middle of its integers' cells)."""
    digits = 2 if len(books[0]) <= 256 else 4
    numbers = [int(code[k : k + digits], 16) for k in range(0, len(code), digits)]
    return (np.concatenate([book[n] for book, n in zip(books, numbers, strict=True)]) + 0.5) / scale


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' integers by part, entry and position."""
    return hashlib.sha256(",".join(str(v) for book in books for v in book.ravel().tolist()).encode()).hexdigest()


def compressed(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: float = SCALE) -> DataFrame:
    """``(vec_id, code, error, label_error, codebooks_sha256)``; ``label_error`` sums ``error`` over equal labels.

    A sum beyond 64 bits is null. Labels' sums go back to the rows by a join on the label: broadcast
    only if Spark finds their stored table small, else sorted, where a hot label's rows are split as skew.
    """
    rows, dim = kept_vectors(vectors)
    books = codebooks(rows, dim, parts, entries, rounds, scale)
    coded = stored(codes(rows, dim, books, scale), "vector-codes")
    sums = coded.groupBy(F.col("label").alias("of_label")).agg(F.try_sum("error").alias("label_error"))
    coded = coded.join(stored(sums, "vector-label-errors"), F.col("label").eqNullSafe(F.col("of_label")))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
