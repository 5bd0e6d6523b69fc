"""Document fingerprints by MinHash.

A fingerprint holds ``PERMUTATIONS`` minima of universal hash functions over the document's
``width``-word shingles (default five words; words are runs without space or tab..CR, A-Z
lower-cased; fewer words: the whole sequence as one shingle), 16 bits of each, as
lower-case hex. The share of equal positions of two fingerprints estimates the Jaccard likeness of the shingle
sets; equal texts have equal fingerprints. All permutations run over a whole slice of
texts at once (``a * h + b`` modulo 2**64 with odd ``a``, minima per document by ``reduceat``).

:func:`near_duplicates` finds near-duplicates: fingerprints of distinct shingle sets are cut into ``BANDS``
bands, and the sets that share a band with another are candidates. Candidates that may reach the likeness (they share a
signature of :mod:`ngram_join`, as all linked sets do) form groups, and all pairs within a group are verified on the shingle sets, in
salted blocks; so a passage or template that makes many texts somewhat alike makes no large group. Two sets of likeness 0.8 share no
band with a chance of about 5e-8 (estimated as if the minima were independent); no other link is lost.

:func:`fingerprint_with_edits` also fingerprints each document's edited text, whose last floor(n/2)
code points are replaced by the first as many of the next document in descending ``doc_id``
(after the last: the first). Documents are dealt once, compressed, into ranges of ``doc_id``; each
range also gets the head of the range after it, so no range waits for another. The components found
are dealt into the same ranges, so the fingerprints are not shuffled to meet them.

Defined cases: null text is empty; an empty document has the fingerprint "" and likeness 1 to
another empty one, 0 to any other; rows that share a ``doc_id`` follow each other in
the order of their text's hash; null ids come last; a single row is its own next document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm import ngram_join
from strata.llm.common import compressed, connected_components, decompressed, mix64, shingles, slices, stored, text_bytes, utf8

PERMUTATIONS = 128
WIDTH = 5
BANDS = 32
PERCENT = 80
#: Ranges of doc_id per shuffle partition.
RANGES = 4


def _coefficients() -> tuple[np.ndarray, np.ndarray]:
    k = mix64(np.arange(1, 2 * PERMUTATIONS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return k[:PERMUTATIONS] | np.uint64(1), k[PERMUTATIONS:]


def signatures(texts: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(16-bit minima per text and permutation, whether the text has a shingle)."""
    return _minima(*shingles(*text_bytes(texts), width))


def _minima(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    full = np.flatnonzero(np.diff(bounds))
    out = np.zeros((len(bounds) - 1, PERMUTATIONS), dtype=np.uint16)
    if len(full):
        starts, values = bounds[full], np.empty_like(hashes)
        for k, (a, b) in enumerate(zip(*_coefficients(), strict=True)):
            np.multiply(hashes, a, out=values)
            np.add(values, b, out=values)
            least = np.minimum.reduceat(values, starts)
            out[full, k] = (mix64(least) >> np.uint64(48)).astype(np.uint16)
    return out, np.diff(bounds) > 0


def to_hex(rows: np.ndarray, full: np.ndarray) -> list[str]:
    return [r.astype(">u2").tobytes().hex() if f else "" for r, f in zip(rows, full, strict=True)]


def _like(a: np.ndarray, b: np.ndarray, full_a: np.ndarray, full_b: np.ndarray) -> np.ndarray:
    both = (a == b).mean(axis=1) if len(a) else np.zeros(0)
    return np.where(full_a & full_b, both, np.where(full_a | full_b, 0.0, 1.0))


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``(doc_id, fingerprint)`` for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(to_hex(*signatures(part.column("text"), width)), pa.string())],
                names=["doc_id", "fingerprint"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fingerprint string")


# ---------------------------------------------------------------------------
# Edited texts
# ---------------------------------------------------------------------------


def ranges(docs: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """The rows with their range (0 holds the largest ids), their texts compressed, and, once more, the head of every
    range at the end of the range before it (of the first one at the end of the last).

    ``found(doc_id, component_id)``: each of its rows comes, without a text, before the rows of its ``doc_id``.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) * RANGES
    split = docs.select(F.percentile_approx("doc_id", [k / parts for k in range(1, parts)]).alias("at")).first()["at"] or []
    edges = [float("-inf"), *sorted({0.0} | {-float(x) for x in split}), float("inf")]
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), (-F.coalesce("doc_id", F.lit(0))).alias("down"), "tie")

    def ranged(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("at", F.coalesce(-F.col("doc_id").cast("double"), F.lit(float("inf"))))
        rows = Bucketizer(splits=edges, inputCol="at", outputCol="range").transform(rows).drop("at")
        return rows.withColumn("range", F.col("range").cast("int"))

    rows = ranged(docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie")))
    heads = rows.groupBy("range").agg(F.min(order).alias("head"))
    by_range = Window.orderBy("range")  # one row per range
    before = F.coalesce(F.lag("range").over(by_range), F.max("range").over(by_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    heads = heads.select("head", before.alias("before"))
    heads = stored(heads, "fingerprint-heads")
    rows = rows.withColumn("order", order)
    tails = rows.join(F.broadcast(heads), F.col("order") == F.col("head")).select(
        "doc_id", "text", "order", F.col("before").alias("range"), F.lit(True).alias("tail"))
    tails = tails.dropDuplicates(["range"])
    rows = rows.select("doc_id", "text", "order", "range", F.lit(False).alias("tail")).unionByName(tails)
    rows = rows.mapInArrow(_packed, _PACKED)
    if found is None:
        return rows
    named = ranged(found.select("doc_id", "component_id", F.lit(None).cast("long").alias("tie")))  # a null tie comes first
    return rows.unionByName(named.select("doc_id", "component_id", order.alias("order"), "range", F.lit(False).alias("tail")), allowMissingColumns=True)


_PACKED = "doc_id long, packed binary, order struct<no_id:boolean,down:long,tie:long>, range int, tail boolean, component_id long"


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with their texts compressed."""
    for part in slices(batches):
        held = [part.column(c) for c in ("order", "range", "tail")]
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(compressed(part.column("text")), pa.binary()), *held, pa.nulls(part.num_rows, pa.int64())],
            names=["doc_id", "packed", "order", "range", "tail", "component_id"])


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of sorted rows of :func:`ranges`, with their texts and the component found for their id."""
    of, component = None, None  # of the last row without a text
    for batch in batches:
        ids, frames, named = (batch.column(c).to_pylist() for c in ("doc_id", "packed", "component_id"))
        at, own = [], []
        for k, (doc_id, frame) in enumerate(zip(ids, frames, strict=True)):
            if frame is None:
                of, component = doc_id, named[k]
            else:
                at.append(k)
                own.append(component if doc_id is not None and doc_id == of else None)
        rows = batch.select(["doc_id", "tail"]).take(pa.array(at, pa.int64()))
        for first, texts in decompressed([frames[k] for k in at]):
            doc_id, tail = (c.slice(first, len(texts)) for c in rows.columns)
            yield pa.RecordBatch.from_arrays(
                [doc_id, texts, tail, pa.array(own[first : first + len(texts)], pa.int64())], names=["doc_id", "text", "tail", "component_id"])


_EDITED = """doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,
near_edited double, near_next double, component_id long"""


def fingerprint_with_edits(docs: DataFrame, width: int = WIDTH, found: DataFrame | None = None) -> DataFrame:
    """One row per document: id, length, both fingerprints and their likenesses (see the module).

    ``found(doc_id, component_id)``, one row per id, adds ``component_id`` (null where ``found`` lacks the id).
    """
    names = [x.split()[0] for x in _EDITED.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None  # the last row, until the next one is there
        for part in _unpacked(batches):
            rows = part if held is None else pa.Table.from_batches([held, part]).combine_chunks().to_batches()[0]
            held = rows.slice(rows.num_rows - 1)
            if rows.num_rows < 2:
                continue
            column = utf8(rows.column("text"))
            texts = column.to_pylist()
            edited = [t[: len(t) - len(t) // 2] + u[: len(t) // 2] for t, u in zip(texts, texts[1:], strict=False)]
            own, full = signatures(column, width)
            new, new_full = signatures(pa.array(edited, pa.large_string()), width)
            keep = ~rows.column("tail").to_numpy(zero_copy_only=False)[:-1]
            keep = np.flatnonzero(keep)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id").take(pa.array(keep)),
                    pa.array([len(texts[k]) for k in keep], pa.int64()),
                    pa.array([hashlib.sha256(edited[k].encode()).hexdigest() for k in keep], pa.string()),
                    pa.array(to_hex(own[keep], full[keep]), pa.string()),
                    pa.array(to_hex(new[keep], new_full[keep]), pa.string()),
                    pa.array(_like(own[keep], new[keep], full[keep], new_full[keep])),
                    pa.array(_like(own[keep], own[keep + 1], full[keep], full[keep + 1])),
                    rows.column("component_id").take(pa.array(keep)),
                ],
                names=names,
            )

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = ranges(docs.select("doc_id", "text"), found).repartition(parts, "range").sortWithinPartitions("range", "tail", "order")
    made = rows.select("doc_id", "packed", "tail", "component_id").mapInArrow(run, _EDITED)
    return made.drop("component_id") if found is None else made


# ---------------------------------------------------------------------------
# Near-duplicates
# ---------------------------------------------------------------------------


def _bands(width: int):
    """Rows (token, key, 0): the bands of every set's fingerprint, once per class of equal sets and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        posted: set[int] = set()  # emptied when it grows large
        for part in slices(batches):
            hashes, bounds = shingles(*text_bytes(part.column("text")), width)
            if len(posted) > ngram_join.POSTED:
                posted.clear()
            rows, keys = [], []
            for row, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                values = np.unique(hashes[a:b])
                if len(values) and (key := ngram_join.class_key(values)) not in posted:
                    posted.add(key)
                    rows.append(row)
                    keys.append(key)
            if rows:
                bands = np.ascontiguousarray(_minima(hashes, bounds)[0][rows]).view(np.uint64)  # four minima a band
                tokens = mix64(bands * np.uint64(2 * BANDS + 1) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens.ravel()), pa.array(np.repeat(np.array(keys, dtype=np.int64), BANDS)), pa.array(np.zeros(BANDS * len(keys), dtype=np.int32))],
                    names=["token", "key", "n"],
                )

    return run


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, component_id)`` per distinct id: smallest id reachable by verified links.

    Links have a Jaccard likeness of at least ``percent`` / 100. Bands only choose the candidates; within
    a group of them every pair is compared (by :func:`ngram_join.verified_components`), whichever members a
    band has. Rows that share an id are one document.
    """
    docs = docs.select("doc_id", "text").where("doc_id IS NOT NULL")
    sizes, thin = ngram_join.keyed_sets(docs, width, percent)
    banded = stored(ngram_join.in_several(docs.mapInArrow(_bands(width), "token long, key long, n int")).select("key").distinct(), "fingerprint-banded")
    wanted = docs.sparkSession.sparkContext.broadcast(ngram_join.wanted_bits(banded))
    signatures = docs.mapInArrow(ngram_join._signatures(width, percent, thin, wanted), "token long, key long, n int")
    found = ngram_join.verified_components(docs, sizes, signatures, width, percent)
    found = stored(found.select("doc_id", "component_id").distinct(), "fingerprint-found")
    if found.groupBy("doc_id").count().where("count > 1").isEmpty():
        return found
    # texts of one id in several components
    joined = connected_components(found.select(F.col("doc_id").alias("a"), F.col("component_id").alias("b")), "fingerprint-components")
    return found.select("doc_id").distinct().join(joined, F.col("doc_id") == F.col("node"), "left").select(
        "doc_id", F.coalesce("component", "doc_id").alias("component_id"))


def fingerprints_and_components(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows of :func:`fingerprint_with_edits` with the ``component_id`` of :func:`near_duplicates` (null without an id)."""
    return fingerprint_with_edits(docs, width, near_duplicates(docs, width))
