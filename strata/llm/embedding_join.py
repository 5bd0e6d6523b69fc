"""Embedding near-duplicates by an exact metric range join.

Vectors link when their labels are equal and their cosine (double precision) is at least
``cosine``; on the unit sphere that is a Euclidean distance of at most ``r = sqrt(2 - 2 * cosine)``.

Equal vectors of one label are one class (folded before any shuffle of vectors). Pivots, a
bounded sample of the classes, part the sphere into cells: a vector's home is its nearest
pivot's cell. If a linked vector's home is another cell q, the triangle inequality gives
``d(x, q) - d(x, home) <= 2r``, and the distance of x to the bisecting plane is at most r; where both
hold (and q comes after the home cell, so that each pair meets once) x is copied to q. Cells of a
label then join on their own, by matrix products over blocks; cells with many members are dealt in
salted blocks, every pair of blocks on its own. A block returns the number of links per class
and one link per class towards its component, never all pairs, so groups of
near-copies cost linear output. Components are then found over all blocks.

The search is exact for any pivots; their number only sets the size of cells (about ``CELL`` classes of
the commonest label, at most ``PIVOTS`` pivots). In high dimensions with evenly spread vectors the
boundaries reach far and copies abound; blocks bound the memory.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and
those with a null label or ``vec_id``, link with nothing; labels may be of any type and are
compared in it; vectors of different lengths do not link;
rows that share a ``vec_id`` are one vector in several places (their links are united); other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, DataType, FractionalType, IntegralType

from strata.llm.common import by_key, connected_components, stored

COSINE = 0.98
CELL = 4096
PIVOTS = 256
BLOCK = 1024
_SLACK = 1e-9


def usable(embedding) -> F.Column:
    fine = F.forall(embedding, lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False)))
    return F.coalesce(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & fine & F.exists(embedding, lambda x: x != 0), F.lit(False))


def _grouped(label: Column, kind: DataType) -> Column:
    """The label as a number or text that is equal for equal labels only (NaN equals itself, and 0 equals -0)."""
    if isinstance(kind, IntegralType):
        return label.cast("long")
    if isinstance(kind, FractionalType):
        label = F.when(label == 0, F.lit(0).cast(kind)).otherwise(label)
    return label.cast("string") if isinstance(kind, AtomicType) else F.when(label.isNotNull(), F.to_json(F.struct(label)))


def _vectors(column: pa.Array) -> list[np.ndarray]:
    return [np.asarray(v, dtype=np.float64) for v in column.to_pylist()]


def _unit(v: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 (by their largest component first, so squares neither vanish nor overflow)."""
    v = v / np.abs(v).max(axis=-1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=-1, keepdims=True))


_PLACED = "label {label}, dim int, cell int, home boolean, node long, weight long, vector binary"


def _placed(pivots: list[list[float]], cosine: float):
    r = math.sqrt(2 - 2 * cosine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_dim: dict[int, np.ndarray] = {}
        for p in pivots:
            by_dim.setdefault(len(p), []).append(p)
        by_dim = {d: _unit(np.array(p)) for d, p in by_dim.items()}
        for batch in batches:
            rows = _vectors(batch.column("embedding"))
            dims = np.array([len(v) for v in rows])
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                x = np.stack([rows[k] for k in at])
                unit, p = _unit(x), by_dim.get(int(dim), np.eye(1, int(dim)))
                squared = np.maximum(0.0, 2 - 2 * unit @ p.T)
                home = squared.argmin(axis=1)
                own = squared[np.arange(len(at)), home]
                far = np.sqrt(squared) - np.sqrt(own)[:, None] > 2 * r + _SLACK
                between = np.sqrt(np.maximum(0.0, 2 - 2 * p @ p.T))[home]
                far |= squared - own[:, None] > 2 * (r + _SLACK) * between + _SLACK
                here = ~far & (np.arange(len(p)) >= home[:, None])
                here[np.arange(len(at)), home] = True
                row, cell = np.nonzero(here)
                taken = pa.array(at[row])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("label").take(taken), pa.array(np.full(len(row), dim, dtype=np.int32)), pa.array(cell.astype(np.int32)),
                     pa.array(cell == home[row]), batch.column("node").take(taken), batch.column("weight").take(taken),
                     pa.array([v.tobytes() for v in x]).take(pa.array(row))],
                    names=["label", "dim", "cell", "home", "node", "weight", "vector"],
                )

    return run


def linked_pairs(x: np.ndarray, y: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of rows of ``x`` and ``y`` with a cosine of at least ``cosine``."""
    a, b = np.nonzero(_unit(x) @ _unit(y).T >= cosine - _SLACK)
    u, v = x[a] / np.abs(x[a]).max(axis=1, keepdims=True), y[b] / np.abs(y[b]).max(axis=1, keepdims=True)
    exact = (u * v).sum(axis=1) / (np.sqrt((u * u).sum(axis=1)) * np.sqrt((v * v).sum(axis=1)))
    return a[exact >= cosine], b[exact >= cosine]


def _joined(cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_key(batches, ["label", "dim", "cell", "i", "j"]):
            x = np.stack([np.frombuffer(v, dtype=np.float64) for v in rows["vector"].to_pylist()])
            salt, home = rows["salt"].to_numpy(), rows["home"].to_numpy()
            node, weight = rows["node"].to_numpy(), rows["weight"].to_numpy()
            i, j = rows["i"][0].as_py(), rows["j"][0].as_py()
            left, right = np.flatnonzero(salt == i), np.flatnonzero(salt == j)
            if not len(left) or not len(right):
                continue
            a, b = linked_pairs(x[left], x[right], cosine)
            a, b = left[a], right[b]
            keep = (home[a] | home[b]) & ((a < b) if i == j else True)
            a, b = a[keep], b[keep]
            if not len(a):
                continue
            links = np.bincount(a, weights=weight[b], minlength=len(x)) + np.bincount(b, weights=weight[a], minlength=len(x))
            root = np.arange(len(x))
            while True:
                least = np.minimum(root[a], root[b])
                new = root.copy()
                np.minimum.at(new, a, least)
                np.minimum.at(new, b, least)
                new = new[new]
                if (new == root).all():
                    break
                root = new
            out = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[out]), pa.array(links[out].astype(np.int64)), pa.array(node[root[out]])], names=["node", "links", "towards"])

    return run


def embedding_components(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row."""
    spark = vectors.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    label = _grouped(F.col("label"), vectors.schema["label"].dataType)
    rows = vectors.select("vec_id", label.alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.withColumn("usable", usable(F.col("embedding")))
    rows = rows.withColumn("hash", F.xxhash64("label", "embedding"))
    valid = rows.where("usable")
    classes = valid.groupBy("hash", "label", "embedding").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("weight"))
    classes = stored(classes, "embedding-classes")

    most = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    count = min(PIVOTS, max(1, -(-most // CELL)))
    chosen = classes.orderBy(F.xxhash64("hash", F.lit("pivot")), "node").limit(count).select("embedding").collect()
    placed = stored(classes.select("label", "node", "weight", "embedding").mapInArrow(_placed([r["embedding"] for r in chosen], cosine), _PLACED.format(label=classes.schema["label"].dataType.simpleString())), "embedding-cells")

    cell = ["label", "dim", "cell"]
    chunks = stored(placed.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("chunks")), "embedding-chunks")
    salted = placed.join(chunks, cell).withColumn("salt", F.pmod(F.xxhash64("node", "home"), F.col("chunks")).cast("int"))
    salted = salted.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    salted = salted.withColumn("i", F.least("salt", "other")).withColumn("j", F.greatest("salt", "other"))
    key = [*cell, "i", "j"]
    blocks = salted.select(*key, "salt", "home", "node", "weight", "vector").repartition(parts, F.xxhash64(*key)).sortWithinPartitions(*key)
    found = stored(blocks.mapInArrow(_joined(cosine), "node long, links long, towards long"), "embedding-links")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = connected_components(found.select(F.col("node").alias("a"), F.col("towards").alias("b")), "embedding-components")
    per_class = classes.join(stored(links, "embedding-degrees"), "node", "left").join(
        joined.withColumnRenamed("node", "member"), F.col("node") == F.col("member"), "left")
    per_class = per_class.select(
        F.col("hash").alias("of_hash"), F.col("label").alias("of_label"), F.col("embedding").alias("of_embedding"),
        (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component"))
    per_class = stored(per_class, "embedding-classes")
    same = (F.when(F.col("usable"), F.col("hash")) == F.col("of_hash")) & (F.col("label") == F.col("of_label")) & (F.col("embedding") == F.col("of_embedding"))
    alone = rows.where("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    linked = valid.join(per_class, same).select("vec_id", F.col("n_links").cast("long"), F.col("component").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
