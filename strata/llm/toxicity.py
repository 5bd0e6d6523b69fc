"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary and one on toxic text. Every whole
text is rewritten with each word twice in a row and cut into windows of ``WINDOW`` bytes (each overlaps the next by ``OVERLAP``, so that
a word cut in one window is whole in another), and every window is compressed with
both. A word that no dictionary holds then costs its letters and a copy, a word that one holds a copy
only, so even a short marked word shows by all of its letters. Where toxic text shows, the toxic dictionary saves bytes that the ordinary one does
not. The largest saving of a window, the mean of the largest eighth and of all, and the
share and sum of clear savings are turned into a probability by a logistic regression (the
calibration), shifted to the share of toxic rows among all labelled ones.

Both dictionaries start with the same ordinary content, so that a window without
toxic wording has the same length under both, up to chance. What is trained on toxic
text are its marked words: those that begin like words of clearly more toxic than ordinary
training documents (log-likelihood ratio), near-copies among these documents counted once.

Training rows: at most ``PER_CLASS[c]`` documents of every class outside the held-out
fold, chosen by a hash of the id (the only bound; scoring reads every whole text). A third of them
is kept from the dictionaries and calibrates. Labels, language, source and id are no inputs.

Defined cases: a null text scores like an empty one (the calibrated score of no saving); an
id with several labels takes the largest; without both classes in the sample every
score is 0; rows are kept one to one; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import held_out, ranges, shingles, slices, stored, text_bytes, unit_hash, utf8, word_bounds
from strata.llm.svm import logistic

PER_CLASS = {0: 3000, 1: 1500}
WINDOW = 96
OVERLAP = 40
LEVEL = 5
MATCH = 5
ORDINARY_BYTES = 16384
TOXIC_BYTES = 4096
#: Documents with a marked stem at least, least log-likelihood ratio, and lengths of stems.
MARKED_DOCS, MARKED_RATIO = 5, 40.0
STEM = range(4, 11)
THRESHOLD = 0.3
#: Bytes from which a window's saving counts as clear, and number of features.
CLEAR, FEATURES = 5, 5

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_FOLD[[*range(32), *range(33, 48), *range(58, 65), *range(91, 97), *range(123, 128)]] = 32


def fold(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z lower-cased, and ASCII punctuation and controls as blanks."""
    return _FOLD[data]


def doubled(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The folded texts with every word twice in a row and a blank behind it, and their offsets."""
    data = fold(data)
    start, end, first = word_bounds(data, offsets)
    length = end - start
    blank = np.full(len(start), len(data))
    parts = np.stack([start, start, blank], axis=1).ravel(), np.stack([length, length, np.ones_like(length)], axis=1).ravel()
    ends = np.concatenate([[0], np.cumsum(2 * length + 1)])
    return np.append(data, np.uint8(32))[ranges(*parts)], ends[first]


def _doubled(text: bytes) -> bytes:
    return doubled(np.frombuffer(text, dtype=np.uint8), np.array([0, len(text)]))[0].tobytes()


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    """A compressor of bare frames that copies runs of at least ``MATCH`` bytes from ``content``."""
    shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    how = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, dict_size=len(content), source_size=WINDOW, min_match=MATCH, strategy=zstandard.STRATEGY_LAZY,
        write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    shared.precompute_compress(compression_params=how)
    return zstandard.ZstdCompressor(dict_data=shared, compression_params=how)


def _ordinary(samples: list[bytes]) -> bytes:
    """The ordinary dictionary, trained on the samples; their plain text where they are too few to train."""
    try:
        return zstandard.train_dictionary(ORDINARY_BYTES, samples, k=32, d=6).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(dict.fromkeys(samples))[-ORDINARY_BYTES:]


def _toxic(samples: list[bytes]) -> bytes:
    """The toxic dictionary: the distinct samples, the most frequent last (nearest to the window)."""
    content = b""
    for w, _ in sorted(Counter(samples).items(), key=lambda x: (-x[1], x[0])):
        if len(content) + len(w) <= TOXIC_BYTES:
            content = w + content
    return content


def _without_near_copies(texts: list[bytes]) -> list[bytes]:
    """The texts without those whose smallest shingle hashes are mostly those of an earlier one."""
    seen: dict[int, int] = {}
    kept = []
    for k, t in enumerate(texts):
        data = np.frombuffer(t, dtype=np.uint8)
        least = np.unique(shingles(data, np.array([0, len(data)]), 3)[0])[:16].tolist()
        share = Counter(seen[h] for h in least if h in seen)
        if least and share and share.most_common(1)[0][1] >= 0.3 * len(least):
            continue
        seen.update(dict.fromkeys(least, k))
        kept.append(t)
    return kept


def marked_stems(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """Word beginnings (``STEM`` bytes, or whole words) of clearly more toxic than ordinary
    documents, most marked first; of two that begin alike the more marked one."""

    def found_in(texts: list[bytes]) -> Counter:
        return Counter(s for t in texts for s in {w[:k] for w in set(t.split()) for k in (*STEM, len(w)) if len(w) >= max(k, STEM[0])})

    a, b = found_in(toxic), found_in(ordinary)
    n, m = max(1, len(toxic)), max(1, len(ordinary))

    def ratio(x: int, y: int) -> float:
        p = (x + y) / (n + m)
        return 2 * sum(k * math.log(k / (size * q)) for k, size, q in ((x, n, p), (y, m, p), (n - x, n, 1 - p), (m - y, m, 1 - p)) if k)

    scored = [(ratio(x, b[w]), len(w), w) for w, x in a.items() if x >= MARKED_DOCS and x / n > 3 * b[w] / m]
    stems: list[bytes] = []
    for r, _, w in sorted(scored, reverse=True):
        if r >= MARKED_RATIO and not any(w.startswith(s) or s.startswith(w) for s in stems):
            stems.append(w)
    return stems


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    weights: np.ndarray | None = None

    def savings(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
        """Per text, the bytes that the toxic dictionary saves in each window (none for an empty text)."""
        if not hasattr(self, "_pair"):
            self._pair = _compressor(self.ordinary), _compressor(self.toxic)
        data, offsets = doubled(data, offsets)
        size = np.diff(offsets)
        step = WINDOW - OVERLAP
        count = np.where(size > 0, 1 + np.maximum(0, -(-(size - WINDOW) // step)), 0)
        bounds = np.concatenate([[0], np.cumsum(count)])
        start = np.repeat(offsets[:-1], count) + (np.arange(bounds[-1]) - np.repeat(bounds[:-1], count)) * step
        length = np.minimum(WINDOW, np.repeat(offsets[1:], count) - start)
        saved = np.zeros(bounds[-1], dtype=np.int64)
        blob = data.tobytes()
        for at in range(0, len(saved), 20_000):
            part = slice(at, at + 20_000)
            segments = zstandard.BufferWithSegments(blob, np.stack([start[part], length[part]], axis=1).astype("<u8").tobytes())
            plain, marked = (np.fromiter(map(len, c.multi_compress_to_buffer(segments)), dtype=np.int64) for c in self._pair)
            saved[part] = plain - marked
        return (saved[a:b] for a, b in zip(bounds, bounds[1:], strict=False))

    def features(self, column: pa.Array) -> np.ndarray:
        data, offsets = text_bytes(column)
        out = np.zeros((len(offsets) - 1, FEATURES))
        for row, saved in zip(out, self.savings(data, offsets), strict=True):
            if n := len(saved):
                best = np.sort(saved)[::-1]
                clear = saved >= CLEAR
                row[:] = best[0] / 4, best[: max(1, n // 8)].mean() / 4, saved.mean(), clear.mean(), math.log1p(saved[clear].sum())
        return out

    def score(self, column: pa.Array) -> np.ndarray:
        x = self.features(column)
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))

    def __getstate__(self):
        return {"ordinary": self.ordinary, "toxic": self.toxic, "weights": self.weights}


def fit(texts: list[str], toxic: np.ndarray, calibrate: np.ndarray, odds: float = 1.0) -> Model | None:
    """Dictionaries of the rows not in ``calibrate``, calibration on those in it.

    ``odds``: the odds of toxic rows among all labelled rows.
    """
    folded = [fold(np.frombuffer(t.encode(), dtype=np.uint8)).tobytes() for t in texts]
    rows = {c: _without_near_copies([t for t, y, k in zip(folded, toxic, calibrate, strict=True) if y == c and not k]) for c in (0, 1)}
    if not rows[0] or not rows[1] or len(set(toxic[calibrate].tolist())) < 2:
        return None
    pieces = [t[i : i + 256] for t in map(_doubled, rows[0]) for i in range(0, len(t), 256)]
    pieces = pieces[:: max(1, len(pieces) // 4000)]
    ordinary = _ordinary(pieces)
    stems = tuple(marked_stems(rows[1], rows[0]))
    samples = [b" " + w + w + b" " for t in rows[1] for w in t.split() if w.startswith(stems)] if stems else []
    model = Model(ordinary, ordinary + _toxic(samples))
    x = model.features(pa.array([t for t, k in zip(texts, calibrate, strict=True) if k], pa.string()))
    y = toxic[calibrate].astype(float)
    model.weights = logistic(x, y)
    model.weights[-1] += math.log(odds) - math.log(y.mean() / (1 - y.mean()))
    return model


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The model of a bounded sample of labelled rows outside the held-out fold."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}  # at most two rows
    if len(counts) < 2:
        return None
    share = F.when(F.col("toxic") == 1, PER_CLASS[1] / counts[1]).otherwise(PER_CLASS[0] / counts[0])
    chosen = known.where(unit_hash(F.col("doc_id"), F.lit("toxic")) < share)
    part = (unit_hash(F.col("doc_id"), F.lit("calibrate")) < 1 / 3).alias("calibrate")
    # stored, so that Spark knows its size (some thousand rows) and need not shuffle the texts
    chosen = stored(chosen, "toxicity-chosen")
    rows = docs.select("doc_id", "text").join(chosen, "doc_id").select("doc_id", "text", "toxic", part)
    rows = stored(rows, "toxicity-sample").orderBy("doc_id").toPandas()
    if not len(rows):
        return None
    return fit(rows["text"].fillna("").tolist(), rows["toxic"].to_numpy(), rows["calibrate"].to_numpy(dtype=bool), counts[1] / counts[0])


def toxicity(docs: DataFrame, model: Model | None) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            score = np.zeros(part.num_rows) if model is None else model.score(utf8(part.column("text")))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, unchanged (each judged by its own text)."""
    model = train(docs, labels)
    if model is None:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield part.filter(pa.array(model.score(utf8(part.column("text"))) < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
