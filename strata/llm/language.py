"""Language identification by hierarchical discrimination.

Features of a text are hashed counts of its 1- to 3-byte sequences (A-Z lower-cased,
digits and ASCII punctuation folded to a blank, runs of blanks folded to one), taken over
the whole text, square-rooted and scaled to length 1. A first set of linear support
vector machines (one against each other family) predicts the language family, a second
one (one against each other language of the family) the language within it.

Training rows: documents with text and language outside the held-out fold, chosen by a hash of
the id: about ``per_language`` of every language, and of every language fewer where there
are many (``ROWS`` in all, but about ``LEAST_ROWS`` of each). Every language is learned; one whose
rows are all missed by the hash gives one row. Prediction reads every whole text. The machines are
fitted in Spark tasks: classes are dealt into groups of ``GROUP``, and a task fits the
machines between two groups; the driver gets their weights only.

A fifth of the sample (of languages with ``CALIBRATED`` rows at least) is kept from fitting and gives
the least score of :func:`keep_identified`: half the margin that all but ``LOSS`` of the rows
predicted right exceed, so near-zero margins are rejected and few clean documents.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; with no
training rows at all every text is ``und``; rows are kept one to one, repeated rows get
equal results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import by_key, give_back, held_out, slices, stored, text_bytes, unit_hash, utf8
from strata.llm.svm import linear_svm

DIM = 4096
PER_LANGUAGE = 1000
#: Training rows of all languages together, and of each at least, on average.
ROWS, LEAST_ROWS = 16_000, 50
#: Classes of a group.
GROUP = 8
#: Rows whose features (16 KB each) are held at once when texts are short.
AT_ONCE = 1024
#: Sampled rows from which a language takes part in the calibration, and the share of right rows it may reject.
CALIBRATED, LOSS = 20, 0.005
UNKNOWN = "und"

# Language families by ISO 639-1 code; any other code is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fo", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "si", "ur"),
    "turkic": ("az", "kk", "ky", "tr", "uz"),
}
_FAMILY_OF = {code: name for name, codes in FAMILIES.items() for code in codes}
_LETTER = regex.compile(r"\p{L}")

_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[: ord("A")] = 32
_FOLD[ord("A") : ord("Z") + 1] += 32
_FOLD[[*range(ord("Z") + 1, ord("a")), *range(ord("z") + 1, 128)]] = 32


def family(language: str) -> str:
    return _FAMILY_OF.get(language.lower().replace("_", "-").split("-")[0], language)


def features(data: np.ndarray) -> np.ndarray:
    """The feature vector of one text's bytes (length 1; all zero for an empty text)."""
    c = _FOLD[data]
    if len(c) > 1:
        c = c[np.append(True, (c[1:] != 32) | (c[:-1] != 32))]
    grams = [c, c[:-1] * np.uint32(257) + c[1:] + np.uint32(7919)]
    if len(c) > 2:
        grams.append((c[:-2] * np.uint32(257) + c[1:-1]) * np.uint32(257) + c[2:] + np.uint32(104729))
    codes = np.concatenate(grams) * np.uint32(2654435761) >> np.uint32(32 - DIM.bit_length() + 1)
    counts = np.sqrt(np.bincount(codes, minlength=DIM)).astype(np.float32)
    norm = np.linalg.norm(counts)
    return counts / norm if norm else counts


def _rows(part: pa.RecordBatch) -> np.ndarray:
    data, offsets = text_bytes(part.column("text"))
    out = np.empty((part.num_rows, DIM), dtype=np.float32)
    for row, a, b in zip(out, offsets, offsets[1:], strict=False):
        row[:] = features(data[a:b])
    return out


def _matrix(stored_rows: pa.ChunkedArray, chosen: np.ndarray) -> np.ndarray:
    """The chosen ones of feature vectors stored as float16, without further copies of them."""
    out = np.empty((len(chosen), DIM), dtype=np.float32)
    for row, k in zip(out, chosen.tolist(), strict=True):
        row[:] = np.frombuffer(stored_rows[k].as_buffer(), dtype=np.float16)
    return out


def has_letter(texts: pa.Array) -> np.ndarray:
    return np.array([_LETTER.search(t) is not None for t in utf8(texts).to_pylist()], dtype=bool)


@dataclass
class Votes:
    """One-against-one machines over ``names``; the row of most wins is predicted."""

    names: list[str]
    pairs: list[tuple[int, int]]
    weights: np.ndarray  # (DIM + 1, pairs)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the name, smallest margin among its machines): most wins, then largest sum of margins."""
        margins = x @ self.weights[:-1] + self.weights[-1]
        wins = np.zeros((len(x), len(self.names)))
        least = np.full((len(x), len(self.names)), 8.0)
        for k, (a, b) in enumerate(self.pairs):
            m = margins[:, k]
            wins[:, a] += (m >= 0) + np.tanh(m) * 1e-3
            wins[:, b] += (m < 0) - np.tanh(m) * 1e-3
            least[:, a] = np.minimum(least[:, a], m)
            least[:, b] = np.minimum(least[:, b], -m)
        best = wins.argmax(axis=1)
        return best, least[np.arange(len(x)), best]


@dataclass
class Model:
    families: Votes
    within: dict[str, Votes]
    least: float = 0.0  # the calibrated least score

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        which, margin = self.families.predict(x)
        name = np.empty(len(x), dtype=object)
        for g in np.unique(which):
            rows = np.flatnonzero(which == g)
            votes = self.within[self.families.names[g]]
            best, inner = votes.predict(x[rows])
            name[rows] = [votes.names[b] for b in best]
            margin[rows] = np.minimum(margin[rows], inner)
        return name.tolist(), 1 / (1 + np.exp(-2.0 * margin))


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The machines between two groups of classes of one level (family "" holds the families)."""
    for rows in by_key(batches, ["level", "i", "j"]):
        give_back()
        i, j = rows["i"][0].as_py(), rows["j"][0].as_py()
        of, group = rows["class"].to_numpy(), rows["own"].to_numpy()
        left, right = np.unique(of[group == i]).tolist(), np.unique(of[group == j]).tolist()
        for a, b in [(a, b) for a in left for b in right if a < b]:
            pair = np.flatnonzero((of == a) | (of == b))
            w = linear_svm(_matrix(rows["x"], pair), np.where(of[pair] == a, 1.0, -1.0)).astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([rows["level"][0].as_py()]), pa.array([a], pa.int32()), pa.array([b], pa.int32()), pa.array([w.tobytes()])],
                names=["level", "a", "b", "w"])


def _machines(sample: DataFrame, levels: dict[str, list[str]]) -> dict[str, Votes]:
    """``Votes`` of every level from the rows ``(lang, x)``; each machine is fitted by a Spark task."""
    spark = sample.sparkSession
    groups = {level: -(-len(names) // GROUP) for level, names in levels.items()}
    places = []  # language: its class in the families' level and in its family's
    for lang in (x for level, names in levels.items() if level for x in names):
        for level, name in (("", family(lang)), (family(lang), lang)):
            if len(levels[level]) > 1:
                at = levels[level].index(name)
                places += [(lang, level, at, at // GROUP, g) for g in range(groups[level])]
    votes = {level: Votes(names, [], np.zeros((DIM + 1, 0), dtype=np.float32)) for level, names in levels.items()}
    if not places:
        return votes
    where = spark.createDataFrame(places, "of string, level string, class int, own int, other int")
    rows = sample.join(where, F.col("lang") == F.col("of")).select(
        "level", "class", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "x")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, "level", "i", "j").sortWithinPartitions("level", "i", "j")
    made: dict[str, list] = {}
    for r in stored(rows.mapInArrow(_fitted, "level string, a int, b int, w binary"), "language-machines").orderBy("level", "a", "b").toLocalIterator():
        made.setdefault(r["level"], []).append(((r["a"], r["b"]), np.frombuffer(bytes(r["w"]), dtype=np.float32)))
    for level, found in made.items():
        votes[level] = Votes(levels[level], [p for p, _ in found], np.stack([w for _, w in found], axis=1))
    return votes


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    """The model of a bounded sample of the rows outside the held-out fold (``None`` without any)."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    drawn = unit_hash(F.col("doc_id"), F.lit("language"))
    counts = stored(usable.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"), F.min(drawn).alias("first")), "language-counts")
    languages = sorted(r["lang"] for r in counts.select("lang").toLocalIterator())
    if not languages:
        return None
    wanted = min(per_language, max(LEAST_ROWS, ROWS // len(languages)))
    share = F.greatest(F.lit(float(wanted)) / F.col("rows"), F.col("first") + 1e-12)  # the first row in any case
    part = counts.select(F.col("lang").alias("of"), share.alias("share"), "rows", "first")
    rows = usable.select("doc_id", "lang", "text").join(part, F.col("lang") == F.col("of")).where(drawn < F.col("share"))
    enough = F.least("rows", F.lit(wanted)) >= CALIBRATED
    rows = rows.select("lang", "text", (enough & (unit_hash(F.col("doc_id"), F.lit("calibrate")) < 0.2) & (drawn > F.col("first"))).alias("calibrate"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, rows=AT_ONCE):
            x = pa.array([r.astype(np.float16).tobytes() for r in _rows(part)])
            yield pa.RecordBatch.from_arrays([part.column("lang"), part.column("calibrate"), x], names=["lang", "calibrate", "x"])

    sample = stored(rows.mapInArrow(run, "lang string, calibrate boolean, x binary"), "language-sample")
    levels: dict[str, list[str]] = {"": sorted({family(x) for x in languages})}
    for g in levels[""]:
        levels[g] = [x for x in languages if family(x) == g]
    votes = _machines(sample.where("NOT calibrate").select("lang", "x"), levels)
    model = Model(votes[""], {g: votes[g] for g in levels[""]})

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.stack([np.frombuffer(r, dtype=np.float16) for r in batch.column("x").to_pylist()]).astype(np.float32)
                names, score = model.predict(x)
                right = np.array(names, dtype=object) == np.array(batch.column("lang").to_pylist(), dtype=object)
                yield pa.RecordBatch.from_arrays([pa.array(np.log(score[right] / (1 - score[right])) / 2)], names=["margin"])

    right = stored(sample.where("calibrate").mapInArrow(margins, "margin double"), "language-margins")
    low = right.select(F.percentile("margin", F.lit(LOSS)).alias("low")).first()["low"]
    model.least = 0.0 if low is None else float(1 / (1 + np.exp(-max(0.0, low))))  # half the margin: the score of low / 2
    return model


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` for every row; trained on ``docs`` if no model is given."""
    model = model if model is not None else train(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, rows=AT_ONCE):
            letters = has_letter(part.column("text"))
            if model is None:
                names, score = [UNKNOWN] * part.num_rows, np.zeros(part.num_rows)
            else:
                names, score = model.predict(_rows(part))
                names = [n if ok else UNKNOWN for n, ok in zip(names, letters, strict=True)]
                score = np.where(letters, score, 0.0)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(names, pa.string()), pa.array(score.astype(np.float64))],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, least: float | None = None) -> DataFrame:
    """The rows of ``docs`` whose language is predicted with a score of at least ``least``, unchanged.

    By default the model's calibrated least score.

    The prediction runs on each row's own text, so no row is joined or shuffled.
    """
    model = train(docs)
    if model is None:
        return docs.limit(0)
    least = model.least if least is None else least

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, rows=AT_ONCE):
            _, score = model.predict(_rows(part))
            yield part.filter(pa.array((score >= least) & has_letter(part.column("text"))))

    return docs.mapInArrow(run, docs.schema)
