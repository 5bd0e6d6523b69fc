"""Vector codes, best-fit packing and periodic runs against brute force, on small tables with nulls,
empty and long texts, ties, repeated rows, clashing extra columns, and on empty tables."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from pyspark.sql import functions as F  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from strata.llm import packing, periodic_runs, vector_codes  # noqa: E402

JSON = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, runs string, start string, length string, task string, rank string, best string"
EXTRA = ("r", "s", "l", "t", "k", "b")

# ---- vector codes -----------------------------------------------------------


def _plain_codes(rows, parts, entries, rounds, scale=256):
    """Codes by comparing every part with every entry."""
    kept = [(i, lab, [math.floor(scale * x) for x in v]) for i, lab, v in rows]
    seeds = [q for _, _, q in sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]]
    width = len(kept[0][2]) // parts
    cut = [slice(p * width, (p + 1) * width) for p in range(parts)]
    books = [[q[c] for q in seeds] for c in cut]

    def near(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, entry, strict=True)), k) for k, entry in enumerate(book))

    for _ in range(rounds):
        found = [[near(q[c], book) for c, book in zip(cut, books, strict=True)] for _, _, q in kept]
        for p in range(parts):
            for k in range(len(books[p])):
                own = [q[cut[p]] for (_, _, q), f in zip(kept, found, strict=True) if f[p][1] == k]
                if own:
                    books[p][k] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    out = []
    for i, lab, q in kept:
        f = [near(q[c], book) for c, book in zip(cut, books, strict=True)]
        out.append((i, lab, "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f)))
    by_label = Counter()
    for _, lab, _, error in out:
        by_label[lab] += error
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return sorted(((i, code, error, by_label[lab], digest) for i, lab, code, error in out), key=repr)


def test_vector_codes_equal_plain_search(spark):
    rng = random.Random(4)
    vectors = [[rng.choice([-0.5, 0.0, 0.25, rng.gauss(0, 1)]) for _ in range(8)] for _ in range(120)]
    vectors += vectors[:20] + [[0.0] * 8, [-1e-9] * 8]
    rows = [(k // 2 if k % 17 else None, rng.choice(["x", "y", None]), v) for k, v in enumerate(vectors)]
    bad = [(900, "x", None), (901, "y", [1.0] * 7 + [None]), (902, "x", [float("nan")] * 8), (903, None, [float("inf")] + [0.0] * 7),
           (904, "x", [1.0] * 12), (905, "z", [])]
    df = spark.createDataFrame([(*r, "c", 3) for r in rows + bad], "vec_id long, label string, embedding array<double>, code string, error int")
    df = df.repartition(4)
    for entries, rounds in ((64, 2), (5, 3), (1, 1), (300, 0)):
        got = vector_codes.compressed(df, parts=4, entries=entries, rounds=rounds)
        assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
        want = _plain_codes(rows, 4, entries, rounds)
        if entries > 256:  # four digits a part
            assert sorted(r["error"] for r in got.collect()) == sorted(r[2] for r in want)
        else:
            assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_vector_codes_of_floats_by_label_types_and_uneven_parts(spark):
    rows = [(k, float(k % 3), [k / 7, -k / 3, 1.0]) for k in range(30)]
    df = spark.createDataFrame(rows, "vec_id int, label double, embedding array<float>")
    got = vector_codes.compressed(df, parts=2, entries=30)
    assert {r["error"] for r in got.collect()} == {0} and got.schema["vec_id"].dataType.simpleString() == "int"
    kept, dim = vector_codes.kept_vectors(df)
    books = vector_codes.codebooks(kept, dim, parts=2, entries=30)
    assert [b.shape[1] for b in books] == [2, 1]
    for r in vector_codes.codes(kept, dim, books).collect():
        assert np.abs(vector_codes.decoded(r["code"], books) - np.array(rows[r["vec_id"]][2])).max() <= 0.5 / 256 + 1e-6


def test_vector_codes_of_huge_values_saturate(spark):
    df = spark.createDataFrame([(1, 1, [3e38, -3e38]), (2, 1, [0.0, 0.0]), (3, 1, [1e300, 5.0])], "vec_id long, label int, embedding array<double>")
    rows = vector_codes.compressed(df, parts=1, entries=1, rounds=0).collect()
    most = vector_codes.largest(2, 1)
    assert [r["error"] for r in sorted(rows)] == [0, 2 * most**2, (most + 5 * 256) ** 2]


def test_search_is_exact_and_stops_early():
    rng = np.random.default_rng(1)
    for n, entries, width in ((500, 64, 4), (200, 7, 1), (50, 1, 3), (300, 64, 2)):
        x, book = rng.integers(-20, 20, (n, width)), rng.integers(-20, 20, (entries, width))
        book[entries // 2 :] = book[: entries - entries // 2]  # ties
        every = ((x[:, None] - book[None]) ** 2).sum(axis=2)
        number, distance = vector_codes.nearest(x, book)
        assert (number == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


def test_vector_codes_of_nothing(spark):
    none = spark.createDataFrame([(1, 2, None)], "vec_id long, label int, embedding array<float>")
    for df in (none, none.limit(0)):
        assert vector_codes.compressed(df).collect() == []
    empty = spark.createDataFrame([(1, 2, []), (2, 2, [])], "vec_id long, label int, embedding array<float>")
    assert {(r["code"], r["error"]) for r in vector_codes.compressed(empty).collect()} == {("00" * 16, 0)}


# ---- packing ----------------------------------------------------------------


def _best_fit(lengths, limit):
    """Best-fit decreasing, one piece at a time: the number of sequences."""
    rooms: list[int] = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        room = min(fits) if fits else limit
        if fits:
            rooms.remove(room)
        rooms.append(room - n)
    return len(rooms)


def test_plan_over_counts_equals_best_fit_piece_by_piece():
    rng = random.Random(8)
    for _ in range(150):
        limit = rng.choice([1, 5, 16, 100, 2048])
        histogram = {n: rng.randint(1, rng.choice([1, 5, 40])) for n in rng.sample(range(1, limit + 1), rng.randint(1, min(limit, 30)))}
        steps = packing.plan(histogram, limit).tolist()
        filled: dict[int, list] = {}
        for k, (length, rank, each, first, offset) in enumerate(steps):
            end = steps[k + 1][1] if k + 1 < len(steps) and steps[k + 1][0] == length else histogram[length]
            for q in range(end - rank):
                filled.setdefault(first + q // each, []).append((offset + q % each * length, length))
        assert Counter(n for parts in filled.values() for _, n in parts) == Counter(histogram)
        for parts in filled.values():
            at = 0
            for offset, n in sorted(parts):
                assert offset == at
                at += n
            assert at <= limit
        assert len(filled) == _best_fit([n for n, c in histogram.items() for _ in range(c)], limit)


def test_plan_does_not_grow_with_counts():
    rng = random.Random(1)
    small = {n: rng.randint(1, 50) for n in range(1, 513)}
    large = packing.plan({n: c * 10**7 + rng.randint(0, 50) for n, c in small.items()}, 512)
    assert len(large) < 4096 and packing.plan({}, 512).shape == (0, 5)
    with pytest.raises(ValueError):
        packing.plan({513: 1}, 512)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(200)]
    made = [" ".join(rng.choice(words) for _ in range(rng.choice([1, 5, 30, 200]))) for _ in range(60)]
    odd = [None, "", "  ", "<|endoftext|> it's<|endoftext|>\n\n x", "é ñ 日本語 \U0001f600 tail", "x" * 5000, "ab " * 3000, "ΑΣ İ  ẞ", "\x1c \x85 a"]
    return made + odd + made[:5]


def test_packing_against_the_library(spark, texts):
    limit = 96
    library = Tokenizer.from_file(JSON)
    df = spark.createDataFrame([(k if k % 20 else None, t, *EXTRA) for k, t in enumerate(texts)], DOCS).repartition(5)
    rows = packing.packed(df, JSON, limit, with_ids=True)
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"]
    rows = rows.collect()
    want = Counter()
    for k, text in enumerate(texts):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        first = (len(ids) - 1) % limit + 1
        cuts = [0, *range(first, len(ids) + 1, limit)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[k if k % 20 else None, piece, a, b - a, zlib.crc32(ids[a:b].tobytes()), ids[a:b].tobytes()] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], bytes(r["ids"])) for r in rows) == want
    by_sequence: dict[int, list] = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= limit
    assert len(by_sequence) == _best_fit([r["length"] for r in rows], limit)


def test_sequences_are_their_pieces_in_place(spark, texts):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    rows = packing.stored(packing.packed(df, JSON, 64, with_ids=True), "test-packed")
    whole = {r["sequence_id"]: np.frombuffer(r["ids"], "<u4") for r in packing.sequences(rows).collect()}
    for r in rows.collect():
        assert (whole[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == np.frombuffer(r["ids"], "<u4")).all()
    assert sum(map(len, whole.values())) == sum(r["length"] for r in rows.collect())


def test_ids_equal_the_library_on_odd_texts():
    rng = random.Random(9)
    parts = [" ", "  ", "\n", "a", "'s", "'", "é", "日", "<|endoftext|>", "1", "　", "᠎", "\x1c", "\x85", "!", " b", "\U0001f600", "ß"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += ["".join(map(chr, range(0x250))), " ".join(map(chr, range(0x250))), " " * 20000, "日 " * 5000]
    with open(JSON, encoding="utf-8") as file:
        ids = packing.Ids(file.read())
    assert ids.narrow is not None
    for text, code in zip(texts, Tokenizer.from_file(JSON).encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(ids.encode(text), "<u4").tolist() == code.ids


def test_other_files_are_encoded_whole(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as file:
        ids = packing.Ids(file.read())
    assert ids.narrow is None
    text = "Some  Words, 12 <|endoftext|> é"
    assert np.frombuffer(ids.encode(text), "<u4").tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_packing_of_nothing(spark):
    assert packing.packed(spark.createDataFrame([], DOCS), JSON).collect() == []


# ---- periodic runs ----------------------------------------------------------


def _plain_runs(x, least, times):
    """All runs, by trying every period at every place."""
    found: dict[tuple[int, int], int] = {}
    for q in range(1, len(x) // times + 1):
        i = 0
        while i + q < len(x):
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            if j - i + q >= max(least, times * q) and (i, j - i + q) not in found:
                found[i, j - i + q] = q
            i = j + 1
    return sorted(((i, n, q) for (i, n), q in found.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("chunk", [2, 2048])
def test_runs_equal_every_period_tried(chunk, monkeypatch):
    monkeypatch.setattr(periodic_runs, "CHUNK", chunk)
    rng = random.Random(3)
    for _ in range(1200):
        least, times = rng.choice([(24, 3), (4, 3), (1, 3), (9, 3), (10, 4), (7, 5)])
        n, letters = rng.randint(0, 90), rng.choice([1, 2, 3, 5])
        x = [rng.randrange(letters) for _ in range(n)]
        for _ in range(rng.randint(0, 3) if n else 0):
            a = rng.randrange(n)
            p = 1 + (n - a) // (3 + rng.randrange(8))
            x = [x[i] if i < a else x[a + (i - a) % p] for i in range(n)]
        assert periodic_runs.runs_of(np.array(x, dtype=np.int32), least, times) == _plain_runs(x, least, times)


def test_fewer_than_three_periods_are_refused():
    with pytest.raises(ValueError):
        periodic_runs.runs_of(np.zeros(50, dtype=np.int32), 24, 2)


def _plain_digest(doc_id, text):
    """The query's row, word by word."""
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = _plain_runs(words, 24, 3)
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    gone = {i for start, n, q in runs for i in range(start + q, start + n)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    top = (None,) * 4 if best is None else (best[0], best[1], best[2], 1000 * best[1] // best[2])
    return (doc_id, len(runs), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_run_digest_equals_brute_force(spark):
    rng = random.Random(7)
    texts: list[str | None] = [None, "", " \t ", "one", "a " * 24, "a " * 23, "A a " * 12, "é ñ\n" * 20, "x" * 3000]
    for _ in range(120):
        words = [rng.choice("abcde") for _ in range(rng.choice([10, 60, 150]))]
        for _ in range(rng.randint(0, 2)):
            a = rng.randrange(len(words))
            words[a:a] = words[a : a + rng.randint(1, 9)] * rng.randint(2, 9)
        texts.append(rng.choice([" ", "\n", "  ", "\x0b"]).join(words))
    texts += texts[9:12] + [" ".join(str(k % 700) for k in range(4000))]
    rows = [(k if k % 25 != 3 else None, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame([(*r, *EXTRA) for r in rows], DOCS).repartition(4)
    got = periodic_runs.run_digest(periodic_runs.periodic_runs(periodic_runs.with_planted_repeats(df)))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr(_plain_digest(*r)) for r in rows)
    assert sum(zlib.crc32(str(k).encode()) % 10 == 0 for k, t in rows if t) > 5 and got.where("n_runs > 1").count() > 5


def test_long_texts_next_to_short_ones(spark):
    """Texts beyond a slice of the batch, one of them a single run."""
    long = [("w" * 20 + " ") * 60_000, " ".join(f"u{k}" for k in range(200_000)), "b c b"]
    df = spark.createDataFrame(list(enumerate(long)), "doc_id int, text string").coalesce(1)
    rows = {r["doc_id"]: r for r in periodic_runs.periodic_runs(df).collect()}
    assert [tuple(r) for r in rows[0]["runs"]] == [(0, 60_000, 1)] and rows[0]["collapsed"] == "w" * 20
    assert rows[1]["runs"] == [] and rows[1]["collapsed"] == long[1] and rows[2]["collapsed"] == "b c b"


def test_runs_of_nothing(spark):
    empty = spark.createDataFrame([], DOCS)
    found = periodic_runs.periodic_runs(periodic_runs.with_planted_repeats(empty))
    assert periodic_runs.run_digest(found).collect() == []
    assert found.agg(F.count("*")).first()[0] == 0
