"""Short texts that share a passage must not meet in the n-gram join unless they may link."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import ngram_join


def _with_passage(count: int, own: int, seed: int) -> list[str]:
    """Texts of one common passage of 40 words with ``own`` words of their own around it."""
    rng = random.Random(seed)
    passage = [f"p{k}" for k in range(40)]
    out = []
    for i in range(count):
        words = [f"t{i}x{k}" for k in range(own)]
        at = rng.randrange(own + 1)
        out.append(" ".join(words[:at] + passage + words[at:]))
    return out


def _inside(monkeypatch) -> list[int]:
    """Gets the number of classes in forests of every join that follows."""
    seen: list[int] = []

    def stored(df, label, of=ngram_join.stored):
        out = of(df, label)
        if label == "ngram-inside" and "near" not in out.columns:
            seen.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "stored", stored)
    return seen


def test_texts_with_a_common_passage_make_no_forest_in_the_pipeline(spark, monkeypatch):
    import corpus_pipeline

    seen = _inside(monkeypatch)
    texts = _with_passage(200, 60, 1)
    texts += [t + " one more" for t in texts[:5]]  # linked: 97 shingles or so, two more
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r["doc_id"] for r in corpus_pipeline.one_of_each_group(spark, docs, "").collect()}
    assert kept == set(range(200))
    assert seen == [10]


def test_classes_in_forests_follow_the_links_not_the_texts_with_a_passage(spark, tmp_path, monkeypatch):
    from strata.llm import queries

    seen = _inside(monkeypatch)
    for count in (60, 180):
        texts = _with_passage(count, 45, 2)
        texts += [" ".join(texts[k].split()[:-3]) for k in range(4)] + [texts[4].upper()]
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/{count}/documents.parquet")
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.op5_ngram_join(spark, f"{tmp_path}/{count}").collect()}
        want = {k: (82, k) for k in range(count)} | {count + k: (79, k) for k in range(4)} | {count + 4: (82, 4)}
        assert got == want
    assert seen == [8, 8]


def _batches(rows: list[tuple], names: list[str], types: list[pa.DataType], rng: random.Random) -> list[pa.RecordBatch]:
    out, at = [], 0
    while at < len(rows):
        n = rng.randint(1, 9)
        out.append(pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[at : at + n], strict=True), types, strict=True)], names=names))
        at += n
    return out


@pytest.mark.parametrize("block", [3, 4096])
def test_groups_chain_all_that_may_link_and_nothing_else(block, monkeypatch):
    monkeypatch.setattr(ngram_join, "GROUP_BLOCK", block)
    rng, made = random.Random(6), np.random.default_rng(6)
    for percent in (60, 85):
        base = [made.integers(0, 1 << 63, size=60, dtype=np.uint64) << np.uint64(1) for _ in range(4)]
        sets = {}
        for key in range(40):
            s = base[key % 4].copy()
            s[made.choice(60, made.integers(0, 25), replace=False)] = made.integers(0, 1 << 63, dtype=np.uint64)
            sets[key - 20] = np.unique(s[: 60 - rng.randrange(8)])
        tokens = {t: rng.sample(sorted(sets), rng.choice([1, 2, 2, 3, 5, 12, 30])) for t in range(25)}
        tokens |= {30 + t: tokens[t] for t in range(10)}  # the same groups again
        posted = sorted((t, k, len(sets[k])) for t, keys in tokens.items() for k in keys)
        grouped = ngram_join._grouped(iter(_batches(posted, ["token", "key", "n"], [pa.int64(), pa.int64(), pa.int32()], rng)))
        groups = sorted({tuple(r.values()) for b in grouped for r in b.to_pylist()})
        assert len({g for g, *_ in groups}) == len({frozenset(k) for k in tokens.values() if len(k) > 1})
        sketch = dict(zip(sets, ngram_join.sketches(list(sets.values())), strict=True))
        rows = [(g, i, j, k, len(sets[k]), sketch[k].tobytes()) for g, i, j, k in groups]
        types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]
        found = ngram_join._compared(percent)(iter(_batches(rows, ["group", "i", "j", "key", "n", "sketch"], types, rng)))
        root = {k: k for k in sets}
        for a, b in ((r["a"], r["b"]) for x in found for r in x.to_pylist()):
            old, new = max(root[a], root[b]), min(root[a], root[b])
            root = {k: new if v == old else v for k, v in root.items()}

        def may(a, b):
            far = int(np.bitwise_count(sketch[a] ^ sketch[b]).sum())
            assert far <= len(np.setxor1d(sets[a], sets[b]))
            x, y = len(sets[a]), len(sets[b])
            return far <= x + y - 2 * ngram_join.required_overlap(x, y, percent) and 100 * min(x, y) >= percent * max(x, y)

        want = {k: k for k in sets}
        for keys in tokens.values():
            for a in keys:
                for b in keys:
                    if want[a] != want[b] and may(a, b):
                        old, new = max(want[a], want[b]), min(want[a], want[b])
                        want = {k: new if v == old else v for k, v in want.items()}
        assert root == want and 4 < len(set(root.values())) < 40
