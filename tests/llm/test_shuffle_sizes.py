"""What near-duplicate detection writes and shuffles, and that the results stay whole."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from strata.llm import common, fingerprints, ngram_join


def _union_find(links) -> dict[int, int]:
    root = {x: x for link in links for x in link if link[0] != link[1]}

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for a, b in links:
        if a != b:
            a, b = sorted((top(a), top(b)))
            root[b] = a
    return {x: top(x) for x in root}


@pytest.mark.parametrize("kind", ["path", "shuffled path", "star", "random", "loops"])
def test_components_take_few_rows(spark, monkeypatch, kind):
    rng = random.Random(kind)
    ids = rng.sample(range(-10**12, 10**12), 400)
    links = {
        "path": list(zip(sorted(ids), sorted(ids)[1:], strict=False)),
        "shuffled path": list(zip(ids, ids[1:], strict=False)),
        "star": [(ids[0], x) for x in ids[1:]],
        "random": [(rng.choice(ids), rng.choice(ids)) for _ in range(300)],
        "loops": [(x, x) for x in ids],
    }[kind]
    written = []
    monkeypatch.setattr(common, "stored", lambda df, label, real=common.stored: written.append(real(df, label)) or written[-1])
    table = spark.createDataFrame([*links, (None, ids[3]), (ids[4], None), links[0]], "a long, b long").repartition(3)
    got = common.connected_components(table)
    assert sorted(map(tuple, got.collect())) == sorted(_union_find(links).items())
    assert sum(df.count() for df in written) <= 13 * len(ids)


def test_texts_are_shuffled_compressed_and_fingerprints_not_again(spark):
    words = ["".join(random.Random(k).choices("abcdefgh", k=6)) for k in range(300)]
    rng = random.Random(3)
    data = [(k // 2 if k < 20 else k, " ".join(rng.choices(words, k=rng.randint(0, 90)))) for k in range(120)]
    data += [(200 + k, data[k][1]) for k in range(30)] + [(None, data[5][1]), (None, None), (300, None), (301, "")]
    table = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    named = {r["doc_id"]: r["component_id"] for r in fingerprints.near_duplicates(table).collect()}
    made = fingerprints.fingerprints_and_components(table)
    rows = made.collect()
    assert len(rows) == len(data) and all(r["component_id"] == named.get(r["doc_id"]) for r in rows)
    assert named[200] == 0 and None not in named
    plain = fingerprints.fingerprint_with_edits(table)
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, made.drop("component_id").collect()))
    for df in (plain, made):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "LeftOuter" not in plan and "packed#" in plan.split("RepartitionByExpression")[0]


def test_sets_travel_in_the_shorter_form_and_arrive_equal():
    rng = random.Random(2)
    texts = [" ".join(f"word{rng.randint(0, 99)}" for _ in range(n)) for n in (1, 4, 30, 700, 30_000)]
    texts += ["漢" * 3000 + "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(3000)), "ab " * 400_000, "A b C d e", None, "", "one"]
    wanted = type("Wanted", (), {"value": np.full(ngram_join.FILTER_BITS // 8, 255, dtype=np.uint8)})
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], names=["doc_id", "text"])
    rows = pa.Table.from_batches(ngram_join._whole_sets(4, wanted)(iter([batch])))
    assert all((m is None) != (p is None) for m, p in zip(rows["members"].to_pylist(), rows["packed"].to_pylist(), strict=True))
    assert rows["members"].null_count and rows["packed"].null_count
    got = dict(zip(rows["key"].to_pylist(), ngram_join._received(rows, 4), strict=True))
    hashes, bounds = common.shingles(*common.text_bytes(pa.array(texts, pa.string())), 4)
    sets = [np.unique(hashes[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
    assert len(got) == sum(len(s) > 0 for s in sets)
    for s in sets:
        if len(s):
            assert (got[ngram_join.class_key(s)] == ngram_join.unpacked(ngram_join.packed(s))).all()
    size = sum(len(x) for c in ("members", "packed") for x in rows[c].to_pylist() if x is not None)
    assert size < 0.7 * sum(6 * len(s) for s in sets)


def test_chains_name_the_smallest_key_of_a_token():
    rng = random.Random(4)
    for _ in range(200):
        rows = sorted((rng.randint(-3, 3), rng.randint(-9, 9)) for _ in range(rng.randint(0, 40)))
        batches, at = [], 0
        while at < len(rows):
            n = rng.randint(1, 9)
            token, key = zip(*rows[at : at + n], strict=True)
            batches.append(pa.RecordBatch.from_arrays([pa.array(token), pa.array(key), pa.array([0] * len(key), pa.int32())], names=["token", "key", "n"]))
            at += n
        got = {(a, b) for x in ngram_join._chain(iter(batches)) for a, b in zip(x.column("a").to_pylist(), x.column("b").to_pylist(), strict=True)}
        first = {t: min(k for u, k in rows if u == t) for t, _ in rows}
        assert got == {(first[t], k) for t, k in rows if k != first[t]}
