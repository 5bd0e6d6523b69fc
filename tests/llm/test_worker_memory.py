"""Memory of the functions that run in Python workers: no copies of training matrices, no freed memory kept."""

from __future__ import annotations

import subprocess
import sys
import tracemalloc
from pathlib import Path

import numpy as np
import pytest

pa = pytest.importorskip("pyarrow")

from strata.llm import language  # noqa: E402
from strata.llm.common import slices  # noqa: E402
from strata.llm.svm import linear_svm  # noqa: E402

ROOT = Path(__file__).resolve().parents[2]


def _sample(n: int, classes: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(5)
    of = np.arange(n) % classes
    x = rng.random((n, language.DIM), dtype=np.float32)
    x[np.arange(n), of] += 20.0
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float16), of


def _batch(x: np.ndarray, of: np.ndarray) -> pa.RecordBatch:
    n, zero = len(x), np.zeros(len(x), dtype=np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(["romance"] * n), pa.array(of.astype(np.int32)), *[pa.array(zero)] * 3, pa.array([r.tobytes() for r in x])],
        names=["level", "class", "own", "i", "j", "x"])


def test_language_machines_hold_their_rows_once():
    x, of = _sample(1200, 2)
    batches = [_batch(x[a : a + 500], of[a : a + 500]) for a in range(0, 1200, 500)]
    once = x.size * 4
    tracemalloc.start()
    try:
        made = list(language._fitted(iter(batches)))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(made) == 1
    assert peak < 1.3 * once


def test_language_machines_of_each_pair_use_its_rows_only():
    x, of = _sample(90, 3)
    made = {(r["a"], r["b"]): r["w"] for out in language._fitted(iter([_batch(x, of)])) for r in out.to_pylist()}
    assert set(made) == {(0, 1), (0, 2), (1, 2)}
    for (a, b), w in made.items():
        pair = (of == a) | (of == b)
        expected = linear_svm(x[pair].astype(np.float32), np.where(of[pair] == a, 1.0, -1.0))
        assert np.array_equal(np.frombuffer(w, dtype=np.float32), expected.astype(np.float32))


def test_svm_weighs_the_bias_like_a_column_of_ones():
    x, of = _sample(60, 2)
    x, y = x.astype(np.float64), np.where(of == 0, 1.0, -1.0)
    y[:7] *= -1  # not separable
    ones = np.hstack([x, np.ones((len(x), 1))])
    share = np.where(y > 0, 5.0 / (y > 0).sum(), 5.0 / (y < 0).sum())

    def loss(w):
        return 0.5 * w @ w + (share * np.maximum(0.0, 1.0 - y * (ones @ w)) ** 2).sum()

    w = linear_svm(x, y, rounds=2000)
    gradient = w - 2.0 * ones.T @ (share * np.maximum(0.0, 1.0 - y * (ones @ w)) * y)
    assert np.abs(gradient).max() < 1e-6
    assert loss(w) < loss(np.zeros(len(w)))


def test_slices_of_short_texts_have_a_bounded_number_of_rows():
    rows = pa.RecordBatch.from_arrays([pa.array(range(10)), pa.array(["a", None, "", "bb", "c" * 50, *"defgh"])], names=["doc_id", "text"])
    parts = list(slices(iter([rows, rows.slice(3)]), limit=20, rows=3))
    assert [i for p in parts for i in p.column("doc_id").to_pylist()] == [*range(10), *range(3, 10)]
    assert max(p.num_rows for p in parts) == 3


RETAINED = """
import re
from pathlib import Path
import numpy as np, pyarrow as pa
from strata.llm.common import slices

def anonymous():
    return int(re.search(r"Pss_Anon:\\s+(\\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024

def batches():
    for _ in range(6):
        yield pa.RecordBatch.from_arrays([pa.array(["x" * 2000] * 8000)], names=["text"])

def task(batches):
    for part in slices(batches):
        held = [np.ones(1 << 17) for _ in range(24)]
        yield part.num_rows, np.ones(1 << 10)

before = anonymous()
assert sum(n for n, _ in task(batches())) == 48000
assert len(list(slices(iter([pa.RecordBatch.from_arrays([pa.array(["x"])], names=["text"])])))) == 1
print(anonymous() - before)
"""


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="reads /proc")
def test_a_worker_gives_back_what_an_earlier_task_has_freed():
    out = subprocess.run([sys.executable, "-c", RETAINED], cwd=ROOT, capture_output=True, text=True, timeout=120, check=True)
    assert float(out.stdout) < 40
