"""Token counts from pre-token frequencies, without materialising ids.

A text's tokens are those of its pre-tokens. The texts are read once, in blocks of at most
``BLOCK_DOCS`` documents and ``BLOCK_WORDS`` distinct pre-tokens; a block yields its distinct
pre-tokens (numbered within the block) and, per document, the numbers with their frequencies.
The pre-tokens of all blocks meet by text, each distinct one is counted once by the tokenizer's
model, and the counts return to their blocks, where frequencies times counts are summed.
A frequent pre-token comes once per block, so it is no hot key.

The tokenizer file is one of the ``tokenizers`` library with a byte-level pre-tokenizer. Its
normaliser and split pattern are applied as the library does (NFC, then lower case without
the special final sigma); strings of the file's added tokens inside a text are one token each,
the library's default, and part the text around them.

Defined cases: null text is empty (0 bytes, 0 tokens); rows are kept one to one, repeated rows
get equal results; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.byte_bpe import _WIDE, narrowed
from strata.llm.common import by_key, slices, stored, utf8

BLOCK_DOCS = 16_384
BLOCK_WORDS = 400_000
LIMIT = 2048


def _byte_characters() -> dict[int, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {b: b for b in plain} | {b: 0x100 + k for k, b in enumerate(b for b in range(256) if b not in set(plain))}


class PreTokens:
    """The split of a text that the tokenizer file describes."""

    def __init__(self, spec: dict) -> None:
        steps = spec["normalizer"]["normalizers"]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        if [s["type"] for s in steps] != ["NFC", "Replace", "Lowercase"] or level["type"] != "ByteLevel" or level["use_regex"]:
            raise ValueError("a tokenizer with other steps than NFC, blanks, lower case, split and byte level")
        if steps[1]["pattern"] != {"Regex": r"\s+"} or split["behavior"] != "Removed" or not split["invert"]:
            raise ValueError("a tokenizer with another handling of blanks")
        pattern = split["pattern"]["Regex"]
        self.wide, self.narrow = regex.compile(pattern), re.compile(narrowed(pattern))
        added = [t["content"] for t in spec["added_tokens"]]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("added tokens with conditions")
        self.added = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None

    def split(self, text: str) -> tuple[list[str], int]:
        """(pre-tokens, number of added tokens) of a text."""
        parts = [text] if self.added is None else self.added.split(text)
        out: list[str] = []
        for part in parts:
            part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            out += (self.wide if _WIDE.search(part) else self.narrow).findall(part)
        return out, len(parts) - 1


def _packed(numbers: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """Ascending numbers as lower 16 bits and upper 8 bits (which compress away), counts as bytes;
    both as 32 bits where that is too narrow."""
    if len(numbers) and (numbers[-1] >= 1 << 24 or counts.max() > 255):
        return numbers.astype("<u4").tobytes(), counts.astype("<u4").tobytes()
    return numbers.astype("<u2").tobytes() + (numbers >> 16).astype(np.uint8).tobytes(), counts.astype(np.uint8).tobytes()


def _unpacked(numbers: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    if len(numbers) == len(counts):  # 4 bytes each, else 3 and 1
        return np.frombuffer(numbers, "<u4"), np.frombuffer(counts, "<u4")
    low, high = numbers[: 2 * len(counts)], numbers[2 * len(counts) :]
    return np.frombuffer(low, "<u2") | np.frombuffer(high, np.uint8).astype(np.uint32) << 16, np.frombuffer(counts, np.uint8)


_ROW = "block long, number int, word string, doc_id long, n_bytes long, added long, numbers binary, counts binary"


def _blocks(path: str):
    """Rows (block, number, word) for a block's pre-tokens, then (block, doc_id, ...) for its documents."""

    def block_rows(block: int, words: dict[str, int], docs: list[tuple]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _ROW.split(", ")]
        n = len(words)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, block)), pa.array(np.arange(n, dtype=np.int32)), pa.array(list(words), pa.string()),
             *[pa.nulls(n, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())]],
            names=names,
        )
        m = len(docs)
        ids, sizes, added, numbers, counts = zip(*docs, strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(m, block)), pa.nulls(m, pa.int32()), pa.nulls(m, pa.string()), pa.array(ids, pa.int64()),
             pa.array(sizes, pa.int64()), pa.array(added, pa.int64()), pa.array(numbers, pa.binary()), pa.array(counts, pa.binary())],
            names=names,
        )

    def run(batches):
        with open(path, encoding="utf-8") as file:
            split = PreTokens(json.load(file)).split
        block = TaskContext.get().partitionId() << 32
        words: dict[str, int] = defaultdict()
        words.default_factory = words.__len__
        docs: list[tuple] = []
        for part in slices(batches):
            for doc_id, text in zip(part.column("doc_id").to_pylist(), utf8(part.column("text")).to_pylist(), strict=True):
                pieces, added = split(text)
                at, count = np.unique(np.fromiter(map(words.__getitem__, pieces), dtype=np.uint32, count=len(pieces)), return_counts=True)
                docs.append((doc_id, len(text.encode()), added, *_packed(at, count)))
                if len(docs) >= BLOCK_DOCS or len(words) >= BLOCK_WORDS:
                    yield from block_rows(block, words, docs)
                    block += 1
                    words, docs = defaultdict(), []
                    words.default_factory = words.__len__
        if docs:
            yield from block_rows(block, words, docs)

    return run


def _counted(path: str):
    """Of pre-tokens sorted by text: one row (block, numbers, counts) per block and batch, every distinct one counted once."""

    def run(batches):
        from tokenizers import Tokenizer

        tokenize = Tokenizer.from_file(path).model.tokenize
        alphabet = _byte_characters()
        last, n = None, 0
        for batch in batches:
            made = np.empty(batch.num_rows, dtype=np.uint32)
            for k, word in enumerate(batch.column("word").to_pylist()):
                if word != last:
                    last, n = word, len(tokenize(word.encode().decode("latin-1").translate(alphabet)))
                made[k] = n
            block, number = batch.column("block").to_numpy(), batch.column("number").to_numpy().astype(np.uint32)
            order = np.argsort(block, kind="stable")
            cuts = np.flatnonzero(np.diff(block[order], prepend=-1, append=-1))
            parts = [order[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(block[p[0]]) for p in parts], pa.int64()), pa.array([number[p].tobytes() for p in parts], pa.binary()),
                 pa.array([made[p].tobytes() for p in parts], pa.binary())],
                names=["block", "numbers", "counts"],
            )

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in by_key(batches, ["block"]):
        kind = rows["kind"].to_numpy()
        numbers, counts = rows["numbers"].to_pylist(), rows["counts"].to_pylist()
        first = int(np.searchsorted(kind, 1))
        at = np.frombuffer(b"".join(numbers[:first]), dtype=np.uint32)
        tokens = np.zeros(int(at.max(initial=0)) + 1, dtype=np.int64)
        tokens[at] = np.frombuffer(b"".join(counts[:first]), dtype=np.uint32)
        total = []
        for ids, n, added in zip(numbers[first:], counts[first:], rows["added"].to_pylist()[first:], strict=True):
            ids, n = _unpacked(ids, n)
            total.append(int((tokens[ids] * n).sum()) + added)
        out = rows.slice(first)
        yield pa.RecordBatch.from_arrays(
            [out["doc_id"].combine_chunks(), out["n_bytes"].combine_chunks(), pa.array(total, pa.int64())],
            names=["doc_id", "n_bytes", "n_tokens"],
        )


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for every row."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = stored(docs.select("doc_id", "text").mapInArrow(_blocks(path), _ROW), "token-blocks")
    words = blocks.where("word IS NOT NULL").select("word", "block", "number")
    words = words.repartition(parts, "word").sortWithinPartitions("word")
    counted = words.mapInArrow(_counted(path), "block long, numbers binary, counts binary")
    none = F.lit(None).cast("long")
    counted = counted.select("block", F.lit(0).alias("kind"), none.alias("doc_id"), none.alias("n_bytes"), none.alias("added"), "numbers", "counts")
    per_doc = blocks.where("word IS NULL").select("block", F.lit(1).alias("kind"), "doc_id", "n_bytes", "added", "numbers", "counts")
    met = counted.unionByName(per_doc).repartition(parts, "block").sortWithinPartitions("block", "kind")
    out = met.mapInArrow(_summed, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
