"""Best-fit packing of token sequences, planned over a histogram of lengths.

A document's tokens are its ids and an end id. Documents longer than ``limit`` are cut into pieces of
``limit`` tokens, the first of which may be shorter. The plan places *counts* of equal lengths,
from the longest to the shortest: as in best-fit decreasing, a piece goes to the open sequence with the
least room that holds it, else to a new one. Sequences with equal room are ranges of numbers, and a range
takes ``room // length`` pieces per sequence in one step. A range's room falls below the length in each
step and thus by half at least, and a length opens at most three new ranges, so the plan's size depends
on ``limit`` alone (with 2048 at most some tens of thousands of steps, in practice hundreds), not on the documents. It gives
as many sequences as best-fit decreasing piece by piece.

Pieces then take the planned slots by their rank within their length. Tasks number pieces per length as
they cut them; the first ranks per (task, length) are running sums over the tasks (a length that holds a third of all pieces
is thus spread over its tasks and never sorted); the slot of a rank is found by binary search in the
plan, which every task holds. The cut pieces are written before they are ranked, so a lost executor's numbers stay valid.

Ids are those of the ``tokenizers`` library for the given file, without added special tokens; strings of the file's
special tokens inside texts are handled as its default. For a byte-level file of the usual split
pattern whose merges come in the order of ids, texts below U+0250 are encoded by ``tiktoken`` with the file's
own tokens as ranks, which gives the same ids; other texts are split before single blanks, where a pre-token always
starts, and the library encodes the parts (with a bounded cache). For other files it encodes whole texts.

Defined cases: null text is empty (the end id alone); a null id is kept; rows are kept one to one,
repeated rows are packed each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm.common import slices, stored, utf8

LIMIT = 2048
END_ID = 0
#: Bytes of parts of texts and their ids in the cache (with about 150 bytes of objects each), and length of a part from which it is not kept.
CACHE_BYTES, CACHED = 32 << 20, 1000
_WIDE = re.compile("[^\x00-\u024f]")
# Fixed value: the split pattern of byte-level files with use_regex.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# ---------------------------------------------------------------------------
# Ids
# ---------------------------------------------------------------------------


class Ids:
    """Ids of texts as packed little-endian 32-bit numbers."""

    def __init__(self, spec: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's own core only
        self.whole = Tokenizer.from_str(spec)
        fields = json.loads(spec)
        level = fields["pre_tokenizer"] or {}
        added = fields["added_tokens"]
        self.added = re.compile("(" + "|".join(re.escape(t["content"]) for t in sorted(added, key=lambda t: -len(t["content"]))) + ")") if added else None
        self.special = {t["content"]: np.array([t["id"]], dtype="<u4").tobytes() for t in added}
        plain = (
            level.get("type") == "ByteLevel" and level.get("use_regex", True) and not level["add_prefix_space"]
            and not any(fields[k] for k in ("normalizer", "truncation", "padding")) and fields["model"]["type"] == "BPE"
            and not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added)
        )
        ranks = _ranks(fields["model"], self.special) if plain else None
        self.narrow = None if ranks is None else tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        # a blank between two other characters always starts a pre-token (U+180E was a blank once)
        self.wide = re.compile(r"(?<=[^\s\u180e])(?= [^\s\u180e])").split
        self.known: dict[str, bytes] = {}
        self.held = 0

    def _look_up(self, part: str) -> bytes:
        code = self.known.get(part)
        if code is None:
            code = np.array(self.whole.encode_batch_fast([part], add_special_tokens=False)[0].ids, dtype="<u4").tobytes()
            if self.held > CACHE_BYTES:
                self.known, self.held = {}, 0
            if len(part) < CACHED:
                self.known[part] = code
                self.held += 4 * len(part) + len(code) + 150
        return code

    def encode(self, text: str) -> bytes:
        if self.narrow is None:
            return self._look_up(text)
        out = []
        for k, part in enumerate([text] if self.added is None else self.added.split(text)):
            if k % 2:  # special tokens are at the odd places
                out.append(self.special[part])
            elif _WIDE.search(part):
                out += map(self._look_up, self.wide(part))
            else:
                out.append(self.narrow.encode_to_numpy(part, disallowed_special=()).astype("<u4").tobytes())
        return b"".join(out)


def _ranks(model: dict, special: dict[str, bytes]) -> dict[bytes, int] | None:
    """Tokens' bytes with their ids, if merges come in the order of ids and make every longer token."""
    letter = {c: b for b, c in bytes_to_letters().items()}
    vocab = {t: i for t, i in model["vocab"].items() if t not in special}
    made = [vocab.get("".join(m.split(" ") if isinstance(m, str) else m), -1) for m in model["merges"]]
    if any(set(t) - letter.keys() for t in vocab) or sum(len(t) == 1 for t in vocab) != 256:
        return None
    if made != sorted(set(made)) or set(made) != {i for t, i in vocab.items() if len(t) > 1}:
        return None
    return {bytes(letter[c] for c in t): i for t, i in vocab.items()}


def bytes_to_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + k) for k, b in enumerate(rest)}


_PIECE = "doc_id {id}, piece int, start long, length int, ids_crc32 long, task int, nth long"


def pieces(docs: DataFrame, path: str, limit: int = LIMIT, with_ids: bool = False) -> DataFrame:
    """Every document's pieces, numbered per length within their task; ``with_ids`` adds ``ids`` (packed 32-bit numbers)."""
    with open(path, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())  # a vocabulary file, some MB
    end = np.array([END_ID], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task, seen = Ids(spec.value), TaskContext.get().partitionId(), [0] * (limit + 1)
        for part in slices(batches):
            row, number, start, length, crc, nth, ids = [], [], [], [], [], [], []
            for k, text in enumerate(utf8(part.column("text")).to_pylist()):
                view = memoryview(encoder.encode(text) + end)
                n = len(view) // 4
                at, stop = 0, (n - 1) % limit + 1
                while at < n:
                    row.append(k)
                    number.append((at + limit - 1) // limit)
                    start.append(at)
                    length.append(stop - at)
                    crc.append(zlib.crc32(view[4 * at : 4 * stop]))
                    nth.append(seen[stop - at])
                    seen[stop - at] += 1
                    if with_ids:
                        ids.append(bytes(view[4 * at : 4 * stop]))
                    at, stop = stop, stop + limit
            arrays = [part.column("doc_id").take(pa.array(row, pa.int64())), pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                      pa.array(length, pa.int32()), pa.array(crc, pa.int64()), pa.array(np.full(len(row), task, dtype=np.int32)), pa.array(nth, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(ids, pa.binary())] if with_ids else arrays, names=[*names, "ids"] if with_ids else names)

    schema = _PIECE.format(id=docs.schema["doc_id"].dataType.simpleString()) + (", ids binary" if with_ids else "")
    return docs.select("doc_id", "text").mapInArrow(run, schema)


# ---------------------------------------------------------------------------
# Plan
# ---------------------------------------------------------------------------


def plan(histogram: dict[int, int], limit: int = LIMIT) -> np.ndarray:
    """Steps (length, first rank, pieces per sequence, first sequence, offset in it), ordered by length and rank.

    The pieces of a step, by rank, fill its sequences one after another, ``pieces per sequence`` to each.
    """
    steps: list[tuple[int, int, int, int, int]] = []
    rooms: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> (first sequence, number of sequences)
    opened = 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        if not 0 < length <= limit:
            raise ValueError(f"length {length} of a limit of {limit}")
        for room in [*sorted(r for r in rooms if r >= length), limit + 1]:
            each = min(room, limit) // length
            # beyond the open sequences: as many new ones as the rest needs
            ranges = rooms.pop(room, []) if room <= limit else [(opened, -(-left // each))]
            opened += ranges[0][1] if room > limit else 0
            room = min(room, limit)
            while ranges and left:
                first, number = ranges.pop()
                full = min(number, left // each)
                if full:
                    steps.append((length, rank, each, first, limit - room))
                    rooms[room - each * length].append((first, full))
                    rank, left, first, number = rank + full * each, left - full * each, first + full, number - full
                if number and left:  # fewer pieces are left than one more sequence could take
                    steps.append((length, rank, left, first, limit - room))
                    rooms[room - left * length].append((first, 1))
                    rank, left, first, number = rank + left, 0, first + 1, number - 1
                if number:
                    ranges.append((first, number))
            if ranges:
                rooms[room].extend(ranges)
            if not left:
                break
    return np.array(sorted(steps), dtype=np.int64).reshape(-1, 5)


def _slots(steps: np.ndarray):
    keys = steps[:, 0] << 44 | steps[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            length, rank = rows.column("length").to_numpy().astype(np.int64), rows.column("rank").to_numpy()
            step = np.searchsorted(keys, length << 44 | rank, "right") - 1
            _, first_rank, each, sequence, offset = steps[step].T
            place = rank - first_rank
            keep = [n for n in rows.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(n) for n in keep), pa.array(sequence + place // each), pa.array(offset + place % each * length)],
                names=[*keep, "sequence_id", "offset"])

    return run


def packed(docs: DataFrame, path: str, limit: int = LIMIT, with_ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` per piece (and ``ids``)."""
    cut = stored(pieces(docs, path, limit, with_ids), "packing-pieces")
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = cut.groupBy("task", "length").count()
    counts = stored(counts.select("task", "length", "count", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before")), "packing-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}  # at most limit rows
    ranked = cut.join(counts.drop("count"), ["task", "length"]).withColumn("rank", F.col("before") + F.col("nth"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    rows = ranked.select(*(F.col(n).cast("long") if n == "length" else F.col(n) for n in names), "rank")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "rank")
    return rows.mapInArrow(_slots(plan(histogram, limit)), f"{schema}, sequence_id long, offset long")


def sequences(rows: DataFrame) -> DataFrame:
    """``(sequence_id, n_tokens, ids)`` of rows packed ``with_ids``: the sequences themselves (a sequence's pieces are bounded by the limit)."""
    together = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(together, F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    return rows.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))
