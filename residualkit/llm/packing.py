"""Best-fit packing of token sequences, in bulk-synchronous rounds.

*Pieces.* A document's tokens and an end token are cut, only if they are more
than the capacity, into full pieces; the first piece takes what is left over.
Tokenising is one pass; each task also numbers its pieces within their length.

*Rounds.* Pieces of one length are interchangeable, and so are open sequences
with one gap, so the state of the packing is runs: how many pieces of each
length, and which consecutive sequences have each gap. Both are sorted by size. In
the round of a length, a sweep from that length upward finds the successor: the smallest gap that
fits. All pieces that want the same gap get it by rank, as many as there
are sequences with it; the gaps shrink together, and what is left of the length
goes to the next gap, and then to new sequences, each of which takes as many as fit. The runs are bounded by the
capacity squared and do not grow with the data, so the sweep needs no task of its own; only counts by length reach
the driver.

*Assignment.* A piece knows its rank in its length from its own task and a
prefix sum over tasks, and finds its run of the plan by bisection. No row of the
data is ever gathered or sorted globally.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator, Mapping
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from residualkit.llm.frames import first_columns, stage_python

CAPACITY = 2048
END = 0
_WIDE = re.compile("[^\\x00-\u024f]|\\s{512}")


class ByteEncoder:
    """Token ids of a byte-level BPE vocabulary, as little-endian unsigned 32-bit bytes.

    The ids are those of the ``tokenizers`` file. They are made by a faster
    encoder from the same vocabulary's rank file and pattern; a text that holds
    a special token, a character above U+024F, where two libraries may know
    different character classes, or a long run of white space, which the faster one cannot
    take, goes to ``tokenizers`` itself.
    """

    def __init__(self, tokenizer_file: str, rank_file: str, pattern: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        with open(rank_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.full = Tokenizer.from_file(tokenizer_file)
        self.special = [t.content for t in self.full.get_added_tokens_decoder().values()]

    def plain(self, text: str) -> bool:
        return not _WIDE.search(text) and not any(s in text for s in self.special)

    def encode(self, text: str) -> bytes:
        if self.plain(text):
            return array("I", self.fast.encode_ordinary(text)).tobytes()
        return array("I", self.full.encode(text, add_special_tokens=False).ids).tobytes()


_encoders: dict[tuple[str, str], ByteEncoder] = {}


def encoder(tokenizer_file: str, rank_file: str, pattern: str) -> ByteEncoder:
    """One encoder for each worker process."""
    key = (tokenizer_file, rank_file)
    if key not in _encoders:
        _encoders[key] = ByteEncoder(tokenizer_file, rank_file, pattern)
    return _encoders[key]


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of a document: only the first may be shorter than the capacity."""
    if length <= capacity:
        return [(0, length)]
    first = length % capacity
    starts = [0] if first else []
    starts += range(first, length, capacity)
    return [(s, e - s) for s, e in zip(starts, [*starts[1:], length], strict=True)]


PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, task int, place long"


def _pieces(
    batches: Iterator[pa.RecordBatch], capacity: int, files: tuple[str, str, str]
) -> Iterator[pa.RecordBatch]:
    encode = encoder(*files).encode
    task = TaskContext.get().partitionId()
    numbers: dict[int, int] = defaultdict(int)
    end = np.asarray([END], "<u4").tobytes()
    for batch in batches:
        rows: list[tuple] = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            raw = encode(text or "") + end
            for piece, (start, length) in enumerate(cut(len(raw) // 4, capacity)):
                crc = zlib.crc32(raw[4 * start : 4 * (start + length)])
                rows.append((doc_id, piece, start, length, crc, task, numbers[length]))
                numbers[length] += 1
        columns = list(zip(*rows, strict=True)) or [()] * 7
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "place"],
        )


Placement = tuple[int, int, int, int, int]


def plan_runs(counts: Mapping[int, int], capacity: int) -> list[Placement]:
    """Runs ``(length, first rank, pieces, first sequence, offset)`` for ``counts`` pieces of each length.

    Pieces of a run go to consecutive sequences, one each, at the same offset.
    One round per length, from the longest down.
    """
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap: runs (first sequence, how many)
    sizes: list[int] = []  # the gaps that exist, ascending
    plan: list[Placement] = []
    opened = 0

    def put(gap: int, first: int, many: int) -> None:
        if gap == 0:
            return
        if not gaps[gap]:
            sizes.insert(bisect_left(sizes, gap), gap)
        gaps[gap].append((first, many))

    for length in sorted((n for n in counts if counts[n] > 0), reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(sizes, length)
            if at == len(sizes):
                break
            gap = sizes[at]
            first, many = gaps[gap].pop()
            taken = min(many, left)
            if many > taken:
                gaps[gap].append((first + taken, many - taken))
            if not gaps[gap]:
                sizes.pop(at)
            plan.append((length, rank, taken, first, capacity - gap))
            put(gap - length, first, taken)
            rank, left = rank + taken, left - taken
        each = capacity // length
        fresh, rest = divmod(left, each)
        for layer in range(each if fresh else 0):
            plan.append((length, rank, fresh, opened, layer * length))
            rank += fresh
        if fresh:
            put(capacity - each * length, opened, fresh)
            opened += fresh
        for layer in range(rest):
            plan.append((length, rank, 1, opened, layer * length))
            rank += 1
        if rest:
            put(capacity - rest * length, opened, 1)
            opened += 1
    return plan


PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def _assign(batches: Iterator[pa.RecordBatch], plan: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Find the run of each piece by bisection on (length, rank)."""
    keys = (plan[:, 0] << 48) | plan[:, 1]
    for batch in batches:
        length, rank = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
        run = plan[np.searchsorted(keys, (length << 48) | rank, "right") - 1]
        sequence = run[:, 3] + rank - run[:, 1]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in ("doc_id", "piece", "start")], pa.array(length), batch.column("ids_crc32"), pa.array(sequence), pa.array(run[:, 4])],
            names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
        )


def tokenizer_files() -> tuple[str, str, str]:
    """The public byte-level BPE of 50,257 ids: tokenizer file, rank file, pattern."""
    import public_tokenizers

    name = "byte_bpe_50k"
    return public_tokenizers.path(f"{name}.json"), public_tokenizers.path(f"{name}.tiktoken"), public_tokenizers.PATTERN


def pack(docs: DataFrame, capacity: int = CAPACITY, files: tuple[str, str, str] | None = None) -> DataFrame:
    """One row per piece: where it comes from, and its sequence and offset there.

    ``files`` (tokenizer, ranks, pattern) must be readable on every executor
    under the same path. Columns: ``doc_id, piece, start, length, ids_crc32,
    sequence_id, offset``. NULL and empty texts are one piece of the end token.
    Repeated rows are packed each; NULL ids stay NULL. An empty table gives an
    empty result. Columns other than ``doc_id`` and ``text`` are not looked at.
    """
    texts = first_columns(docs, ["doc_id", "text"]).withColumn("doc_id", F.col("doc_id").cast("long"))
    cutter = partial(_pieces, capacity=capacity, files=files or tokenizer_files())
    pieces = stage_python(texts.mapInArrow(cutter, PIECES), "pieces", 512)
    by_task = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = by_task.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = np.array(sorted(plan_runs(counts, capacity)) or [(0, 0, 0, 0, 0)], np.int64)
    ranked = pieces.join(firsts, ["task", "length"]).withColumn("rank", F.col("place") + F.col("first"))
    rows = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return rows.mapInArrow(partial(_assign, plan=plan), PACKED)
