"""Alignment of two tokenizers over a corpus, with a fast path for tokens that are the same bytes.

A is a byte-level BPE, B a piece BPE that puts a blank before the text, so both
spell the bytes of blank + text. The byte offsets at which tokens of both end cut
a text into groups; the offsets at which a token of either ends cut it into stretches, and
each stretch is one link: the pair of tokens that lie over it.

*Identity map.* An array over the ids of A holds the id of B with the same
bytes, or -1. Links of an id with its image, which is what groups of one token each
are made of, are counted in vectors as long as the vocabulary of A, one a task;
they never enter a shuffle of pairs. Only the other links, from irregular groups, become pairs
``(a, b)``; a task counts them before they are shuffled.

*Two readings, one tokenisation.* The first pass tokenises and writes, for each
document, its counts, the digest of its groups and its distinct links with how
often each occurs. What is read afterwards is this table alone. Counts of pairs
go to the tasks as arrays if there are at most ``pairs_at_most``; otherwise the
pairs of the documents are joined with them by a shuffle join that splits hot pairs.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from array import array
from collections.abc import Iterator, Sequence
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residualkit.llm.frames import first_columns, stage_python
from residualkit.operators.lookup import keyed_join
from residualkit.staging import stage

SLICE_BYTES = 4 << 20
HELD_PAIRS = 1 << 21
PAIRS_AT_MOST = 1 << 21
# Beyond these characters two libraries may know different classes; long blank runs exhaust the stack of one of them.
_SLOW = re.compile("[^\\x00-\u024f]|\\s{512}")


class Files(NamedTuple):
    """Tokenizer files; each must be readable on every executor under the same path."""

    byte_tokenizer: str
    byte_ranks: str
    byte_pattern: str
    piece_model: str


def public_files() -> Files:
    import public_tokenizers as public

    name = "byte_bpe_50k"
    return Files(public.path(f"{name}.json"), public.path(f"{name}.tiktoken"), public.PATTERN, public.path("piece_bpe_32k.model"))


def byte_letters() -> dict[str, int]:
    """The letter of byte-level vocabularies for every byte: itself if it prints, else the next free one from U+0100."""
    printing = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in printing}
    others = [b for b in range(256) if b not in set(printing)]
    return letters | {chr(256 + i): b for i, b in enumerate(others)}


def byte_vocabulary(tokenizer_file: str) -> list[bytes]:
    """The bytes of each id of a byte-level BPE."""
    with open(tokenizer_file, encoding="utf-8") as file:
        described = json.load(file)
    letters = byte_letters()
    found = {i: bytes(letters[c] for c in token) for token, i in described["model"]["vocab"].items()}
    found |= {t["id"]: t["content"].encode() for t in described["added_tokens"]}
    return [found.get(i, b"") for i in range(max(found) + 1)]


def piece_vocabulary(model) -> list[bytes]:
    """The bytes of each id of a piece model: U+2581 is a blank, a byte piece its byte, a control piece nothing."""
    found = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            found.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i):
            found.append(b"")
        else:
            found.append(piece.replace("▁", " ").encode())
    return found


class Tokenizers:
    """Both tokenizers, the bytes of their ids, and the identity map."""

    def __init__(self, files: Files) -> None:
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        with open(files.byte_ranks, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=files.byte_pattern, mergeable_ranks=ranks, special_tokens={})
        self.full = Tokenizer.from_file(files.byte_tokenizer)
        self.full.encode_special_tokens = True
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=files.piece_model)
        self.bytes_a, self.bytes_b = byte_vocabulary(files.byte_tokenizer), piece_vocabulary(self.pieces)
        self.lengths_a, self.lengths_b = (np.array([len(t) for t in v], np.int64) for v in (self.bytes_a, self.bytes_b))
        of_bytes = {t: i for i, t in reversed(list(enumerate(self.bytes_b))) if t}
        self.image = np.array([of_bytes.get(t, -1) for t in self.bytes_a], np.int64)
        width = max(len(self.bytes_a), len(self.bytes_b))
        self.decimals = np.array([[f"{i}{end}".encode() for i in range(width)] for end in (",", "|", ";", "")], "S8")

    def encode_a(self, text: str) -> array:
        if _SLOW.search(text):
            return array("I", self.full.encode(text, add_special_tokens=False).ids)
        return array("I", self.fast.encode_ordinary(text))

    def both(self, text: str | None) -> tuple[array, array]:
        """Ids of blank + text by A and of the text by B; none if either does not spell the bytes."""
        none = array("I"), array("I")
        if not text:
            return none
        raw = b" " + text.encode()
        a, b = self.encode_a(" " + text), array("I", self.pieces.encode(text))
        if b"".join(map(self.bytes_b.__getitem__, b)) != raw or b"".join(map(self.bytes_a.__getitem__, a)) != raw:
            return none
        return a, b


_tokenizers: dict[Files, Tokenizers] = {}


def tokenizers(files: Files) -> Tokenizers:
    """One pair for each worker process."""
    if files not in _tokenizers:
        _tokenizers[files] = Tokenizers(files)
    return _tokenizers[files]


class Aligned(NamedTuple):
    """Documents laid end to end on one line of bytes: tokens, groups, and links."""

    a: np.ndarray
    b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    links: np.ndarray  # rows: document, id of A, id of B
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray


def align(ids: Sequence[tuple[array, array]], lengths_a: np.ndarray, lengths_b: np.ndarray) -> Aligned:
    """Groups and links of several documents at once."""
    n = len(ids)
    n_a, n_b = (np.array([len(pair[i]) for pair in ids], np.int64) for i in (0, 1))
    a, b = (np.frombuffer(b"".join(pair[i].tobytes() for pair in ids), np.uint32).astype(np.int64) for i in (0, 1))
    ends_a, ends_b = np.cumsum(lengths_a[a]), np.cumsum(lengths_b[b])
    width = int(ends_a[-1]) + 1 if len(ends_a) else 1
    at_a, at_b = np.zeros(width, bool), np.zeros(width, bool)
    at_a[ends_a], at_b[ends_b] = True, True
    passed = [np.cumsum(marks, dtype=np.int64) for marks in (at_a, at_b, at_a & at_b)]  # ends up to each offset
    stretch = np.flatnonzero(at_a | at_b)
    closing = np.concatenate([[0], ends_a])[np.cumsum(n_a)]  # where each document ends on the line
    owner = np.searchsorted(closing, stretch, "left")
    cut_owner = np.searchsorted(closing, np.flatnonzero(at_a & at_b), "left")
    links = np.stack([owner, a[passed[0][stretch - 1]], b[passed[1][stretch - 1]]])
    return Aligned(
        a, b, passed[2][ends_a - 1], passed[2][ends_b - 1], links, n_a, n_b,
        np.bincount(cut_owner, minlength=n), np.bincount(owner, minlength=n),
    )


def spelled_groups(found: Aligned, decimals: np.ndarray) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` for each document: decimal ids, groups in order."""
    groups = int(found.n_groups.sum())
    size_a, size_b = (np.bincount(g, minlength=groups) for g in (found.group_a, found.group_b))
    place_a = np.arange(len(found.a)) + (np.cumsum(size_b) - size_b)[found.group_a]
    place_b = np.arange(len(found.b)) + np.cumsum(size_a)[found.group_b]
    end_a, end_b = (np.zeros(len(x), np.int64) for x in (found.a, found.b))
    end_a[np.cumsum(size_a) - 1] = 1
    end_b[np.cumsum(size_b) - 1] = 2
    last = np.cumsum(found.n_b)[found.n_b > 0] - 1
    end_b[last] = 3
    written = np.empty(len(found.a) + len(found.b), decimals.dtype)
    written[place_a], written[place_b] = decimals[end_a, found.a], decimals[end_b, found.b]
    bounds = np.concatenate([[0], np.cumsum(found.n_a + found.n_b)])
    return [written[s:e].tobytes().translate(None, b"\0") for s, e in zip(bounds[:-1], bounds[1:], strict=True)]


ALIGNED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, "
    "same array<int>, same_times array<int>, a array<int>, b array<int>, times array<int>"
)


def _lists(owner: np.ndarray, n: int, *values: np.ndarray) -> list[pa.Array]:
    """List columns of ``n`` rows from values sorted by the row that owns them."""
    offsets = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
    return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(v.astype(np.int32))) for v in values]


def _rows(ids: list[int | None], texts: list[str | None], first: int, files: Files, spell: bool) -> pa.RecordBatch:
    own, n = tokenizers(files), len(ids)
    found = align([own.both(t) for t in texts], own.lengths_a, own.lengths_b)
    spelled = spelled_groups(found, own.decimals)
    digests = [hashlib.sha256(s).hexdigest() if s else "" for s in spelled]
    owner, a, b = found.links
    same = own.image[a] == b
    wide_a, wide_b = len(own.bytes_a), len(own.bytes_b)
    same_keys, same_times = np.unique((owner * wide_a + a)[same], return_counts=True)
    pair_keys, pair_times = np.unique(((owner * wide_a + a) * wide_b + b)[~same], return_counts=True)
    pair_owner, rest = np.divmod(pair_keys, wide_a * wide_b)
    columns = [
        pa.array(np.arange(first, first + n)),
        pa.array(ids, pa.int64()),
        *[pa.array(x.astype(np.int64)) for x in (found.n_a, found.n_b, found.n_groups, found.n_links)],
        pa.array(digests),
        pa.array([s.decode() if spell else None for s in spelled], pa.string()),
        *_lists(same_keys // wide_a, n, same_keys % wide_a, same_times),
        *_lists(pair_owner, n, rest // wide_b, rest % wide_b, pair_times),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in ALIGNED.split(", ")])


def _align_batches(batches: Iterator[pa.RecordBatch], files: Files, spell: bool) -> Iterator[pa.RecordBatch]:
    """Documents are aligned together up to a bound on their bytes; a longer one goes alone."""
    row = TaskContext.get().partitionId() << 36
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        begin = size = 0
        for i, text in enumerate(texts):
            size += len(text or "")
            if size >= SLICE_BYTES or i + 1 == len(texts):
                yield _rows(ids[begin : i + 1], texts[begin : i + 1], row, files, spell)
                row += i + 1 - begin
                begin, size = i + 1, 0


def aligned(docs: DataFrame, files: Files | None = None, spell: bool = False) -> DataFrame:
    """The first pass, written: one row for each document with its counts, groups and distinct links.

    ``same`` are the ids of A linked with their image, ``a`` and ``b`` the other
    links, and ``same_times`` and ``times`` how often each occurs. With ``spell``
    the groups themselves are kept beside their digest.
    """
    texts = first_columns(docs, ["doc_id", "text"]).withColumn("doc_id", F.col("doc_id").cast("long"))
    run = partial(_align_batches, files=files or public_files(), spell=spell)
    return stage_python(texts.mapInArrow(run, ALIGNED), "aligned", 512)


def _same_vector(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """In how many documents each id of A is linked with its image: one vector a task."""
    total = np.zeros(width, np.int64)
    for batch in batches:
        total += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=width)
    ids = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int32)), pa.array(total[ids])], names=["a", "n"])


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each irregular pair, counted within a task up to a bound on what it holds."""

    def counted(parts: list[np.ndarray]) -> pa.RecordBatch:
        keys, n = np.unique(np.concatenate(parts), return_counts=True)
        halves = [pa.array((keys >> 32).astype(np.int32)), pa.array((keys & 0xFFFFFFFF).astype(np.int32))]
        return pa.RecordBatch.from_arrays([*halves, pa.array(n.astype(np.int64))], names=["a", "b", "n"])

    held: list[np.ndarray] = []
    for batch in batches:
        held.append(pair_keys(batch.column(0), batch.column(1)))
        if sum(map(len, held)) >= HELD_PAIRS:
            yield counted(held)
            held = []
    if held:
        yield counted(held)


def pair_keys(a: pa.Array, b: pa.Array) -> np.ndarray:
    """One number for each pair of two list columns."""
    left, right = (c.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in (a, b))
    return (left << 32) | right


def same_counts(rows: DataFrame, width: int) -> DataFrame:
    """``a, n``: in how many documents an id of A is linked with its image; at most ``width`` rows."""
    each = rows.select("same").mapInArrow(partial(_same_vector, width=width), "a int, n long")
    return each.groupBy("a").agg(F.sum("n").alias("n"))


def pair_counts(rows: DataFrame) -> DataFrame:
    """``a, b, n``: in how many documents each irregular pair is linked."""
    each = rows.select("a", "b").mapInArrow(_pair_counts, "a int, b int, n long")
    return each.groupBy("a", "b").agg(F.sum("n").alias("n"))


SHOWN = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string"
TOTALS = f"{SHOWN}, n_best long, count_sum long"


class Counts(NamedTuple):
    """Vectors over the ids of A, and the counts of the pairs in the order of their keys (None: joined instead)."""

    same: np.ndarray
    best: np.ndarray
    keys: np.ndarray | None
    n: np.ndarray | None


def _totals(batches: Iterator[pa.RecordBatch], counts: Counts) -> Iterator[pa.RecordBatch]:
    """Links at their best count, and the sum of the counts of all links, of each document."""

    def add(lists: pa.Array, times: pa.Array, n: np.ndarray, a: np.ndarray) -> None:
        weight = times.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
        np.add.at(total, owner, weight * n)
        np.add.at(best, owner, weight * (n == counts.best[a]))

    for batch in batches:
        total, best = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
        ids = batch.column("same").flatten().to_numpy(zero_copy_only=False)
        add(batch.column("same"), batch.column("same_times"), counts.same[ids], ids)
        if counts.keys is not None and len(counts.keys):
            keys = pair_keys(batch.column("a"), batch.column("b"))
            add(batch.column("a"), batch.column("times"), counts.n[np.searchsorted(counts.keys, keys)], keys >> 32)
        names = [c.split()[0] for c in TOTALS.split(", ")]
        kept = [batch.column(c) for c in names[:-2]]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(best), pa.array(total)], names=names)


def _vector(rows: DataFrame, width: int) -> np.ndarray:
    """A vector over the ids of A from rows ``a, n``, of which there is at most one for each id."""
    found = rows.select("a", "n").toArrow()
    vector = np.zeros(width, np.int64)
    vector[found.column("a").to_numpy()] = found.column("n").to_numpy()
    return vector


def _written_totals(rows: DataFrame, counts: Counts) -> DataFrame:
    return stage_python(rows.mapInArrow(partial(_totals, counts=counts), TOTALS), "totals", 512)


def with_totals(rows: DataFrame, width: int, pairs_at_most: int = PAIRS_AT_MOST) -> DataFrame:
    """The aligned documents with ``n_best`` and ``count_sum``, from the counts over all of them."""
    same, pairs = stage_python(same_counts(rows, width), "same_counts", 512), stage_python(pair_counts(rows), "pair_counts", 512)
    every = same.unionByName(pairs.select("a", "n"))
    best = stage(every.groupBy("a").agg(F.max("n").alias("n")), "best_counts")
    vectors = _vector(same, width), _vector(best, width)
    if pairs.count() <= pairs_at_most:
        found = pairs.toArrow()
        a, b, n = (found.column(c).to_numpy() for c in ("a", "b", "n"))
        keys = (a.astype(np.int64) << 32) | b
        order = np.argsort(keys)
        return _written_totals(rows, Counts(*vectors, keys[order], n[order]))
    by_image = _written_totals(rows, Counts(*vectors, None, None))
    top = best.withColumnRenamed("n", "top")
    marked = pairs.join(F.broadcast(top), "a").select("a", "b", "n", (F.col("n") == F.col("top")).alias("is_best"))
    zipped = F.explode(F.arrays_zip("a", "b", "times"))
    each = stage(rows.select("row", zipped.alias("p")).select("row", "p.*"), "document_pairs")
    joined = keyed_join(each, stage(marked, "marked_pairs"), ["a", "b"])
    by_pair = joined.groupBy("row").agg(
        F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("pair_best"),
        F.sum(F.col("n") * F.col("times")).alias("pair_sum"),
    )
    more = [(F.col(c) + F.coalesce(F.col(p), F.lit(0))).alias(c) for c, p in (("n_best", "pair_best"), ("count_sum", "pair_sum"))]
    names = [c.split()[0] for c in SHOWN.split(", ")]
    return by_image.join(by_pair, "row", "left").select(*names, *more)


def alignment(
    docs: DataFrame, files: Files | None = None, pairs_at_most: int = PAIRS_AT_MOST, spell: bool = False
) -> DataFrame:
    """One row per document: its tokens by both tokenizers, its groups and links, and how common the links are.

    ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum`` long and
    ``groups_sha256`` string; with ``spell`` also ``groups``. The count of a pair
    of ids is the number of documents that hold it linked; ``count_sum`` adds it over all
    links, ``n_best`` counts the links whose count is the highest of their A id. Texts
    that are NULL or empty, or that either tokenizer does not spell byte for
    byte, have no tokens: zeros and ''. Each row is a document, rows with equal or NULL
    ids too. An empty table gives an empty result. Columns other than ``doc_id``
    and ``text`` are not looked at.

    At most ``pairs_at_most`` pair counts of 16 bytes go to the tasks; with more the pairs are
    joined by a shuffle.
    """
    given = files or public_files()
    rows = aligned(docs, given, spell)
    found = with_totals(rows, len(byte_vocabulary(given.byte_tokenizer)), pairs_at_most)
    return found.drop("row", *([] if spell else ["groups"]))
