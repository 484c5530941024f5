"""Ranked lexical search, exact, by grouping documents of equal presence masks.

*Index.* One pass over the whole texts gives shards: for a block of documents
their lengths and, for every term that some item may use, the documents that
hold it and how often. Which terms those are is asked of a bitmap of
fixed size over term hashes: a term that only shares a bit with one in use
costs space and never changes a result, however many terms the items have.

*Search.* In a shard, each term of an item is a bitmap over the documents. Taken
together, column by column, they give every document its mask: which terms of the item
it holds. Documents of one mask form a group, and the largest contribution
of each term in the shard bounds the scores of the group. Groups are evaluated by descending
bound, until the next bound is below the k-th best score that is known:
then no other group can matter. Scores are 64-bit integers, so ties are exact.

Items are measured: if small, every task gets them all and carries its best
results from shard to shard; otherwise blocks of items are sent to slots of shards.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from residualkit.llm.frames import first_columns, stage_python
from residualkit.llm.words import hashed_runs, text_buffer
from residualkit.staging import stage

SHARD_DOCS = 4096
SHARD_POSTINGS = 1 << 21
BITMAP = 1 << 20
ITEM_BLOCK = 64
ITEM_BYTES = 8 << 20
EVALUATE = 32


def term_classes(b: np.ndarray) -> np.ndarray:
    """1 for digits, letters and bytes of longer codes, else 0."""
    letter = ((b | np.uint8(32)) - np.uint8(97)) < 26
    return (letter | ((b - np.uint8(48)) < 10) | (b >= 128)).astype(np.uint8)


def counted_terms(column: pa.Array, bitmap: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lengths of all texts in terms; and of each distinct term of a text that passes the bitmap: text, hash, occurrences."""
    hashes, bounds = hashed_runs(*text_buffer(column), term_classes)
    lengths = np.diff(bounds)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    if bitmap is not None:
        keep = bitmap[hashes & np.uint64(BITMAP - 1)]
        hashes, owner = hashes[keep], owner[keep]
    terms, place = np.unique(hashes, return_inverse=True)
    keys, times = np.unique(owner * max(1, len(terms)) + place, return_counts=True)
    owner, place = np.divmod(keys, max(1, len(terms)))
    return lengths, owner, terms[place], times


class Postings(NamedTuple):
    """A block of documents: ids and lengths, and for each term, ascending, its documents and their counts."""

    ids: np.ndarray
    known: np.ndarray
    lengths: np.ndarray
    terms: np.ndarray
    starts: np.ndarray
    places: np.ndarray
    times: np.ndarray


POSTINGS = (
    "shard long, counted long, total long, ids binary, known binary, lengths binary, "
    "terms binary, starts binary, places binary, times binary"
)
KINDS = (np.int64, bool, np.int64, np.uint64, np.int64, np.uint16, np.int32)


def _posting_shards(batches: Iterator[pa.RecordBatch], bitmap: np.ndarray) -> Iterator[pa.RecordBatch]:
    shard = TaskContext.get().partitionId() << 36
    held: list[tuple[np.ndarray, ...]] = []
    docs = postings = 0

    def packed() -> pa.RecordBatch:
        ids, known, lengths, owner, term, times = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.lexsort((owner, term))
        terms, starts = np.unique(term[order], return_index=True)
        parts = (ids, known, lengths, terms, np.append(starts, len(order)), owner[order], times[order])
        raw = [pa.array([p.astype(k).tobytes()], pa.binary()) for p, k in zip(parts, KINDS, strict=True)]
        head = [pa.array([v], pa.int64()) for v in (shard, int((lengths > 0).sum()), int(lengths.sum()))]
        return pa.RecordBatch.from_arrays([*head, *raw], names=[c.split()[0] for c in POSTINGS.split(", ")])

    for batch in batches:
        for begin in range(0, batch.num_rows, SHARD_DOCS):
            part = batch.slice(begin, SHARD_DOCS)
            if docs and (docs + part.num_rows > SHARD_DOCS or postings >= SHARD_POSTINGS):
                yield packed()
                held, docs, postings, shard = [], 0, 0, shard + 1
            lengths, owner, term, times = counted_terms(part.column(1), bitmap)
            ids = part.column(0)
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            held.append((ids.fill_null(0).to_numpy(zero_copy_only=False), known, lengths, owner + docs, term, times))
            docs, postings = docs + part.num_rows, postings + len(owner)
    if docs:
        yield packed()


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for terms, starts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            df = np.diff(np.frombuffer(starts, np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(terms, np.uint64).view(np.int64)), pa.array(df)], names=["term", "df"]
            )


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, owner, term, times = counted_terms(batch.column(1), None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(owner)), pa.array(term.view(np.int64)), pa.array(times.astype(np.int64))],
            names=["item_id", "term", "repeats"],
        )


class Item(NamedTuple):
    """An item's distinct terms, ascending, with weight times repeats."""

    item_id: int | None
    terms: np.ndarray
    weights: np.ndarray


class Corpus(NamedTuple):
    """Documents with a term, and all their terms with repeats."""

    documents: int
    total: int


class Best(NamedTuple):
    """The best results of an item so far, best first."""

    scores: np.ndarray
    ids: np.ndarray
    known: np.ndarray

    @classmethod
    def none(cls) -> Best:
        return cls(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))

    def with_more(self, scores: np.ndarray, ids: np.ndarray, known: np.ndarray, k: int) -> Best:
        """Ties by id, unknown ids last."""
        every = [np.concatenate(pair) for pair in zip(self, (scores, ids, known), strict=True)]
        order = np.lexsort((every[1], ~every[2], -every[0]))[:k]
        return Best(*[column[order] for column in every])


def masks_of(bitmaps: np.ndarray) -> np.ndarray:
    """The presence mask of every document, 64 terms a word, from one bitmap for each term."""
    words = -(-len(bitmaps) // 64)
    packed = np.zeros((words * 8, bitmaps.shape[1]), np.uint8)
    rows = np.packbits(bitmaps, axis=0, bitorder="little")
    packed[: len(rows)] = rows
    return np.ascontiguousarray(packed.T).view("<u8")


def grouped(masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct masks, and which of them each document has."""
    if masks.shape[1] == 1:
        distinct, group = np.unique(masks[:, 0], return_inverse=True)
        return distinct[:, None], group
    distinct, group = np.unique(masks, axis=0, return_inverse=True)
    return distinct, group.reshape(-1)


class ShardSearch:
    """Items against one shard."""

    def __init__(self, postings: Postings, corpus: Corpus, k: int) -> None:
        self.p, self.k = postings, k
        norm = [100 - 75 + 75 * n * corpus.documents // corpus.total for n in postings.lengths.tolist()]
        m, times = np.array(norm, np.int64)[postings.places], postings.times.astype(np.int64)
        self.gains = 1_000_000_000 * times // (1000 * times + 8 * m)
        self.tops = np.maximum.reduceat(self.gains, postings.starts[:-1]) if len(postings.terms) else self.gains
        self.evaluated = 0

    def search(self, items: Sequence[Item], best: dict[int, Best]) -> None:
        """Update ``best``, by place of the item in ``items``."""
        wanted = np.unique(np.concatenate([item.terms for item in items]))
        at = np.searchsorted(self.p.terms, wanted)
        there = at < len(self.p.terms)
        there[there] = self.p.terms[at[there]] == wanted[there]
        wanted, at = wanted[there], at[there]
        bitmaps = np.zeros((len(wanted), len(self.p.ids)), bool)
        for row, term in enumerate(at):
            bitmaps[row, self.p.places[self.p.starts[term] : self.p.starts[term + 1]]] = True
        for i, item in enumerate(items):
            row = np.searchsorted(wanted, item.terms)
            own = row < len(wanted)
            own[own] = wanted[row[own]] == item.terms[own]
            own &= item.weights > 0
            if own.any():
                best[i] = self._item(bitmaps[row[own]], at[row[own]], item.weights[own], best.get(i, Best.none()))

    def _item(self, bitmaps: np.ndarray, terms: np.ndarray, weights: np.ndarray, best: Best) -> Best:
        holders = np.flatnonzero(bitmaps.any(axis=0))
        distinct, group = grouped(masks_of(bitmaps[:, holders]))
        bits = np.unpackbits(distinct.view(np.uint8), axis=1, count=len(terms), bitorder="little")
        bounds = bits.astype(np.int64) @ (weights * self.tops[terms])
        docs = holders[np.argsort(-bounds[group], kind="stable")]
        limits = np.sort(bounds[group])[::-1]
        for begin in range(0, len(docs), EVALUATE):
            if len(best.scores) == self.k and limits[begin] < best.scores[-1]:
                break
            some = docs[begin : begin + EVALUATE]
            self.evaluated += len(some)
            best = best.with_more(self._scores(some, bitmaps, terms, weights), self.p.ids[some], self.p.known[some], self.k)
        return best

    def _scores(self, docs: np.ndarray, bitmaps: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        total = np.zeros(len(docs), np.int64)
        for row, term, weight in zip(bitmaps, terms, weights, strict=True):
            hit = np.flatnonzero(row[docs])
            start, end = self.p.starts[term : term + 2]
            total[hit] += weight * self.gains[start + np.searchsorted(self.p.places[start:end], docs[hit])]
        return total


FOUND = "item_id long, doc_id long, score long"


def _found(items: Sequence[Item], best: dict[int, Best]) -> pa.RecordBatch:
    rows = [
        (items[i].item_id, d if known else None, s)
        for i, own in best.items()
        for s, d, known in zip(own.scores.tolist(), own.ids.tolist(), own.known.tolist(), strict=True)
    ]
    columns = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item_id", "doc_id", "score"])


def _postings(row: dict) -> Postings:
    names = ("ids", "known", "lengths", "terms", "starts", "places", "times")
    return Postings(*[np.frombuffer(row[c], k) for c, k in zip(names, KINDS, strict=True)])


def item_of(row: dict) -> Item:
    parts = sorted(zip(np.array(row["terms"], np.int64).view(np.uint64).tolist(), row["weights"], strict=True))
    return Item(row["item_id"], np.array([t for t, _ in parts], np.uint64), np.array([w for _, w in parts], np.int64))


def _search_all(batches: Iterator[pa.RecordBatch], items: list[dict], corpus: Corpus, k: int) -> Iterator[pa.RecordBatch]:
    """All items against the shards of a task; what is best goes along from shard to shard."""
    blocks = [[item_of(r) for r in items[i : i + ITEM_BLOCK]] for i in range(0, len(items), ITEM_BLOCK)]
    best: list[dict[int, Best]] = [{} for _ in blocks]
    for batch in batches:
        for row in batch.to_pylist():
            shard = ShardSearch(_postings(row), corpus, k)
            for block, own in zip(blocks, best, strict=True):
                shard.search(block, own)
    for block, own in zip(blocks, best, strict=True):
        yield _found(block, own)


def _search_block(batches: Iterator[pa.RecordBatch], corpus: Corpus, k: int) -> Iterator[pa.RecordBatch]:
    """One block of items against one shard, row by row."""
    for batch in batches:
        for row in batch.to_pylist():
            best: dict[int, Best] = {}
            block = [item_of(item) for item in row["items"]]
            ShardSearch(_postings(row), corpus, k).search(block, best)
            yield _found(block, best)


def weighted_items(items: DataFrame, frequencies: DataFrame, corpus: Corpus) -> DataFrame:
    """One row for each item that has a term: its terms and their weights times repeats."""
    counted = items.join(frequencies, "term", "left").fillna(0, ["df"])
    ratio = F.lit(2.0 * corpus.documents + 2) / (2 * F.col("df") + 1).cast("double")
    weight = F.floor(F.lit(1000.0) * F.log(ratio)).cast("long") * F.col("repeats")
    listed = counted.groupBy("item_id").agg(F.collect_list(F.struct("term", weight.alias("weight"))).alias("t"))
    return listed.select("item_id", F.col("t.term").alias("terms"), F.col("t.weight").alias("weights"))


def ranked(
    docs: DataFrame, items: DataFrame, k: int = 10, items_at_most: int = ITEM_BYTES
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` highest-scoring documents of each item, scores above 0.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, A to Z
    lower-cased, of whole texts. The score adds, over the terms of the item with repeats, w * (10**9 * tf div (1000 * tf + 8 * m)),
    where w = floor(1000 * ln((2N + 2) / (2df + 1))) and m = 25 + (75 * n * N div L).
    Equal scores go to the smaller ``doc_id``, unknown ones last.

    NULL and empty texts have no terms. Every row of ``docs`` is a document, also with a NULL or
    repeated id. Rows that repeat an ``item_id`` are one item (the smallest text, if they differ); a NULL id is an
    item too. Empty tables give an empty result. Other columns are not looked at.
    Items of at most ``items_at_most`` bytes go to all tasks; more are sent in blocks.
    """
    spark = docs.sparkSession
    texts = first_columns(docs, ["doc_id", "text"]).withColumn("doc_id", F.col("doc_id").cast("long"))
    asked = first_columns(items, ["item_id", "text"]).withColumn("item_id", F.col("item_id").cast("long"))
    one = asked.groupBy("item_id").agg(F.min("text").alias("text"))
    terms = stage_python(one.mapInArrow(_item_terms, "item_id long, term long, repeats long"), "item_terms")
    bitmap = np.zeros(BITMAP, bool)
    used = terms.select(F.col("term").bitwiseAND(F.lit(BITMAP - 1)).alias("bit")).distinct().toArrow()
    bitmap[used.column(0).to_numpy()] = True

    shards = stage_python(texts.mapInArrow(partial(_posting_shards, bitmap=bitmap), POSTINGS), "postings", 512)
    sums = shards.agg(F.sum("counted"), F.sum("total")).first()
    corpus = Corpus(int(sums[0] or 0), max(1, int(sums[1] or 0)))
    each = shards.select("terms", "starts").mapInArrow(_document_frequencies, "term long, df long")
    frequencies = each.groupBy("term").agg(F.sum("df").alias("df"))
    weighted = stage_python(weighted_items(terms, frequencies, corpus), "items", 16)

    size = weighted.agg(F.sum(16 * F.size("terms") + 64)).first()[0] or 0
    if size <= items_at_most:
        run = partial(_search_all, items=[r.asDict() for r in weighted.collect()], corpus=corpus, k=k)
        found = stage_python(shards.mapInArrow(run, FOUND), "found", 1)
    else:
        slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
        blocks = -(-weighted.count() // ITEM_BLOCK)
        block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
        packed = weighted.groupBy(block.alias("block")).agg(F.collect_list(F.struct(*weighted.columns)).alias("items"))
        sent = stage(packed, "item_blocks").withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
        dealt = shards.withColumn("slot", F.pmod(F.xxhash64("shard"), F.lit(slots)).cast("int"))
        facing = dealt.join(sent, "slot").drop("slot", "block")
        found = stage_python(facing.mapInArrow(partial(_search_block, corpus=corpus, k=k), FOUND), "found", 1)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.filter("score > 0").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.select("item_id", "rank", "doc_id", "score")
