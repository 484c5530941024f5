"""Near-duplicate texts: universal hash minima, bands, verification, components.

1. Each text becomes the set of its distinct word shingles and, from it, ``bands
   * rows`` minima of universal hash functions (one pass of Arrow batches).
2. Texts with equal word sequences are collapsed to the smallest id; only its row
   goes on, so a group of exact copies costs one aggregation. Other rows of the other ids stay.
3. Texts that agree in a whole band share a bucket. Every bucket compares its members
   with its smallest one: as many pairs as members, however large the bucket.
4. Pairs are first verified on signatures and then on the full shingle sets;
   confirmed pairs are links, and alternating large-star and small-star steps
   turn links into components.
5. A bucket whose members now lie in several components may still hide a link
   between members that are both unlike the first. The members of such open
   buckets, and only they, are grouped by the smallest member of their bucket, dealt into
   chunks, and compared chunk by chunk on their full sets; only confirmed links between different
   components leave a chunk. So within a component no pair is listed, no
   candidate pair is listed at all, and no link between different components is
   lost. The work of this step grows with the square of a group of texts that
   are candidates of each other and yet not linked, spread over all tasks.

A pair of exactly the threshold 0.8 shares none of the 32 bands of 4 with a
probability of 5e-8; signatures drop a pair only if they agree in less than
``threshold - SLACK`` of the minima, which at 128 minima is more than six
standard deviations below the threshold.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residualkit.llm.frames import first_columns, stage_python
from residualkit.llm.graph import components
from residualkit.llm.words import hashed_runs, shingle_set, text_buffer
from residualkit.staging import stage

SLACK = 0.22
DROPPED_AT_MOST = 1 << 20
CHUNK = 64
CHUNKED = ("ids", "comps", "signs", "sets")
COLUMNS = 8192
PIECE = 1024


def hash_functions(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and offsets of ``n`` multiply-shift hash functions on 64 bits."""
    rng = np.random.default_rng(seed)
    factors = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return factors, rng.integers(0, 1 << 63, n, dtype=np.uint64)


def minima(shingle_hashes: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The high 32 bits of the smallest value of each hash function over the set."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingle_hashes), PIECE):
        values = factors[:, None] * shingle_hashes[None, i : i + PIECE]
        values += offsets[:, None]
        np.minimum(least, values.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype("<u4")


SIGNED = "id long, n_shingles long, print binary, signature binary"


def _sign(batches: Iterator[pa.RecordBatch], k: int, n: int, seed: int) -> Iterator[pa.RecordBatch]:
    factors, offsets = hash_functions(n, seed)
    for batch in batches:
        words, bounds = hashed_runs(*text_buffer(batch.column(1)))
        sizes, prints, signatures = [], [], []
        for i in range(batch.num_rows):
            own = words[bounds[i] : bounds[i + 1]]
            found = shingle_set(own, k)
            sizes.append(len(found))
            prints.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
            signatures.append(minima(found, factors, offsets).tobytes() if len(own) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(signatures, pa.binary())],
            names=["id", "n_shingles", "print", "signature"],
        )


def _verify(batches: Iterator[pa.RecordBatch], k: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose full shingle sets are at least ``percent`` per cent alike."""
    empty = np.zeros(0, np.uint64)
    words, own_set = empty, empty  # of the last left text; equal ones often follow each other
    for batch in batches:
        a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        left, left_bounds = hashed_runs(*text_buffer(batch.column(2)))
        right, right_bounds = hashed_runs(*text_buffer(batch.column(3)))
        keep = []
        for i in range(len(a)):
            own = left[left_bounds[i] : left_bounds[i + 1]]
            if not np.array_equal(words, own):
                words, own_set = own, shingle_set(own, k)
            x, y = own_set, shingle_set(right[right_bounds[i] : right_bounds[i + 1]], k)
            if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                continue
            common = len(np.intersect1d(x, y, assume_unique=True))
            if common and 100 * common >= percent * (len(x) + len(y) - common):
                keep.append(i)
        yield pa.RecordBatch.from_arrays(
            [pa.array([a[i] for i in keep], pa.int64()), pa.array([b[i] for i in keep], pa.int64())], names=["a", "b"]
        )


def _agree(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures agree in at least ``least`` of the minima."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").reshape(batch.num_rows, -1) for c in (2, 3))
        keep = np.flatnonzero((x == y).mean(axis=1) >= least)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(keep), batch.column(1).take(keep)], names=["a", "b"])


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The sorted distinct shingles of each text."""
    for batch in batches:
        words, bounds = hashed_runs(*text_buffer(batch.column(1)))
        found = [shingle_set(words[bounds[i] : bounds[i + 1]], k).tobytes() for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["id", "shingles"])


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of two lists, by matrix products over slices of the shingles."""
    sizes = [len(x) for x in (*left, *right)]
    every = np.concatenate([*left, *right])
    order = np.argsort(every, kind="stable")
    every = every[order]
    owner = np.repeat(np.arange(len(sizes)), sizes)[order]
    column = np.concatenate([[0], np.cumsum(every[1:] != every[:-1])])
    counts = np.zeros((len(left), len(right)), np.float32)
    for begin in range(0, int(column[-1]) + 1, COLUMNS):
        low, high = np.searchsorted(column, (begin, begin + COLUMNS))
        has = np.zeros((len(sizes), COLUMNS), np.float32)
        has[owner[low:high], column[low:high] - begin] = 1
        counts += has[: len(left)] @ has[len(left) :].T
    return np.rint(counts).astype(np.int64)


def _chunk_links(batches: Iterator[pa.RecordBatch], least: float, percent: int) -> Iterator[pa.RecordBatch]:
    """Links between two chunks: different components, agreeing signatures, full sets alike."""
    for batch in batches:
        rows = batch.to_pydict()
        for ids, ids2, comps, comps2, signs, signs2, sets, sets2 in zip(
            *[rows[c] for c in ("ids", "ids2", "comps", "comps2", "signs", "signs2", "sets", "sets2")], strict=True
        ):
            x = np.frombuffer(b"".join(signs), "<u4").reshape(len(ids), -1)
            y = np.frombuffer(b"".join(signs2), "<u4").reshape(len(ids2), -1)
            alike = (x[:, None, :] == y[None, :, :]).mean(axis=2) >= least
            alike &= np.asarray(comps)[:, None] != np.asarray(comps2)[None, :]
            i, j = np.flatnonzero(alike.any(axis=1)), np.flatnonzero(alike.any(axis=0))
            if not len(i):
                continue
            left, right = ([np.frombuffer(own[n], np.uint64) for n in at] for own, at in ((sets, i), (sets2, j)))
            common = common_counts(left, right)
            union = np.array([len(s) for s in left])[:, None] + np.array([len(s) for s in right])[None, :] - common
            at, to = np.nonzero((100 * common >= percent * union) & alike[np.ix_(i, j)])
            a, b = np.asarray(ids, np.int64)[i[at]], np.asarray(ids2, np.int64)[j[to]]
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    k: int = 5,
    percent: int = 80,
    bands: int = 32,
    rows: int = 4,
    seed: int = 7,
) -> DataFrame:
    """One row per id: its set size, the smallest id reachable over links, and whether it is that id.

    Two texts are linked if 100 * |intersection| >= ``percent`` * |union| of
    their shingle sets. Words are runs of characters other than ASCII white
    space, A to Z lower-cased; a shingle is ``k`` words, and a text of fewer
    words is one shingle.

    Returns ``id_column``, ``n_shingles`` long, ``component_id`` long, ``kept`` boolean.
    NULL, empty or blank texts have no shingles and are linked with nothing.
    Rows that repeat an id are one document whose links are those of all its
    rows; ``n_shingles`` is then the largest. Rows with a NULL id are linked with
    nothing, have a NULL ``component_id`` and are kept. An empty table gives an
    empty result. Other columns of ``docs`` are not looked at.
    """
    texts = first_columns(docs, [id_column, text_column]).toDF("id", "text").withColumn("id", F.col("id").cast("long"))
    sign = partial(_sign, k=k, n=bands * rows, seed=seed)
    signed = stage_python(texts.mapInArrow(sign, SIGNED), "signed")
    usable = signed.filter("id is not null and signature is not null")

    groups = usable.groupBy("print").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    copies = stage(groups.filter("n > 1").select("print", "first"), "copies")
    copied = usable.select("id", "print").join(copies, "print").filter("id <> first")
    alias = stage(copied.select("id", "print", "first").distinct(), "alias")
    # Only the copied row of an id goes; a row of the same id with another text is a representative like any other.
    single = usable.select("id", "print", "signature").join(alias.select("id", "print"), ["id", "print"], "left_anti")
    leads = stage(single.select("id", "signature"), "signatures")
    linked = _links(leads, texts, k, percent, bands, rows)

    edges = linked.select("a", "b").unionByName(alias.select(F.col("id").alias("a"), F.col("first").alias("b")))
    reached = stage(components(edges), "components")
    known_ids = signed.filter("id is not null").groupBy("id").agg(F.max("n_shingles").alias("n_shingles"))
    component = F.coalesce(F.col("component"), F.col("id"))
    answered = known_ids.join(reached.withColumnRenamed("node", "id"), "id", "left").select(
        F.col("id").alias(id_column),
        "n_shingles",
        component.alias("component_id"),
        (F.col("id") == component).alias("kept"),
    )
    nameless = signed.filter("id is null").select(
        F.col("id").alias(id_column), "n_shingles", F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept")
    )
    return answered.unionByName(nameless)


def without_near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", k: int = 5, percent: int = 80, ids_at_most: int = DROPPED_AT_MOST
) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its group of near-duplicates, with all their columns.

    The ids that go are broadcast if there are at most ``ids_at_most``, so that texts are not shuffled; more are joined by a
    shuffle. Rows with a NULL id stay, rows that repeat an id stay or go together. An empty table gives an empty result.
    """
    answered = near_duplicates(docs, id_column, k=k, percent=percent)
    gone = stage(answered.filter("not kept").select(id_column), "duplicate_ids")
    return docs.join(F.broadcast(gone) if gone.count() <= ids_at_most else gone, id_column, "left_anti").select(*docs.columns)


def _links(leads: DataFrame, texts: DataFrame, k: int, percent: int, bands: int, rows: int) -> DataFrame:
    """Links between representatives that give all components: those found first, as stars, and those across them."""
    width = 4 * rows
    keys = [F.xxhash64(F.lit(b), F.substring("signature", b * width + 1, width)) for b in range(bands)]
    banded = leads.select("id", F.explode(F.array(*keys)).alias("bucket"))
    counted = banded.groupBy("bucket").agg(F.min("id").alias("lead"), F.count(F.lit(1)).alias("n"))
    buckets = stage(counted.filter("n > 1"), "buckets")
    members = stage(banded.join(buckets, "bucket"), "members")

    least = max(0.0, percent / 100 - SLACK)
    pairs = members.filter("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    found = _confirmed(_signature_check(pairs, leads, least), texts, k, percent)

    reached = stage(components(found), "reached")
    placed = members.join(reached.withColumnRenamed("node", "id"), "id", "left").withColumn(
        "comp", F.coalesce("component", "id")
    )
    spread = placed.groupBy("bucket").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"), F.count(F.lit(1)).alias("size")
    )
    open_buckets = stage(spread.filter("low <> high and size > 2").select("bucket", "size"), "open")
    opened = placed.join(open_buckets, "bucket").select(F.col("lead").alias("group"), "id", "comp").distinct()
    across = _links_across(stage(opened, "opened"), leads, texts, k, percent, least)
    return reached.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(across)


def _links_across(
    opened: DataFrame, leads: DataFrame, texts: DataFrame, k: int, percent: int, least: float
) -> DataFrame:
    """Links between texts of a group that lie in different components."""
    ids = stage(opened.select("id").distinct(), "opened_ids")
    wanted = texts.join(ids, "id").select("id", "text")
    sets = stage_python(wanted.mapInArrow(partial(_sets, k=k), "id long, shingles binary"), "sets", 128)
    sizes = stage(opened.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks")), "sizes")
    dealt = opened.join(sizes, "group").withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
    packed = (
        dealt.join(leads.join(ids, "id", "left_semi"), "id")
        .join(sets, "id")
        .groupBy("group", "chunk")
        .agg(F.collect_list(F.struct("id", "comp", "signature", "shingles")).alias("m"))
        .select(
            "group",
            "chunk",
            *[F.col(f"m.{c}").alias(n) for c, n in zip(("id", "comp", "signature", "shingles"), CHUNKED, strict=True)],
        )
    )
    chunks = stage(packed, "chunks")
    places = sizes.withColumn("chunk", F.explode(F.expr("sequence(0, chunks - 1)")))
    pairs = places.withColumn("chunk2", F.explode(F.expr("sequence(chunk, chunks - 1)"))).drop("chunks")
    second = chunks.select("group", *[F.col(c).alias(f"{c}2") for c in ("chunk", *CHUNKED)])
    facing = pairs.join(chunks, ["group", "chunk"]).join(second, ["group", "chunk2"]).drop("group", "chunk", "chunk2")
    compare = partial(_chunk_links, least=least, percent=percent)
    return stage_python(facing.mapInArrow(compare, "a long, b long"), "across", 4)


def _of_pairs(rows: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of the first and of the second ids of staged pairs. First ids are few, so the other rows are not shuffled to meet them."""
    heads = stage(pairs.select(F.col("a").alias("id")).distinct(), "heads")
    return rows.join(heads, "id", "left_semi"), rows


def _signature_check(pairs: DataFrame, leads: DataFrame, least: float) -> DataFrame:
    pairs = stage(pairs, "candidate_pairs")
    of_a, of_b = _of_pairs(leads, pairs)
    left, right = (own.select(F.col("id").alias(c), F.col("signature").alias(f"s{c}")) for c, own in (("a", of_a), ("b", of_b)))
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "sa", "sb")
    return stage_python(joined.mapInArrow(partial(_agree, least=least), "a long, b long"), "alike", 2048)


def _confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs confirmed on the full shingle sets of one text of each id (repeated ids: every combination)."""
    of_a, of_b = _of_pairs(texts, pairs)
    left, right = (own.select(F.col("id").alias(c), F.col("text").alias(f"t{c}")) for c, own in (("a", of_a), ("b", of_b)))
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "ta", "tb")
    confirm = partial(_verify, k=k, percent=percent)
    return stage_python(joined.mapInArrow(confirm, "a long, b long"), "confirmed", 128)
