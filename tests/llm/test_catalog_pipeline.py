"""Named queries against their SQL, and the pipeline stage by stage."""

import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest
from compare import connect, differences
from pyspark.sql import functions as F
from test_near_duplicates import brute_documents
from test_pii_classifiers import redacted

import corpus_pipeline
from residualkit.llm import catalog, packing, pii, toxicity
from residualkit.llm.frames import table
from residualkit.llm.mixing import word_count

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql() -> duckdb.DuckDBPyConnection:
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_matches_its_sql(spark, sql, name):
    result = catalog.QUERIES[name](spark, SMALL).toPandas()
    found = differences(result, sql.execute(catalog.ORACLE_SQL[name]).df())
    # A column without any value has no type of its own in a client.
    assert [d for d in found if not d.startswith("type of refers_to")] == []


def test_words_of_the_mixture_are_the_same_in_sql(spark):
    text = " a\tb\nc\x0bd\x0ce\rf  g\u00a0h\x1fi "
    pattern = catalog.ORACLE_SQL["op2_mix"].split("coalesce(text, ''), '")[1].split("'")[0]
    assert pattern == r"[^\x20\x09-\x0D]+"
    counted = duckdb.execute("select len(regexp_extract_all(?, ?))", [text, pattern]).fetchone()[0]
    row = spark.createDataFrame([(text,)], "text string").select(word_count(F.col("text")).alias("n")).first()
    assert counted == row.n == 7


def test_stages_keep_their_promises(spark):
    docs = table(spark, SMALL, "documents").cache()
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "minhash_dedup", "pii", "mixing", "packing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, before, SMALL).cache()
        assert docs.columns == before.columns
        kept[name] = {r.doc_id for r in docs.collect()}
        assert kept[name] <= {r.doc_id for r in before.select("doc_id").collect()}
    assert kept["pii"] == kept["minhash_dedup"]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == kept["mixing"]
    spark.catalog.clearCache()


def test_rows_without_id_pass_the_filters(spark):
    docs = spark.createDataFrame([(None, "some plain words in a row", None, None, None)] * 2, table(spark, SMALL, "documents").schema)
    for name, stage in corpus_pipeline.STAGES[:3]:
        assert stage(spark, docs, SMALL).count() == 2, name


ROWS = "doc_id long, text string, lang string, source string, n_chars long, epoch int, spans string"


def odd_documents(spark):
    """Nulls in every column, repeated rows and ids, empty and very long texts, and columns with names of the operators."""
    texts = ["plain words that say nothing special at all", None, "", "mail a@b.co now", "word " * 40_000, " " * 5000]
    rows = [(i, t, "en", "s", 1, 1, "x") for i, t in enumerate(texts)]
    rows += [(0, texts[0], "en", "s", 1, 1, "x"), (0, "another text of the same id, quite different", None, None, None, None, None)]
    rows += [(None, texts[0], None, "s", None, 2, None), (90, texts[0], "de", None, 5, 3, "y")]
    return spark.createDataFrame(rows, ROWS)


def test_stages_take_odd_rows_and_no_rows(spark):
    docs = odd_documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, SMALL)
        if name != "packing":
            assert got.columns == corpus_pipeline.COLUMNS, name
        ids = {r.doc_id for r in got.select("doc_id").collect()}
        if name != "mixing":
            assert ids == {0, 1, 2, 3, 4, 5, None} | (set() if name == "minhash_dedup" else {90}), name
        assert stage(spark, docs.limit(0), SMALL).count() == 0, name


def plain_pipeline(spark):
    """The stages chained by their plain versions: row by row and pair by pair, on what the one before kept."""
    docs = table(spark, SMALL, "documents")
    weights = toxicity.fit_toxicity(docs, table(spark, SMALL, "labels"))
    scores = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, weights).collect()}
    rows = [r for r in docs.collect() if scores[r.doc_id] < 0.5]
    found = brute_documents([(r.doc_id, r.text) for r in rows], 5, 80)
    rows = [r for r in rows if found[r.doc_id][1] == r.doc_id]
    kept = spark.createDataFrame(rows, docs.schema)
    spans = {r.doc_id: r.spans for r in pii.personal_data(kept).collect()}
    texts = {r.doc_id: None if r.text is None else redacted(r.text, spans[r.doc_id]) for r in rows}
    clean = [(r.doc_id, texts[r.doc_id], r.lang, r.source, len(texts[r.doc_id] or "")) for r in rows]
    return texts, clean


def test_pipeline_equals_its_plain_stages(spark):
    texts, clean = plain_pipeline(spark)
    connection = duckdb.connect()
    connection.register("documents", pd.DataFrame(clean, columns=corpus_pipeline.COLUMNS))
    taken = connection.execute(catalog.ORACLE_SQL["op2_mix"]).df()
    encode = packing.encoder(*packing.tokenizer_files()).full.encode
    want = Counter()
    for doc_id in taken.doc_id:
        ids = [*encode(texts[doc_id] or "", add_special_tokens=False).ids, 0]
        for piece, (start, length) in enumerate(packing.cut(len(ids), packing.CAPACITY)):
            want[doc_id, piece, start, length, zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())] += 1
    packed = corpus_pipeline.run(spark, SMALL).collect()
    got = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed)
    assert got == want
    ends = defaultdict(list)
    for r in packed:
        ends[r.sequence_id].append((r.offset, r.length))
    for own in ends.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY


def test_entry_lists_all_queries():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in names if n.startswith("op")}
