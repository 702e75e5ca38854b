"""The queries against their SQL, or brute force, on the smallest given tables."""

import os
import struct
import zlib
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from txvigil.llm.oracles import ORACLES
from txvigil.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = "documents", "pages", "conversations", "embeddings"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", ORACLES)
def test_sql(spark, sql, name):
    rows = QUERIES[name](spark, FOLDER)
    columns = sorted(rows.columns)
    expected = sql.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert Counter(tuple(r) for r in rows.select(columns).collect()) == Counter(expected)


def test_one_query_each():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_fingerprints_tell_texts_apart(spark):
    rows = QUERIES["op8_winnowing"](spark, FOLDER).collect()
    long = [r for r in rows if r.n_chars > 400]
    assert sum(r.near_edited for r in long) / len(long) > 0.5
    assert sum(r.near_next for r in long) / len(long) < 0.1
    assert all(r.near_edited == 1 for r in rows if r.n_chars < 4)


def test_packed_pieces_hold_all_ids(spark):
    """Ids are read back from their checksums, by the tokenizer itself."""
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, ends = {}, {}
    for r in QUERIES["op9_packing"](spark, FOLDER).collect():
        pieces.setdefault(r.doc_id, []).append(r)
        ends.setdefault(r.sequence_id, []).append((r.offset, r.offset + r.length))
    docs = corpus_pipeline.table(spark, FOLDER, "documents").select("doc_id", "text").collect()
    assert sorted(pieces) == sorted(r.doc_id for r in docs)
    for doc in docs:
        ids = [*tokenizer.encode(doc.text or "", add_special_tokens=False).ids, 1]
        at = 0
        for piece in sorted(pieces[doc.doc_id], key=lambda r: r.start):
            part = ids[at : at + piece.length]
            assert (piece.start, piece.doc_tokens) == (at, len(ids))
            assert piece.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            at += piece.length
        assert at == len(ids)
    for places in ends.values():
        places.sort()
        assert [a for a, _ in places] == [0, *(b for _, b in places[:-1])] and places[-1][1] <= 2048


def test_pipeline(spark):
    """Each stage keeps what it should of what the one before kept."""
    docs = corpus_pipeline.table(spark, FOLDER, "documents")
    columns = docs.columns
    kept = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.stored(stage(spark, docs, FOLDER))
        kept.append(docs.select("doc_id").distinct().count())
        if name == "quality rules":
            good = QUERIES["op7_host_quality"](spark, FOLDER).filter("kept").select("doc_id")
            assert Counter(docs.select("doc_id").collect()) == Counter(good.collect())
        if name == "line dedup":
            lines = [line for r in docs.collect() for line in r.text.split("\n") if line.strip()]
            assert len(lines) == len(set(lines))
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        if name == "near duplicates":
            assert docs.count() == kept[-1] <= kept[-2]
        if name == "source mix":
            assert max(Counter(r.doc_id for r in docs.collect()).values()) <= 3
        if name == "packing":
            tokens = before.count()
            assert docs.filter("start = 0").count() == tokens
        else:
            assert docs.columns == columns
    assert kept[0] > kept[1] > 0
    assert corpus_pipeline.run(spark, FOLDER).count() == docs.count()


def test_near_duplicates_goes_by_rows(spark):
    """Rows that share an id or have none are kept unless their own text is a near copy."""
    text = " ".join(f"word{n}" for n in range(60))
    other = " ".join(f"other{n}" for n in range(60))
    rows = [(None, "a one", 1), (None, "two of these", 2), (5, text, 3), (5, other, 4), (3, text + " end", 5),
            (None, other, 6), (7, None, 7), (8, "", 8), (9, text, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row int")
    kept = corpus_pipeline.near_duplicates(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    assert sorted(r._row for r in kept.collect()) == [1, 2, 4, 5, 7, 8]
    assert corpus_pipeline.near_duplicates(spark, docs.filter("false"), FOLDER).count() == 0


def test_line_dedup_and_source_mix_of_odd_rows(spark):
    text = "a first line of words\nand a second one"
    rows = [(1, text, "a", 30, 1, 2), (2, text + "\nmore", "b", 30, 3, 4), (3, None, None, None, 5, 6), (4, "", "a", 0, 7, 8),
            (None, "without an id", "a", 13, 9, 10), (5, text, "b", 30, 11, 12)]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, source string, n_chars long, copies int, _doc int"
    )
    kept = corpus_pipeline.line_dedup(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    assert {tuple(r) for r in kept.collect()} == {*rows[:1], *rows[2:5], (2, "more", "b", 4, 3, 4)}
    mixed = corpus_pipeline.source_mix(spark, kept, FOLDER)
    assert mixed.columns == docs.columns
    assert {tuple(r) for r in mixed.collect()} <= {tuple(r) for r in kept.collect()}
    for stage in (corpus_pipeline.line_dedup, corpus_pipeline.source_mix, corpus_pipeline.packing_stage):
        assert stage(spark, docs.filter("false"), FOLDER).count() == 0


def test_quality_rules_keep_columns_of_any_name(spark):
    text = " ".join(f"word{n}" for n in range(80))
    docs = spark.createDataFrame(
        [(n, text, "a", 5, "x", True) for n in range(20)] + [(99, "few words", "a", 6, "y", False), (98, None, None, 7, "z", True)],
        "doc_id long, text string, source string, n_words int, kept string, base_failed boolean",
    )
    kept = corpus_pipeline.quality_rules(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    assert sorted(kept.collect()) == sorted(docs.filter("doc_id < 20").collect())
    assert corpus_pipeline.quality_rules(spark, docs.filter("false"), FOLDER).count() == 0
