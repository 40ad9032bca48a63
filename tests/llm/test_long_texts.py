"""Very long texts and empty tables in the stages of the pipeline."""

import time

import pytest

import corpus_pipeline
from ratesmith.llm import common, exact_dedup, mixing, ngram_join, pii, quality, repeats
from ratesmith.llm.queries import packed_pieces, tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_mixing_reads_a_long_text_once(spark):
    texts = [" ".join(f"w{i}" for i in range(n)) for n in (120_000, 90_000, 40)]
    docs = spark.createDataFrame([(i, t, None, "s", len(t)) for i, t in enumerate(texts)], SCHEMA)
    more = spark.createDataFrame([(9, "other " * 50_000, None, "t", 1)], SCHEMA)
    documents = common.numbered_documents(docs.unionByName(more))
    started = time.time()
    taken = {r.doc_id: r.taken for r in mixing.taken_words(documents).collect()}
    rows = mixing.mixed_documents(documents).collect()
    assert time.time() - started < 60
    held = {}
    for row in rows:
        words = row.text.split()
        held[row.doc_id] = held.get(row.doc_id, 0) + len(words)
        if row.doc_id < 3:
            assert set(words) <= set(texts[row.doc_id].split())
    assert held == {name: n for name, n in taken.items() if n}


@pytest.mark.parametrize("blank", [" ", "\n", " \t"])
def test_packing_of_very_long_blanks(spark, blank):
    from tokenizers import Tokenizer

    text = "word" + blank * 1_000_000 + "word it's"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    pieces = packed_pieces(docs).collect()
    ids = Tokenizer.from_file(tokenizer_path()).encode(text, add_special_tokens=False).ids
    assert sum(p.length for p in pieces) == len(ids) + 1 == pieces[0].doc_tokens


def test_stored_documents_keep_their_numbers(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.range(0, 1000, 1, 7).selectExpr("id AS doc_id", "concat('t', id) AS text", "1 AS place_in_file").write.parquet(path)
    documents = common.numbered_documents(spark.read.parquet(path))
    assert documents.columns == ["doc_id", "text", "place_in_file", common.ROW]
    first = {r[common.ROW]: r.doc_id for r in documents.collect()}
    again = {r[common.ROW]: r.doc_id for r in documents.repartition(3).select(common.ROW, "doc_id").collect()}
    assert len(first) == 1000 and first == again
    # other frames are written once
    derived = common.numbered_documents(spark.read.parquet(path).where("doc_id > 5"))
    assert derived.count() == derived.select(common.ROW).distinct().count() == 994


def test_empty_tables_in_every_stage(spark):
    empty = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0, name
    for report in (exact_dedup.exact_copies, ngram_join.near_copies, quality.quality_report, pii.pii_report,
                   repeats.without_repeats, mixing.mix_report):
        assert report(empty).count() == 0


def test_stages_with_odd_rows(spark):
    rows = [(1, None, "en", "a", 0), (1, "", None, None, 0), (None, "x " * 40, "en", "a", 5), (2, "x " * 40, "en", "a", 5),
            (2, "x " * 40, "en", "a", 5), (3, "word " * 30 + "é" * 200_000, None, "b", None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "").count() >= 0, name
