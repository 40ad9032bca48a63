"""Missing, empty, repeated rows and clashing column names."""

import pytest

from ratesmith.llm import exact_dedup, language_id, ngram_join, pii, quality

ROWS = [(1, "A b c d", None, "x"), (2, "A  b c d", "s", "x"), (2, None, "s", "x"), (3, "", None, "x"),
        (None, "a B c d", "s", "x"), (None, "a B c d", "s", "x"), (4, "mail a.b@c.de now", "s", "x")]
SCHEMA = "doc_id long, text string, source string, kept string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_exact_copies(odd):
    rows = exact_dedup.exact_copies(odd).collect()
    assert len(rows) == 7 and sum(r.kept for r in rows) == 4
    assert {r.keep_id for r in rows if r.doc_id in (1, 2) and r.group_size == 2} == {2}


def test_near_copies(odd):
    rows = ngram_join.near_copies(odd).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in rows) == [
        ("1", 2, "1"), ("2", 0, "2"), ("2", 2, "1"), ("3", 0, "3"), ("4", 1, "4"),
        ("None", 2, "1"), ("None", 2, "1")]


def test_quality(odd):
    rows = quality.quality_report(odd).collect()
    assert len(rows) == 7 and all(r.base_failed and not r.kept for r in rows)


def test_personal_data(odd):
    rows = {r.spans for r in pii.pii_report(odd).collect()}
    assert rows == {"", "email:5:13"}


def test_languages(spark):
    docs = spark.createDataFrame([(i, "the cat and the dog" if i % 2 else "der hund und die katze",
                                   "en" if i % 2 else "de") for i in range(60)] + [(99, "123", "en"), (98, None, None)],
                                 "doc_id long, text string, lang string")
    rows = {r.doc_id: r.lang_pred for r in language_id.language_report(docs).collect()}
    assert rows[99] == rows[98] == "und" and rows[1] == "en" and rows[2] == "de"
