"""Groups of copies that hold each other's lines reach the duplicate stages of the pipeline."""

import random

import corpus_pipeline
from ratesmith.sources.workspace import staged

DRAW = random.Random(3)
LINES = [" ".join("".join(DRAW.choices("abcdefghij", k=6)) for _ in range(8)) for _ in range(30)]


def stages(spark, texts):
    """The doc_ids after each of the first three stages."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, text, "en", "a", len(text)) for i, text in enumerate(texts)], schema)
    found = []
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = staged(stage(spark, docs, ""), name)
        found.append(sorted(row.doc_id for row in docs.collect()))
    return found


def test_one_document_of_a_copy_group_stays(spark):
    spaced = ["\n".join(LINES).replace(" ", " " * (i + 1), i + 1) for i in range(30)]
    edited = ["\n".join(LINES[:i] + [LINES[i].replace(" ", " x", 2)] + LINES[i + 1:]) for i in range(30)]
    cased = ["\n".join(LINES).upper()[:40 * (i + 1)] + "\n".join(LINES)[40 * (i + 1):] for i in range(30)]
    passed, _, left = stages(spark, spaced + edited + cased)
    assert passed == list(range(90)) and len(left) == 1


def test_boilerplate_of_different_documents_still_fails(spark):
    menu = LINES[:3]
    own = [" ".join("".join(DRAW.choices("klmnopqrst", k=6)) for _ in range(40)) for _ in range(30)]
    texts = ["\n".join(menu + [text]) for text in own] + ["\n".join(menu)]
    passed, *_ = stages(spark, texts)
    assert passed == list(range(30))
