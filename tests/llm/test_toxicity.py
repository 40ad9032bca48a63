"""Learning from confirmed toxic texts and unlabelled ones."""

import random
import zlib

import pytest

from ratesmith.llm import toxicity as tx

DOCS, LABELS = "doc_id long, text string, label int", "doc_id long, toxic int"
MARKS = ["gronk", "blargh", "snivel", "fudd", "twerp"]


def corpus(seed=4, n=3000):
    draw = random.Random(seed)
    words = ["".join(draw.choices("abcdefghilmnoprst", k=draw.randint(2, 9))) for _ in range(1500)]
    docs, labels = [], []
    for doc_id in range(n):
        text, toxic = draw.choices(words, k=draw.randint(20, 80)), draw.random() < 0.12
        if toxic:
            for mark in draw.sample(MARKS, 2):
                text.insert(draw.randrange(len(text)), mark)
        docs.append((doc_id, " ".join(text), 7))
        if draw.random() < 0.6:
            labels.append((doc_id, int(toxic)))
    return docs, labels


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_planted_words_are_learnt(spark):
    docs, labels = corpus()
    rows = tx.toxicity_report(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    toxic = {doc_id: any(mark in text.split() for mark in MARKS) for doc_id, text, _ in docs}
    assert len(rows) == len(docs) and {r.doc_id for r in rows if r.held_out} == set(filter(held_out, toxic))
    found = [r for r in rows if r.held_out and toxic[r.doc_id]]
    clean = [r for r in rows if r.held_out and not toxic[r.doc_id]]
    assert sum(r.predicted for r in found) >= 0.95 * len(found)
    assert sum(r.predicted for r in clean) <= 0.01 * len(clean)
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)


def test_held_out_labels_are_not_read(spark):
    docs, labels = corpus(n=600)
    turned = [(doc_id, 1 - toxic if held_out(doc_id) else toxic) for doc_id, toxic in labels]
    frame = spark.createDataFrame(docs, DOCS)
    first, second = (sorted(tx.toxicity_report(frame, spark.createDataFrame(own, LABELS)).collect())
                     for own in (labels, turned))
    assert first == second


def test_words_that_share_a_beginning_count():
    held = tx.held_features({"gron": 3, "gronk.": 1})
    assert held == {"gron", "gron*2", "gronk."}
    known = tx.Known({"gron*2"})
    assert known.of("Gronks and gronking") == {"gron*2"} and known.of("gronks gronks") == set()


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (None, "words", 1), (2, "again " * 100_000, 1)], DOCS)
    none = spark.createDataFrame([], LABELS)
    rows = tx.toxicity_report(docs, none).collect()
    assert len(rows) == 4 and {r.score for r in rows} == {0.0} or all(r.score < 1e-6 for r in rows)
    odd = spark.createDataFrame([(1, 1), (1, 0), (1, None), (None, 1), (77, 1), (2, 0)], LABELS)
    assert len(tx.toxicity_report(docs, odd).collect()) == 4
    assert tx.toxicity_report(docs.limit(0), odd).count() == 0


@pytest.mark.parametrize("toxic, other", [([], ["a"]), (["a"], [])])
def test_one_side_missing(toxic, other):
    assert tx.fit(toxic, other, 0.1).constant == -500
