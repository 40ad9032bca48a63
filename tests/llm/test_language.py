"""Prediction by partial matching against a plain recursion, and on held-out texts."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from ratesmith.llm import language_id as li

SCHEMA = "doc_id long, text string, lang string"


def plain_bits(training, least, text):
    """Code lengths per language, one symbol at a time."""
    seen = sorted({byte for texts in training.values() for t in texts for byte in t.encode()})
    counts = {lang: defaultdict(Counter) for lang in training}
    totals = Counter()
    for lang, texts in training.items():
        for t in texts:
            data = t.encode()
            for at, byte in enumerate(data):
                for length in range(min(at, li.ORDER) + 1):
                    counts[lang][data[at - length:at]][byte] += 1
                    totals[data[at - length:at]] += 1

    def probability(lang, context, byte):
        if context is None:
            return 1 / 256 if byte in seen else (256 - len(seen)) / 256
        shorter = context[1:] if context else None
        own = counts[lang].get(context, {})
        if not own:
            return probability(lang, shorter, byte)
        n, d = sum(own.values()), len(own)
        rest = 1 - sum(probability(lang, shorter, b) for b in own)
        if byte in own:
            return own[byte] / (n + d if rest > 1e-9 else n)
        return d / (n + d) / rest * probability(lang, shorter, byte) if rest > 1e-9 else 0.0

    data, bits = text.encode(), {}
    for lang in training:
        bits[lang] = 0.0
        for at, byte in enumerate(data):
            context = data[max(0, at - li.ORDER):at]
            # the longest suffix that was kept
            while context and totals[context] < least:
                context = context[1:]
            p = probability(lang, context, byte)
            if byte not in seen:
                p /= max(1, 256 - len(seen))
            bits[lang] -= np.log2(max(p, 1e-12))
    return bits


def counts_of(training):
    rows = Counter()
    for lang, texts in training.items():
        for t in texts:
            data = t.encode()
            for width in range(1, li.ORDER + 2):
                for at in range(len(data) - width + 1):
                    rows[lang, width, int.from_bytes(data[at:at + width], "big")] += 1
    lang, width, code = zip(*rows)
    return {"lang": np.array(lang, object), "width": np.array(width), "code": np.array(code), "n": np.array(list(rows.values()))}


@pytest.mark.parametrize("least", [1, 3])
def test_code_lengths(least):
    draw = random.Random(1)
    training = {lang: ["".join(draw.choices(letters, k=draw.randint(1, 60))) for _ in range(8)]
                for lang, letters in (("aa", "abc "), ("bb", "bcdé "), ("cc", "aaab"))}
    model = li.build(counts_of(training), least)
    texts = ["", "a", "abcabc", "dédé bcd", "zzz?a", "aaab" * 9, "".join(draw.choices("abcdé ", k=200))]
    found = li.code_lengths(model, [t.encode() for t in texts])
    for text, row in zip(texts, found):
        wanted = plain_bits(training, least, text)
        assert row == pytest.approx([wanted[lang] for lang in model.languages], rel=1e-4, abs=1e-4)


def test_probabilities_add_up_to_one():
    model = li.build(counts_of({"x": ["abracadabra", "cab"], "y": ["dab"]}), 1)
    size = model.pairs.shape[1]
    for context in range(len(model.parents)):
        bits = li._bits(model, np.full(size, context), np.arange(size))
        odds = 2.0 ** -bits
        odds[-1] *= 256 - (size - 1)
        assert odds.sum(0) == pytest.approx([1, 1], abs=1e-4)


def test_contexts_do_not_shrink_with_languages():
    text = "the quick brown fox jumps over the lazy dog again and again. " * 3
    one = li.build(counts_of({"a": [text]}))
    many = li.build(counts_of({f"l{i}": [text + chr(0x400 + i) * 5] for i in range(60)}))
    assert len(many.parents) >= len(one.parents)
    bits = li.code_lengths(many, [text.encode(), (text + chr(0x400 + 7) * 9).encode()])
    assert many.languages[bits[1].argmin()] == "l7"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = [r for r in li.language_report(docs).collect() if r.held_out and lang[r.doc_id] and r.lang_pred != "und"]
    right = sum(r.lang_pred == lang[r.doc_id] for r in rows)
    assert len(rows) > 100 and right >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_texts(spark):
    rows = [(1, "plain english words here and there", "en"), (2, "plain english words here again", "en"),
            (3, None, "en"), (4, "", "de"), (5, "12 34 !!", None), (6, "é" * 300_000, None), (7, "x", None),
            (None, "words", "en")]
    found = {r.doc_id: r for r in li.language_report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(found) == len(rows)
    assert [found[i].lang_pred for i in (3, 4, 5)] == ["und"] * 3 and found[3].score == 0
    assert li.language_report(spark.createDataFrame([], SCHEMA)).count() == 0
    unlabelled = spark.createDataFrame([(1, "words", None)], SCHEMA)
    assert li.language_report(unlabelled).collect()[0].lang_pred == "und"
