"""Repeated passages against counting every window."""

import hashlib
import random
from collections import Counter

import pytest

from ratesmith.llm import repeats

LENGTH = repeats.LENGTH


def plain(texts):
    data = [(text or "").encode() for text in texts]
    counts = Counter(d[i:i + LENGTH] for d in data for i in range(len(d) - LENGTH + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - LENGTH + 1):
            if counts[d[i:i + LENGTH]] > 1:
                gone[i:i + LENGTH] = b"\x01" * LENGTH
        kept = bytes(b for b, g in zip(d, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(d), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def corpus():
    draw = random.Random(8)
    words = ["".join(draw.choices("abcdeé ", k=draw.randint(2, 9))) for _ in range(400)]
    prose = lambda n: " ".join(draw.choices(words, k=n))
    shared = [prose(120) for _ in range(3)]
    texts = [None, "", "short", "x" * 399, "y" * 400, "y" * 401, "z" * 1500, "ab" * 700, "abc" * 500]
    texts += [prose(n) for n in (30, 90, 300, 800)]
    texts += [texts[-1], texts[-1] + " more", prose(40) + texts[-2]]
    for passage in shared:
        texts += [prose(60) + passage + prose(50) for _ in range(12)]
        texts += [passage[:450], passage[3:], passage + passage]
    base = prose(500)
    for _ in range(8):
        at = draw.randrange(len(base))
        texts.append(base[:at] + "#" + base[at + 1:])
    return texts


@pytest.mark.parametrize("unit_bytes", [repeats.UNIT_BYTES, 4000])
def test_removed_bytes(spark, unit_bytes):
    texts = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(repeats.without_repeats(docs.repartition(5), unit_bytes).collect())
    found = [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows]
    assert found == plain(texts)


def test_longer_texts(spark):
    texts = corpus()
    docs = spark.createDataFrame([(0, texts[12] * 3), (1, texts[11])], "doc_id long, text string")
    rows = sorted(repeats.without_repeats(docs).collect())
    assert [(r.n_bytes, r.n_removed) for r in rows] == [p[:2] for p in plain([texts[12] * 3, texts[11]])]


def test_matching_statistics():
    texts = [b"banana", b"ananas", b"xyz", b"banana"]
    found = repeats.matching_statistics(texts)
    for number, text in enumerate(texts):
        for at in range(len(text)):
            best = 0
            for other, second in enumerate(texts):
                for start in range(len(second)):
                    if (other, start) != (number, at):
                        n = 0
                        while at + n < len(text) and start + n < len(second) and text[at + n] == second[start + n]:
                            n += 1
                        best = max(best, n)
            assert found[number][at] == best


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, kept string")
    assert repeats.without_repeats(empty).count() == 0
