"""The pipeline's stages, each held against a plain version on its own input."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from ratesmith.llm import packing, quality
from ratesmith.llm.queries import tokenizer_path
from ratesmith.sources.workspace import staged

DATA = "/root/testdata/sf0.001"


def words_of(text):
    return (text or "").encode().split()


@pytest.fixture(scope="module")
def results(spark):
    """The documents and the rows of every stage."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(staged(stage(spark, steps[-1], DATA), name))
    assert all(step.columns == docs.columns for step in steps[:-1])
    return [step.collect() for step in steps]


def ids(rows):
    return Counter(row.doc_id for row in rows)


def test_quality_rules(results):
    docs, kept, *_ = results
    lines = [[(quality.normalised(line), len(line.split())) for line in (d.text or "").encode().split(b"\n")
              if line.split()] for d in docs]
    holders = defaultdict(set)
    for doc, own in zip(docs, lines):
        for line, _ in own:
            holders[doc.source, line].add(doc.text)
    expected = Counter()
    for doc, own in zip(docs, lines):
        words = words_of(doc.text)
        windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
        counts = Counter(windows)
        repeated = {i + k for i, window in enumerate(windows) if counts[window] > 1 for k in range(5)}
        left = len(words) - sum(n for line, n in own if len(holders[doc.source, line]) > quality.LINE_LIMIT)
        if (len(words) >= 10 and 100 * len(repeated) <= 20 * len(words)
                and left >= quality.LEAST_WORDS and left >= quality.LEAST_SHARE * len(words)):
            expected[doc.doc_id] += 1
    assert ids(kept) == expected and 0 < len(kept) < len(docs)
    texts = {doc.doc_id: doc.text for doc in docs}
    assert all(doc.text == texts[doc.doc_id] for doc in kept)


def test_exact_copies(results):
    _, docs, kept, *_ = results
    best = {}
    for doc in docs:
        key = b"".join(words_of(doc.text))
        best[key] = min(best.get(key, (1, 0)), (-len(doc.text or ""), doc.doc_id))
    assert ids(kept) == Counter(doc_id for _, doc_id in best.values())


def test_near_copies(results):
    _, _, docs, kept, *_ = results
    sets = {}
    for doc in docs:
        words = words_of((doc.text or "").lower() if (doc.text or "").isascii() else
                         (doc.text or "").encode().lower().decode())
        sets[doc.doc_id] = {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    group = {doc_id: doc_id for doc_id in sets}
    names = sorted(sets)
    for at, first in enumerate(names):
        for second in names[at + 1:]:
            both = len(sets[first] & sets[second])
            if both and 10 * both >= 8 * len(sets[first] | sets[second]) and group[first] != group[second]:
                low, high = sorted((group[first], group[second]))
                group = {name: low if own == high else own for name, own in group.items()}
    assert ids(kept) == Counter(set(group.values()))


def test_mixing(results):
    _, _, _, docs, mixed, _ = results
    sizes = {doc.doc_id: Counter(words_of(doc.text)) for doc in docs}
    taken = defaultdict(Counter)
    for doc in mixed:
        taken[doc.doc_id] += Counter(words_of(doc.text))
    for doc_id, words in taken.items():
        assert all(n <= 2 * sizes[doc_id][word] for word, n in words.items())
    total, held = (sum(sum(words.values()) for words in side.values()) for side in (sizes, taken))
    assert held == pytest.approx(1.5 * total, rel=0.05)


def test_packing(results):
    *_, docs, pieces = results
    encoder = packing.Encoder(tokenizer_path(), None, None)
    expected = Counter()
    for doc in docs:
        own = np.append(np.frombuffer(encoder.ids(doc.text or ""), "<u4"), np.uint32(packing.END_ID)).astype("<u4")
        for start, length in packing.pieces_of(len(own)):
            expected[doc.doc_id, start, length, zlib.crc32(own[start:start + length].tobytes()), len(own)] += 1
    assert Counter((p.doc_id, p.start, p.length, p.ids_crc32, p.doc_tokens) for p in pieces) == expected
    assert len({p.sequence_id for p in pieces}) == len(pieces)
