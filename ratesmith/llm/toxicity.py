"""Toxicity by non-negative positive-unlabelled learning.

A linear model over the words of a text and their beginnings (four to seven letters, which hold
stems together), and over beginnings that several of its words share, is trained from confirmed toxic
texts (P) and texts without regard to their labels (U) with the risk
    prior * E_P[loss(+)] + max(0, E_U[loss(-)] - prior * E_P[loss(-)]),
where the prior is the toxic share of the labelled training rows; where the second part falls
below zero, the step goes the other way. A step reads the whole sample: in small parts the number of
toxic texts among U varies so much that the sign of the second part is chance. Training reads bounded
samples of whole texts (`POSITIVES` and `UNLABELLED`, by a hash of doc_id). Features are held by at
least `LEAST_DOCUMENTS` toxic texts, and by more of them than of the unlabelled ones by `LEAST_LIFT`
standard deviations; the `VOCABULARY` strongest are used, with weights of zero or more.

NULL and empty texts get the model's constant. Without toxic training rows every score is 0.
A document with several labels is toxic if one says so; labels without doc_id match nothing.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ratesmith.llm.common import fold

POSITIVES = 3000
UNLABELLED = 12000
VOCABULARY = 1000
LEAST_DOCUMENTS = 3
LEAST_LIFT = 8.0
BEGINNINGS = range(4, 8)
SHARED = (2, 4)
CACHED_WORDS = 200_000
STEPS = 400
RATE = 0.05
DECAY = 1e-4
SEED = 5
WORDS = re.compile(r"[^\W\d_]+")
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def features(word: str) -> set[str]:
    """A word, marked as whole, and its beginnings."""
    return {word[:n] for n in BEGINNINGS if n <= len(word)} | {f"{word}."}


def held_features(words: dict[str, int]) -> set[str]:
    """Features of a text from the number of its words that have each feature of a word."""
    return {name if least == 1 else f"{name}*{least}"
            for name, n in words.items() for least in (1, *SHARED) if n >= least}


class Known(dict):
    """The features of a word that a model knows; most words have none."""

    def __init__(self, names):
        super().__init__()
        self.held = set(names)
        self.names = {name.partition("*")[0] for name in names}

    def __missing__(self, word: str) -> tuple[str, ...]:
        found = tuple(sorted(features(word) & self.names))
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = found
        return found

    def of(self, text: str | None) -> set[str]:
        counts = Counter(name for word in set(WORDS.findall((text or "").lower())) for name in self[word])
        return held_features(counts) & self.held


@dataclass
class Model:
    constant: float
    weights: dict[str, float] = field(default_factory=dict)

    def scorer(self):
        known = Known(self.weights.keys())

        def score(text: str | None) -> float:
            total = self.constant + sum(self.weights[name] for name in sorted(known.of(text)))
            return float(1 / (1 + np.exp(-np.clip(total, -500, 500))))

        return score


def _indexed(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
    rows = np.repeat(np.arange(len(texts)), [len(text) for text in texts])
    return rows, np.concatenate([*texts, np.zeros(0, np.int64)]).astype(np.int64), len(texts)


def chosen_features(toxic: list[str], other: list[str]) -> list[str]:
    """Features that mark toxic texts, the strongest first."""
    held = Counter(name for text in toxic for name in held_features(Counter(
        own for word in set(WORDS.findall((text or "").lower())) for own in features(word))))
    held = {name: n for name, n in held.items() if n >= LEAST_DOCUMENTS}
    known = Known(held.keys())
    usual = Counter(name for text in other for name in known.of(text))
    lifts = []
    for name, n in held.items():
        share = (usual[name] + 0.5) / (len(other) + 1)
        lift = (n / len(toxic) - share) / np.sqrt(share * (1 - share) / len(toxic))
        if lift >= LEAST_LIFT:
            lifts.append((-lift, name))
    return [name for _, name in sorted(lifts)[:VOCABULARY]]


def _risk_step(weights, constant, prior, toxic, other):
    """Gradient of the non-negative risk on one batch; each side is (rows, columns, texts)."""

    def scores(side):
        rows, columns, count = side
        return constant + np.bincount(rows, weights[columns], count)

    def back(side, slope):
        rows, columns, count = side
        gradient = np.bincount(columns, slope[rows], len(weights)) / max(1, count)
        return gradient, slope.mean() if count else 0.0

    def plus(values):  # loss(+) is log(1 + exp(-s))
        return -1 / (1 + np.exp(values))

    def minus(values):  # loss(-) is log(1 + exp(s))
        return 1 / (1 + np.exp(-values))

    of_toxic, of_other = scores(toxic), scores(other)
    negative = np.logaddexp(0, of_other).mean() - prior * np.logaddexp(0, of_toxic).mean()
    down_other, down_toxic = back(other, minus(of_other)), back(toxic, minus(of_toxic))
    part = [a - prior * b for a, b in zip(down_other, down_toxic)]
    if negative < 0:
        return [-value for value in part]
    up = back(toxic, plus(of_toxic))
    return [prior * a + b for a, b in zip(up, part)]


def fit(toxic: list[str], other: list[str], prior: float) -> Model:
    """Model from toxic and unlabelled texts."""
    if not toxic or not other or prior <= 0:
        return Model(-500.0)
    place = {name: i for i, name in enumerate(chosen_features(toxic, other))}
    known = Known(place.keys())
    sides = [[np.array(sorted(place[name] for name in known.of(text)), np.int64) for text in texts]
             for texts in (toxic, other)]
    weights, constant = np.zeros(len(place)), float(np.log(prior / (1 - min(prior, 0.99))))
    moments = [np.zeros(len(place) + 1), np.zeros(len(place) + 1)]
    toxic_part, other_part = map(_indexed, sides)
    for step in range(1, STEPS + 1):
        gradient, slope = _risk_step(weights, constant, prior, toxic_part, other_part)
        full = np.append(gradient + DECAY * weights, slope)
        moments[0] = 0.9 * moments[0] + 0.1 * full
        moments[1] = 0.999 * moments[1] + 0.001 * full**2
        change = RATE * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.999**step)) + 1e-8)
        weights, constant = np.maximum(0, weights - change[:-1]), constant - change[-1]
    return Model(float(constant), {word: float(weights[i]) for word, i in place.items()})


def _sample(rows: DataFrame, most: int) -> list[str]:
    """About `most` whole texts, chosen by a hash of doc_id."""
    count = rows.count()
    share = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 20)) / float(1 << 20)
    return [r.text for r in rows.where(share < most / max(1, count)).select("doc_id", "text")
            .orderBy("doc_id", "text").collect()]


def train(documents: DataFrame, labels: DataFrame) -> Model:
    """Model from training rows (doc_id, text) and their labels (doc_id, toxic)."""
    marked = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"))
    labelled = documents.join(marked, "doc_id").select("doc_id", "text", "toxic")
    prior = labelled.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    if not prior:
        return Model(-500.0)
    return fit(_sample(labelled.where("toxic = 1"), POSITIVES), _sample(documents, UNLABELLED), prior)


def score(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out (as given), score and predicted of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score_text = model.scorer()
        for batch in batches:
            scores = [score_text(text) for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array(scores, pa.float64()),
                 pa.array([int(value >= 0.5) for value in scores], pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"])

    return documents.select("doc_id", "held_out", "text").mapInArrow(run, SCHEMA)


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all rows; labels of documents whose crc32(doc_id) mod 5 is 0 are not read."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn(
        "held_out", fold(F.col("doc_id"), 0, 5))
    learnt = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").where(
        ~fold(F.col("doc_id"), 0, 5))
    return score(rows, train(rows.where(~F.col("held_out")), learnt))
