"""Language identification by prediction by partial matching.

Every language has a variable-order tree of byte contexts (up to `ORDER` bytes). In a context, a
symbol seen `c` times of `n`, among `d` distinct ones, has probability c / (n + d); the escape
mass d / (n + d) goes to the other symbols in proportion to the next shorter context, so the
probabilities of a context add up to one and their logarithms are exact code lengths. Below the
empty context all bytes are alike. The statistics are frozen after training; the language with the
shortest code wins, ties go to the first in order. Lengths are summed in double precision from
numbers in single precision.

Training reads a bounded sample: about `SAMPLE_DOCUMENTS` whole texts per language, chosen by a
hash of doc_id, with contexts counted by Spark. All contexts that occur `LEAST_CONTEXT` times in the
sample are kept, however many languages and byte values there are; the model grows with the sample.

NULL texts and texts without a letter are `und` with score 0. Without training rows every text is
`und`. Texts are lower-cased before they are coded. The score is the posterior of the language
under equal priors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ratesmith.llm.common import LETTERS, fold

ORDER = 4
SAMPLE_DOCUMENTS = 300
LEAST_CONTEXT = 4
SLICE = 1 << 20
SEPARATOR = b"\x00" * ORDER
COUNTS = "lang string, width int, code long, n long"
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of byte strings of 1 to ORDER + 1 bytes per language."""
    texts: dict[str, list[bytes]] = {}
    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
            texts.setdefault(lang, []).append(text.lower().encode())
    for lang, parts in texts.items():
        data = np.frombuffer(SEPARATOR + SEPARATOR.join(parts), np.uint8).astype(np.int64)
        code = np.zeros(len(data), np.int64)
        clean = np.ones(len(data), bool)
        for width in range(1, ORDER + 2):
            older = data[: len(data) - width + 1]
            code = code[len(code) - len(older):] | older << 8 * (width - 1)
            clean = clean[len(clean) - len(older):] & (older > 0)
            values, counts = np.unique(code[clean], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(values), pa.string()), pa.array([width] * len(values), pa.int32()),
                 pa.array(values), pa.array(counts)], names=["lang", "width", "code", "n"])


def training_counts(labelled: DataFrame, documents: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """Byte strings of the sampled texts with their counts, one row per language and string."""
    rates = labelled.groupBy("lang").agg((F.lit(float(documents)) / F.count("*")).alias("rate"))
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    sample = labelled.join(F.broadcast(rates), "lang").where(share < F.col("rate"))
    return (
        sample.select("lang", "text").mapInArrow(_counted, COUNTS)
        .groupBy("lang", "width", "code").agg(F.sum("n").alias("n"))
    )


@dataclass
class Model:
    """Contexts are numbered, the empty one is 0; a pair is a context and a symbol seen in it.

    Only what was seen is stored, whatever the number of languages: a symbol that no language has in
    a context costs the context's escape and what it costs in the next shorter one.
    """

    languages: list[str]
    symbols: np.ndarray  # byte -> symbol
    children: np.ndarray  # context, symbol before it -> longer context, or -1
    parents: np.ndarray  # context -> the next shorter one
    pairs: np.ndarray  # context, symbol -> pair, or -1
    costs: np.ndarray  # pair, language -> bits
    escapes: np.ndarray  # context, language -> bits


def _contexts(counts, least: int) -> list[np.ndarray]:
    """Codes of the contexts of each length that occur `least` times in all, ascending."""
    kept = [np.zeros(1, np.int64)]
    for length in range(1, ORDER + 1):
        own = counts["width"] == length + 1
        codes, places = np.unique(counts["code"][own] >> 8, return_inverse=True)
        totals = np.bincount(places, counts["n"][own], len(codes)) if len(codes) else np.zeros(0)
        kept.append(codes[totals >= least])
    return kept


def build(counts, least: int = LEAST_CONTEXT) -> Model:
    """Model from arrays lang, width, code, n; in a code the last byte is the lowest.

    Contexts are built length by length: what a symbol costs in a shorter one is known by then.
    """
    counts = {name: np.asarray(values) for name, values in counts.items()}
    languages = sorted(set(counts["lang"].tolist()))
    number = np.searchsorted(np.array(languages, object), counts["lang"]) if languages else np.zeros(0, np.int64)
    seen = np.unique(counts["code"][counts["width"] == 1]) if languages else np.zeros(0, np.int64)
    symbols = np.full(256, len(seen), np.int32)
    symbols[seen.astype(np.int64)] = np.arange(len(seen))
    size, many = len(seen) + 1, len(languages)
    codes = _contexts(counts, least) if languages else [np.zeros(1, np.int64)]
    firsts = np.cumsum([0] + [len(own) for own in codes])
    total = int(firsts[-1])
    children, pairs = np.full((total, size), -1, np.int32), np.full((total, size), -1, np.int32)
    parents, factors = np.zeros(total, np.int32), np.ones((total, many))
    odds = np.zeros((0, many))

    def probability(nodes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        factor, nodes = np.ones((len(nodes), many)), nodes.copy()
        open_ = np.flatnonzero(pairs[nodes, wanted] < 0)
        while len(open_):
            factor[open_] *= factors[nodes[open_]]
            nodes[open_] = parents[nodes[open_]]
            open_ = open_[pairs[nodes[open_], wanted[open_]] < 0]
        return factor * odds[pairs[nodes, wanted]]

    for length, own_codes in enumerate(codes):
        if not len(own_codes) or not many:
            continue
        nodes = firsts[length] + np.arange(len(own_codes))
        rows = counts["width"] == length + 1
        code, lang, n = counts["code"][rows], number[rows], counts["n"][rows]
        at = np.searchsorted(own_codes, code >> 8)
        known = (at < len(own_codes)) & (own_codes[np.minimum(at, len(own_codes) - 1)] == code >> 8)
        at, symbol, lang, n = at[known], symbols[code[known] & 255], lang[known], n[known]
        if length:
            shorter = own_codes & ((1 << 8 * (length - 1)) - 1)
            parents[nodes] = firsts[length - 1] + np.searchsorted(codes[length - 1], shorter)
            children[parents[nodes], symbols[own_codes >> 8 * (length - 1)]] = nodes
            keys = np.unique(at * size + symbol)
        else:
            keys = np.arange(size)  # the empty context holds every symbol
        own, wanted = keys // size, keys % size
        seen_times = np.zeros((len(keys), many))
        seen_times[np.searchsorted(keys, at * size + symbol), lang] = n
        if length:
            given = probability(parents[nodes[own]], wanted)
        else:
            given = np.full((size, many), 1 / 256)
            given[-1] = (256 - len(seen)) / 256
        sums, kinds, taken = (np.zeros((len(nodes), many)) for _ in range(3))
        np.add.at(sums, own, seen_times)
        np.add.at(kinds, own, seen_times > 0)
        np.add.at(taken, own, given * (seen_times > 0))
        rest = 1 - taken
        some, left = sums > 0, rest > 1e-9
        mass = np.where(some & left, sums + kinds, np.maximum(sums, 1))
        factors[nodes] = np.where(some, np.where(left, kinds / np.maximum(sums + kinds, 1) / np.where(left, rest, 1), 0), 1)
        pairs[nodes[own], wanted] = len(odds) + np.arange(len(keys))
        odds = np.concatenate([odds, np.where(seen_times > 0, seen_times / mass[own], given * factors[nodes[own]])])
    if many:
        odds[pairs[0, -1]] /= max(1, 256 - len(seen))  # one byte of those never seen
    bits = [(-np.log2(np.maximum(values, 1e-12))).astype(np.float32) for values in (odds, factors)]
    return Model(languages, symbols, children, parents, pairs, *bits)


def _bits(model: Model, contexts: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Bits of each symbol in its context, per language."""
    found = model.pairs[contexts, symbols]
    bits = model.costs[found]
    open_ = np.flatnonzero(found < 0)
    spent, nodes = np.zeros((len(open_), bits.shape[1]), np.float32), contexts[open_]
    while len(open_):
        spent += model.escapes[nodes]
        nodes = model.parents[nodes]
        found = model.pairs[nodes, symbols[open_]]
        there = found >= 0
        bits[open_[there]] = spent[there] + model.costs[found[there]]
        open_, nodes, spent = open_[~there], nodes[~there], spent[~there]
    return bits


def code_lengths(model: Model, texts: list[bytes]) -> np.ndarray:
    """Bits of every text under every language."""
    sums = np.zeros((len(texts), len(model.languages)))
    sizes = np.array([len(text) for text in texts], np.int64)
    starts = ORDER + np.concatenate([[0], np.cumsum(sizes + ORDER)[:-1]])
    data = model.symbols[np.frombuffer(SEPARATOR + SEPARATOR.join(texts) + SEPARATOR, np.uint8)]
    for first in range(ORDER, len(data), SLICE):
        last = min(len(data), first + SLICE)
        context = np.zeros(last - first, np.int32)
        node = context
        for back in range(1, ORDER + 1):
            # a context that is not there has no longer one either
            node = np.where(node >= 0, model.children[node, data[first - back:last - back]], -1)
            context = np.where(node >= 0, node, context)
        lengths = _bits(model, context, data[first:last])
        totals = np.concatenate([np.zeros((1, sums.shape[1])), np.cumsum(lengths, 0, np.float64)])
        begin, end = np.clip(starts, first, last) - first, np.clip(starts + sizes, first, last) - first
        sums += totals[end] - totals[begin]
    return sums


def predict(model: Model, texts: list[str | None]) -> tuple[list[str], list[float]]:
    readable = [bool(text and LETTERS.search(text)) and bool(model.languages) for text in texts]
    languages, scores = ["und"] * len(texts), [0.0] * len(texts)
    chosen = [i for i, yes in enumerate(readable) if yes]
    if chosen:
        bits = code_lengths(model, [texts[i].lower().encode() for i in chosen])
        best = bits.argmin(1)
        posterior = 1 / np.exp2(np.maximum(bits.min(1)[:, None] - bits, -1000)).sum(1)
        for i, lang, score in zip(chosen, best, posterior):
            languages[i], scores[i] = model.languages[lang], float(score)
    return languages, scores


def train(labelled: DataFrame, documents: int = SAMPLE_DOCUMENTS) -> Model:
    """Model from rows with doc_id, lang and text; the counts it collects come from the sample."""
    usable = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = training_counts(usable, documents).toArrow().sort_by(
        [("lang", "ascending"), ("width", "ascending"), ("code", "ascending")])
    return build({name: np.array(counts[name].to_pylist(), object if name == "lang" else np.int64)
                  for name in counts.column_names})


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out (as in `docs`), lang_pred and score of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                languages, scores = predict(model, part["text"].to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["held_out"], pa.array(languages, pa.string()),
                     pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, SCHEMA)


def language_report(docs: DataFrame) -> DataFrame:
    """Predictions for all rows; documents whose crc32(doc_id) mod 4 is 2 are not learnt from."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").withColumn(
        "held_out", fold(F.col("doc_id"), 2, 4))
    return identify(rows, train(rows.where(~F.col("held_out"))))
