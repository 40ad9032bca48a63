"""Quality rules by cross-document line frequency.

Lines are normalised (white space collapsed, A-Z lower-cased, digits to 0) and hashed. A line that
more than `LINE_LIMIT` different documents of a host hold is boilerplate; exact copies of one text
count as one document there, they are left to the duplicate stages. A document fails if its own
words repeat too much (the base rules) or if the lines that stay hold fewer than `LEAST_WORDS`
words or less than `LEAST_SHARE` of its words. NULL and empty texts have no words and fail.
NULL is a host of its own.

Copies that are not byte for byte equal hold each other's lines, so that a large group of them would
fail as a whole. `survivors`, the rule of the pipeline, therefore looks at what the lines reject once
more, with a line's holders counted over copy groups: texts equal without white space, case and
digits, and near copies as the near-copy stage links them, are one holder.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ratesmith.llm import ngram_join
from ratesmith.llm.common import ROW, numbered, text_of
from ratesmith.sources.workspace import staged

LINE_LIMIT = 20
LEAST_WORDS = 10
LEAST_SHARE = 0.2
WINDOW = 5
# near copies as the near-copy stage of the pipeline links them
COPY_WORDS, COPY_PERCENT = 5, 80
SYMBOLS = "#*$%&|<>"
_FOLDED = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", b"abcdefghijklmnopqrstuvwxyz000000000")

SCHEMA = (
    f"{ROW} long, doc_id long, host string, text_hash long, copy_hash long, n_words long, word_chars long, "
    "n_symbols long, n_dup_lines long, n_repeat_words long, "
    "lines array<struct<line: long, words: int>>"
)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of five that the text holds twice or more."""
    windows = list(zip(*(words[i:] for i in range(WINDOW))))
    distinct = set(windows)
    if len(distinct) == len(windows):
        return 0
    seen, twice = set(), set()
    for window in windows:
        (twice if window in seen else seen).add(window)
    count, covered = 0, 0
    for start, window in enumerate(windows):
        if window in twice:
            count += start + WINDOW - max(start, covered)
            covered = start + WINDOW
    return count


def normalised(line: bytes) -> bytes:
    return b" ".join(line.split()).translate(_FOLDED)


def measure(text: str | None) -> tuple:
    """Hashes of the text and of its folded words, the base figures and the hashed lines of one text."""
    text = text or ""
    data = text.encode()
    words = data.split()
    lines, seen, repeated = [], set(), 0
    for line in data.split(b"\n"):
        plain = normalised(line)
        if plain:
            repeated += line in seen
            seen.add(line)
            lines.append({"line": _signed(xxhash.xxh3_64_intdigest(plain)),
                          "words": plain.count(b" ") + 1})
    return (
        _signed(xxhash.xxh3_64_intdigest(data)),
        _signed(xxhash.xxh3_64_intdigest(b"".join(words).translate(_FOLDED))),
        len(words),
        len(text) - sum(text.count(space) for space in " \t\n\x0b\x0c\r"),
        sum(text.count(symbol) for symbol in SYMBOLS),
        repeated,
        repeated_words(words),
        lines,
    )


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["text_hash", "copy_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    lines = pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int32())]))
    for batch in batches:
        figures = list(zip(*(measure(text) for text in batch["text"].to_pylist()))) or [()] * 8
        yield pa.RecordBatch.from_arrays(
            [batch[ROW], batch["doc_id"], batch["host"],
             *(pa.array(values, pa.int64()) for values in figures[:7]), pa.array(figures[7], lines)],
            names=[ROW, "doc_id", "host", *names, "lines"])


KEY = ["name", "unnamed", "line"]


def measurements(documents: DataFrame, host: str) -> DataFrame:
    """One row per document: its hashes, figures and hashed lines."""
    inputs = documents.select(
        ROW, F.col("doc_id").cast("long").alias("doc_id"), F.col(host).alias("host"), "text")
    return staged(inputs.mapInArrow(_measured, SCHEMA), "measured")


def boilerplate(measured: DataFrame) -> DataFrame:
    """The lines of all documents that more than `LINE_LIMIT` texts of their host hold."""
    lines = measured.select(ROW, "host", "text_hash", "copy_hash", F.explode("lines").alias("at")).select(
        ROW, F.coalesce("host", F.lit("")).alias("name"), F.col("host").isNull().alias("unnamed"),
        "text_hash", "copy_hash", "at.line", "at.words")
    frequent = (
        lines.select(*KEY, "text_hash").distinct().groupBy(*KEY).agg(F.count("*").alias("documents"))
        .where(F.col("documents") > LINE_LIMIT).select(*KEY)
    )
    return lines.join(frequent, KEY).select(ROW, *KEY, "copy_hash", "words")


def _enough() -> Column:
    """Whether the lines that stay hold enough words."""
    return (F.col("words_left") >= LEAST_WORDS) & (F.col("words_left") >= LEAST_SHARE * F.col("n_words"))


def _with_words_left(figures: DataFrame, lines: DataFrame) -> DataFrame:
    removed = lines.groupBy(ROW).agg(F.sum("words").alias("removed_words"))
    left = F.col("n_words") - F.coalesce("removed_words", F.lit(0))
    return figures.join(removed, ROW, "left").withColumn("words_left", left).drop("removed_words")


def judged(measured: DataFrame, lines: DataFrame) -> DataFrame:
    """One row per document: its figures, base_failed, kept and the words left without `lines`."""
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (
        _with_words_left(measured.drop("lines", "text_hash", "copy_hash", "host"), lines)
        .withColumn("base_failed", base_failed).withColumn("kept", ~F.col("base_failed") & _enough())
    )


def decide(documents: DataFrame, host: str = "source") -> DataFrame:
    """One row per document: its figures, base_failed, kept and the words left."""
    measured = measurements(documents, host)
    return judged(measured, boilerplate(measured))


def _copy_groups(documents: DataFrame, failed: DataFrame) -> DataFrame:
    """(copy_hash, holder): the copy groups of the failed documents."""
    chosen = staged(failed.groupBy("copy_hash").agg(F.min(ROW).alias(ROW)), "copy_hashes")
    texts = documents.join(chosen.select(ROW), ROW, "left_semi").select(
        ROW, F.col(ROW).alias("doc_id"), F.translate(text_of(), "123456789", "0" * 9).alias("text"))
    near = ngram_join.near_components(texts, COPY_WORDS, COPY_PERCENT).select(
        ROW, F.col("component_id").alias("first"))
    first = chosen.select(F.col(ROW).alias("first"), F.col("copy_hash").alias("holder"))
    return chosen.join(near, ROW).join(first, "first").select("copy_hash", "holder")


def survivors(documents: DataFrame, host: str = "source") -> DataFrame:
    """The row numbers that pass with a line's holders counted over copy groups."""
    measured = measurements(documents, host)
    lines = staged(boilerplate(measured), "boilerplate")
    decided = staged(judged(measured, lines), "judged")
    kept = decided.where("kept").select(ROW)
    short = decided.where(~_enough() & (F.col("words_left") < F.col("n_words")))
    failed = staged(short.select(ROW, "n_words", "base_failed").join(
        measured.select(ROW, "copy_hash"), ROW), "failed_by_lines")
    if failed.isEmpty():
        return kept
    groups = staged(_copy_groups(documents, failed), "copy_groups")
    frequent = (
        lines.select(*KEY, "copy_hash").distinct().join(groups, "copy_hash", "left")
        .select(*KEY, F.coalesce("holder", "copy_hash").alias("holder")).distinct()
        .groupBy(*KEY).agg(F.count("*").alias("documents"))
        .where(F.col("documents") > LINE_LIMIT).select(*KEY)
    )
    own = lines.join(failed.select(ROW), ROW, "left_semi").join(frequent, KEY)
    spared = _with_words_left(failed.where("NOT base_failed"), own).where(_enough())
    return kept.unionByName(spared.select(ROW))


def quality_report(docs: DataFrame, host: str = "source") -> DataFrame:
    return decide(numbered(docs, "doc_id", "text", host), host).drop(ROW)
