"""Packing by power-of-two decomposition.

A document's ids, with the end id 1, are cut into whole sequences and then into pieces whose
lengths are the powers of two of the rest, largest first. Every piece is a sequence of its own,
so no sequence crosses documents and none is padded; sequences of one length form a bucket. One
pass, no shuffle. NULL and empty texts are the end id alone. Sequence ids are unique: task and
place in the task, and the bucket (power of two) in the lowest four bits.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

SEQUENCE = 2048
END_ID = 1
LATIN = re.compile("[\x00-\u024f]*").fullmatch
#: Runs of white space from this length go through the tokenizer file, as the splitting pattern of the
#: ranked vocabulary keeps a place to return to for each blank and fails beyond about 700,000.
LONG_BLANK = re.compile(r"\s{10000}").search
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def pieces_of(tokens: int, sequence: int = SEQUENCE) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document."""
    pieces = [(start, sequence) for start in range(0, tokens - sequence + 1, sequence)]
    start = len(pieces) * sequence
    for bit in reversed(range((tokens - start).bit_length())):
        if (tokens - start) >> bit & 1:
            pieces.append((start, 1 << bit))
            start += 1 << bit
    return pieces


class Encoder:
    """Ids of a text, as little-endian unsigned 32-bit numbers.

    Texts of Latin characters (below U+0250), where both libraries split alike, go through the same
    vocabulary as ranks, which is several times faster; all other texts, and those with very long runs
    of white space, through the tokenizer file.
    """

    def __init__(self, tokenizer: str, ranks: str | None, pattern: str | None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer)
        self.tokenizer.encode_special_tokens = True
        self.fast = ranks and ranked_vocabulary(ranks, pattern)

    def ids(self, text: str) -> bytes:
        if self.fast and LATIN(text) and not LONG_BLANK(text):
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def ranked_vocabulary(path: str, pattern: str):
    """A vocabulary file of one token (base 64) and its id per line, without special tokens."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(number) for token, number in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def encoder(tokenizer: str, ranks: str | None, pattern: str | None) -> Encoder:
    """Read once per Python worker."""
    return Encoder(tokenizer, ranks, pattern)


def _packed(tokenizer: str, ranks: str | None, pattern: str | None, sequence: int):
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(tokenizer, ranks, pattern).ids
        task, count = TaskContext.get().partitionId(), 0
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                rows = []
                part = batch.slice(first, 500)
                for doc_id, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist()):
                    ids = ids_of(text) + end if text else end
                    for start, length in pieces_of(len(ids) // 4, sequence):
                        name = (task << 40 | count) << 4 | length.bit_length() - 1
                        rows.append((doc_id, start, length, ids[4 * start:4 * (start + length)],
                                     len(ids) // 4, name, 0))
                        count += 1
                columns = list(zip(*rows)) or [()] * 7
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values, kind) for values, kind in zip(columns, kinds)],
                    names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    return run


def pack(
    docs: DataFrame, tokenizer: str, ranks: str | None = None, pattern: str | None = None,
    sequence: int = SEQUENCE,
) -> DataFrame:
    """One row per piece, `ids` as little-endian unsigned 32-bit numbers.

    `sequence` is a power of two up to 32768; `tokenizer` is a file every executor has, `ranks` the
    same vocabulary as ranks with its splitting `pattern`. Without ranks all texts are encoded by
    the tokenizer file, with the same result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_packed(tokenizer, ranks, pattern, sequence), SCHEMA)


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Sequences with one folder per length, so that a batch reads equal lengths."""
    pieces.write.partitionBy("length").parquet(path)
