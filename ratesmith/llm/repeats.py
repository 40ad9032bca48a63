"""Long repeated passages by run-length Burrows-Wheeler indexes.

A byte goes if a string of `LENGTH` bytes that covers it starts anywhere else too.

1. Every window of LENGTH bytes has an anchor, its smallest `GRAM`-byte hash (the leftmost of
   equals), so equal windows have equal anchors. Neighbouring windows of one anchor are a fragment:
   the only places where the windows can match are fragments of the same anchor hash.
2. Anchors are counted by Spark. One fragment: nothing repeats. Equal fragments are stored once
   with their number; where an anchor has equal fragments only, all their windows repeat.
3. The different fragments of an anchor are indexed together, in units of bounded size: suffix
   order, Burrows-Wheeler transform, runs. At the run ends the position and the common length with
   the neighbouring suffix are sampled; between samples the matching statistic falls by one per
   byte, so it is streamed over the unit from the samples alone. Windows with a statistic of LENGTH
   repeat. Anchors with more fragments than a unit holds are cut into blocks that meet two by two.
4. Marks go back to every occurrence of a fragment, spans are joined per text and cut out.

Texts are UTF-8 bytes, NULL is empty; shorter texts than LENGTH stay whole. Equal texts are equal
rows from the start, and as they repeat each other nothing of LENGTH or more stays of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ratesmith.llm.common import text_of
from ratesmith.sources.workspace import staged

LENGTH = 400
GRAM = 128
CHUNK_BYTES = 4 << 20
UNIT_BYTES = 2 << 20
INDEX_BYTES = 1 << 20
_PLACE = (1 << 24) - 1
_draw = np.random.default_rng(400)
_BYTES = _draw.integers(1, 1 << 63, 256, np.uint64)
_FACTORS = _draw.integers(1, 1 << 63, 16, np.uint64) | np.uint64(1)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from every place; GRAM is a power of two."""
    values, width, level = _BYTES[data], 1, 0
    while width < GRAM:
        values = values[:-width] * _FACTORS[level] + values[width:]
        values ^= values >> np.uint64(31)
        width, level = width * 2, level + 1
    return values * _FACTORS[level]


def fragments(units: list[bytes]) -> Iterator[tuple[int, int, int, int]]:
    """Number of the unit, first and last window, anchor hash; at most 16 MB in all."""
    sizes = np.array([len(unit) for unit in units], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    hashes = _gram_hashes(np.frombuffer(b"".join(units), np.uint8))
    key = (hashes & ~np.uint64(_PLACE)) | np.arange(len(hashes), dtype=np.uint64)
    span, grams = 1, LENGTH - GRAM + 1
    while span * 2 <= grams:
        key = np.minimum(key[:-span], key[span:])
        span *= 2
    rest = grams - span
    key = np.minimum(key[:len(key) - rest], key[rest:])
    anchor = (key & np.uint64(_PLACE)).astype(np.int64)
    for unit, (start, size) in enumerate(zip(starts, sizes)):
        own = anchor[start:start + size - LENGTH + 1]
        first = np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1])
        last = np.append(first[1:] - 1, len(own) - 1)
        values = hashes[own[first]].view(np.int64)
        yield from zip([unit] * len(first), first.tolist(), last.tolist(), values.tolist())


def _pieces(keys: list, texts: list[str]) -> Iterator[tuple[bytes, int, bytes]]:
    """Parts of texts that overlap by LENGTH - 1 bytes, so that every window is in one part."""
    for key, text in zip(keys, texts):
        data = text.encode()
        for start in range(0, max(0, len(data) - LENGTH + 1), CHUNK_BYTES):
            yield key, start, data[start:start + CHUNK_BYTES + LENGTH - 1]


def _fragment_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found(parts):
        rows = []
        for unit, low, high, anchor in fragments([data for _, _, data in parts]):
            key, start, data = parts[unit]
            content = xxhash.xxh3_64_intdigest(data[low:high + LENGTH])
            rows.append((key, start + low, start + high, anchor, content))
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()),
             pa.array(columns[3], pa.int64()), pa.array(np.array(columns[4], np.uint64).view(np.int64))],
            names=["key", "low", "high", "anchor", "content"])

    for batch in batches:
        parts, size = [], 0
        for piece in _pieces(batch["key"].to_pylist(), batch["text"].to_pylist()):
            parts.append(piece)
            size += len(piece[2])
            if size >= CHUNK_BYTES:
                yield found(parts)
                parts, size = [], 0
        if parts:
            yield found(parts)


def _suffix_order(symbols: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Suffixes in order, and the ranks of their beginnings by length (doubling)."""
    n, levels = len(symbols), []
    ranks, width = symbols.astype(np.int64), 1
    while True:
        levels.append((width, ranks.astype(np.int32)))
        second = np.zeros(n, np.int64)
        second[:n - width] = ranks[width:] + 1 if width < n else 0
        keys = ranks * (int(ranks.max()) + 2) + second
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        steps = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        ranks = np.empty(n, np.int64)
        ranks[order] = steps
        width *= 2
        if steps[-1] == n - 1:
            return order, levels


def matching_statistics(texts: list[bytes]) -> list[np.ndarray]:
    """For every place of every text, how long the longest string from it is that occurs again."""
    many = len(texts)
    symbols = np.concatenate([np.append(np.frombuffer(text, np.uint8).astype(np.int64) + many, number)
                              for number, text in enumerate(texts)])
    order, levels = _suffix_order(symbols)
    before = symbols[order - 1]  # the Burrows-Wheeler transform
    ends = np.flatnonzero(before[1:] != before[:-1]) + 1  # where its runs begin
    above, below = order[ends - 1], order[ends]
    common, a, b = np.zeros(len(ends), np.int64), above.copy(), below.copy()
    for width, ranks in reversed(levels):
        same = ranks[np.minimum(a, len(ranks) - 1)] == ranks[np.minimum(b, len(ranks) - 1)]
        same &= (a < len(ranks)) & (b < len(ranks))
        common += same * width
        a, b = a + same * width, b + same * width
    places = np.arange(len(symbols))

    def streamed(samples: np.ndarray) -> np.ndarray:
        """From a sample on, the statistic falls by one per place until the next sample."""
        reach = np.full(len(symbols), -1, np.int64)
        reach[samples] = samples + common
        latest = np.full(len(symbols), -1, np.int64)
        latest[samples] = samples
        latest = np.maximum.accumulate(latest)
        return np.where(latest >= 0, reach[latest] - places, 0)

    # the first and last suffix of all have a neighbour on one side only
    up, down = streamed(below), streamed(above)
    statistics = np.maximum(0, np.maximum(up, down))
    sizes = np.cumsum([0] + [len(text) + 1 for text in texts])
    return [statistics[start:end - 1] for start, end in zip(sizes, sizes[1:])]


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """First and last place of every run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist()))


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated windows of fragments, from rows in the order of their units."""

    def result(rows):
        unique = {(anchor, content): (data, copies) for anchor, content, data, copies in rows}
        found = []
        for (name, (_, copies)), values in zip(
                unique.items(), matching_statistics([data for data, _ in unique.values()])):
            flags = values[:len(values) - LENGTH + 1] >= LENGTH
            found += [(*name, *run) for run in _runs(flags | (copies > 1))]
        columns = list(zip(*found)) or [()] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(values, pa.int64()) for values in columns], names=["anchor", "content", "first", "last"])

    rows, size, unit = [], 0, None
    for batch in batches:
        for *own, content, data, copies in zip(*(batch[name].to_pylist() for name in (
                "anchor", "low_block", "high_block", "content", "data", "copies"))):
            if rows and own != unit and size >= INDEX_BYTES:
                yield result(rows)
                rows, size = [], 0
            unit = own
            rows.append((own[0], content, data, copies))
            size += len(data)
    if rows:
        yield result(rows)


def _fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted fragments."""
    for batch in batches:
        rows = []
        for text, wanted in zip(batch["text"].to_pylist(), batch["wanted"].to_pylist()):
            data = text.encode()
            rows += [(w["anchor"], w["content"], w["copies"], data[w["low"]:w["high"] + LENGTH]) for w in wanted]
        columns = list(zip(*rows)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(values, pa.int64()) for values in columns[:3]), pa.array(columns[3], pa.binary())],
            names=["anchor", "content", "copies", "data"])


def repeated_spans(texts: DataFrame, unit_bytes: int = UNIT_BYTES) -> DataFrame:
    """(key, start, end) of byte spans whose windows repeat; spans may overlap.

    `texts` has one row per document: key (a digest of the text) and text.
    """
    rows = staged(texts.mapInArrow(
        _fragment_rows, "key binary, low long, high long, anchor long, content long"), "fragments")
    # written, so that both sides of the join are plain shuffles and a hot anchor can be split
    counts = staged(rows.groupBy("anchor").agg(
        F.count("*").alias("n"), (F.min("content") != F.max("content")).alias("mixed")).where("n > 1"), "anchors")
    shared = staged(rows.join(counts.select("anchor", "mixed"), "anchor"), "shared_fragments")
    whole = shared.where("NOT mixed").select("key", F.col("low").alias("start"), (F.col("high") + LENGTH).alias("end"))
    mixed = shared.where("mixed").drop("mixed")
    different = mixed.groupBy("anchor", "content").agg(
        F.count("*").alias("copies"), F.min(F.struct("key", "low", "high")).alias("at"))
    wanted = different.groupBy("at.key").agg(F.collect_list(F.struct(
        "anchor", "content", "copies", F.col("at.low").alias("low"), F.col("at.high").alias("high"))).alias("wanted"))
    data = staged(
        texts.join(wanted.hint("merge"), "key").dropDuplicates(["key"]).select("text", "wanted")
        .mapInArrow(_fetched, "anchor long, content long, copies long, data binary"), "contents")
    blocks = data.groupBy("anchor").agg(F.ceil(F.sum(F.length("data")) / unit_bytes).alias("blocks"))
    units = (
        data.join(blocks, "anchor").withColumn("block", F.pmod("content", "blocks"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("anchor", F.least("block", "other").alias("low_block"),
                F.greatest("block", "other").alias("high_block"), "content", "data", "copies")
    )
    unit = ["anchor", "low_block", "high_block"]
    size = data.agg(F.coalesce(F.sum(F.length("data")), F.lit(0))).first()[0]
    tasks = 1 + size // INDEX_BYTES
    marks = staged(
        units.repartition(tasks, *unit).sortWithinPartitions(*unit)
        .mapInArrow(_marked, "anchor long, content long, first long, last long"), "marks")
    some = mixed.join(marks, ["anchor", "content"]).select(
        "key", (F.col("low") + F.col("first")).alias("start"),
        (F.col("low") + F.col("last") + LENGTH).alias("end"))
    return whole.unionByName(some)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text, spans in zip(*(batch[name].to_pylist() for name in ("doc_id", "text", "spans"))):
            data, merged = text.encode(), []
            for start, end in sorted((s["start"], s["end"]) for s in spans or ()):
                if merged and start <= merged[-1][1]:
                    merged[-1][1] = max(end, merged[-1][1])
                else:
                    merged.append([start, end])
            edges = [0, *(edge for span in merged for edge in span), len(data)]
            kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
            rows.append((doc_id, len(data), len(data) - len(kept), len(merged),
                         hashlib.sha256(kept).hexdigest(), kept, merged))
        columns = list(zip(*rows)) or [()] * 7
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(values, pa.int64()) for values in columns[:4]), pa.array(columns[4], pa.string()),
             pa.array(columns[5], pa.binary()), pa.array(columns[6], pa.list_(pa.list_(pa.int64())))],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"])


def without_repeats(docs: DataFrame, unit_bytes: int = UNIT_BYTES) -> DataFrame:
    """One row per document: doc_id, figures, the bytes that stay and the removed spans."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).withColumn(
        "key", F.unhex(F.md5(F.col("text").cast("binary"))))
    spans = repeated_spans(texts.select("key", "text"), unit_bytes).groupBy("key").agg(
        F.collect_set(F.struct("start", "end")).alias("spans"))
    return texts.join(spans.hint("merge"), "key", "left").select("doc_id", "text", "spans").mapInArrow(
        _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
              "kept binary, spans array<array<long>>")
