"""N-gram Jaccard self-join with adaptive multi-match prefixes, as components.

Two sets that link at `percent` share, among the first n - T + m tokens of each in any common
order (T is the least overlap, percent of n), at least m tokens: lengthening a prefix by m - 1
tokens asks for m matches.

1. Equal sets are one from here on (a representative and its members).
2. A first prefix (m of a thirtieth of n), n-grams of the rarest words first: sets with fewer
   than m tokens that any other first prefix holds link with nothing and go. Word counts come from
   all texts; the `ORDER_WORDS` most frequent ones order the tokens, all others count as rare. The
   order decides the cost, never the result.
3. For the rest, tokens are counted exactly and ordered by count, rarest first. A set with more
   than n - T tokens of its own goes. Every other set picks its m (powers of two) by the estimated
   cost of reading the posting lists of its prefix and of verifying the candidates left.
4. Sets that share a prefix token and fit in size are brought together by components of that
   relation; no pairs are made for it. A component is one unit of work, or, beyond
   `UNIT_TOKENS`, several blocks that meet two by two, so that a task's memory stays bounded.
5. Inside a unit, pairs with min(m) shared prefix tokens that no earlier link connects are
   verified on their whole sets; a unit returns a forest, at most one link per set.

Shingles are compared as 63-bit numbers: 8 bits of rarity, 55 bits of hash. NULL and empty texts have no set and link with nothing;
texts of fewer words than a shingle are one shingle. Repeated rows share a component.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ratesmith.llm.common import ROW, numbered, text_of
from ratesmith.llm.components import components
from ratesmith.sources.workspace import discard, staged

FIRST_SHARE = 30
ORDER_WORDS = 4096
UNIT_TOKENS = 1_000_000
VERIFY_COST = 20.0
MANY = 32
CACHED_WORDS = 300_000
TEXT = "text_key"


class Words(dict):
    """Places of words in arrays of their hashes and of the logarithms of their counts."""

    def __init__(self, counts: dict[bytes, int]):
        super().__init__()
        self.counts = counts
        self.hashes, self.logs = np.zeros(0, np.uint64), np.zeros(0)

    def make_room(self, words: int) -> None:
        if len(self) + words > len(self.hashes):
            self.clear()
            room = max(CACHED_WORDS, words)
            if room > len(self.hashes):
                self.hashes, self.logs = np.zeros(room, np.uint64), np.zeros(room)

    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self)
        self.hashes[place] = xxhash.xxh3_64_intdigest(word)
        self.logs[place] = np.log2(1 + self.counts.get(word, 0))
        return place


def shingles(text: str, words: int, known: Words) -> np.ndarray:
    """Sorted distinct word n-grams of a text, those of rare words first."""
    found = text.encode().lower().split()
    if not found:
        return np.zeros(0, np.int64)
    if len(found) < words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(found)) >> 9], np.int64)
    known.make_room(len(found))
    places = np.fromiter(map(known.__getitem__, found), np.int64, len(found))
    values, logs = known.hashes[places], known.logs[places]
    mixed, rarity = np.zeros(len(found) - words + 1, np.uint64), np.zeros(len(found) - words + 1)
    for place in range(words):
        mixed = (mixed * np.uint64(0x9E3779B97F4A7C15)) ^ values[place:place + len(mixed)]
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        rarity += logs[place:place + len(mixed)]
    mixed ^= mixed >> np.uint64(32)
    level = np.minimum(255, rarity * (255 / (40 * words))).astype(np.int64)
    return np.unique(level << 55 | (mixed >> np.uint64(9)).astype(np.int64))


def _often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The most frequent words of each batch of texts."""
    for batch in batches:
        counts: Counter[bytes] = Counter()
        for text in batch["text"].to_pylist():
            counts.update(text.encode().lower().split())
        top = counts.most_common(ORDER_WORDS)
        yield pa.RecordBatch.from_arrays(
            [pa.array([word for word, _ in top], pa.binary()), pa.array([n for _, n in top], pa.int64())],
            names=["word", "n"])


def frequent_words(texts: DataFrame) -> dict[bytes, int]:
    counts = texts.select("text").mapInArrow(_often, "word binary, n long").groupBy("word").agg(
        F.sum("n").alias("n"))
    return {bytes(row.word): row.n for row in
            counts.orderBy(F.col("n").desc(), "word").limit(ORDER_WORDS).collect()}


def overlap(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def first_matches(n: int) -> int:
    return -(-n // FIRST_SHARE)


def _sets(words: int, percent: int, counts: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words(counts)
        for batch in batches:
            sizes, keys, probes = [], [], []
            for text in batch["text"].to_pylist():
                tokens = shingles(text, words, known)
                n = len(tokens)
                sizes.append(n)
                keys.append(xxhash.xxh3_128_digest(tokens.tobytes()))
                probes.append(tokens[:n - overlap(n, percent) + first_matches(n)])
            yield pa.RecordBatch.from_arrays(
                [batch[ROW], batch["doc_id"], batch[TEXT], pa.array(sizes, pa.int64()),
                 pa.array(keys, pa.binary()), pa.array(probes, pa.list_(pa.int64()))],
                names=[ROW, "doc_id", TEXT, "n", "set_key", "probe"])

    return run


def _whole_sets(words: int, counts: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words(counts)
        for batch in batches:
            sets = [shingles(text, words, known) for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch[TEXT], pa.array(map(len, sets), pa.int64()), pa.array(sets, pa.list_(pa.int64()))],
                names=["rep", "n", "tokens"])

    return run


def _survivors(sets: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Representatives whose first prefix shares enough tokens with other sets'.

    Copies of a set post the same tokens; a token is shared if different sets post it, and a
    set's matches are counted over its copies.
    """
    postings = sets.select("set_id", F.explode("probe").alias("token"))
    shared = postings.groupBy("token").agg(
        F.min("set_id").alias("low"), F.max("set_id").alias("high")).where("low < high").select("token")
    counts = postings.join(shared, "token").groupBy("set_id").agg(F.count("*").alias("matches"))
    least = F.ceil(F.ceil(F.col("n") * percent / 100) / FIRST_SHARE)
    return counts.join(groups, "set_id").where(F.col("matches") >= least * F.col("copies")).select("rep")


def _chosen_prefix(percent: int):
    """Adds the matches asked for and the prefix, tokens in ascending order of their count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked, prefixes, sets = [], [], []
            for n, shared in zip(batch["n"].to_pylist(), batch["shared"]):
                counts = shared.values.field("df").to_numpy(zero_copy_only=False) - 1
                tokens = shared.values.field("token").to_numpy(zero_copy_only=False)
                reach = n - overlap(n, percent) - (n - len(tokens))
                cost, best = None, 1
                matches = 1
                while matches <= max(1, n // 4):
                    scanned = float(counts[:reach + matches].sum())
                    total = scanned + VERIFY_COST * scanned / matches
                    if cost is None or total < cost:
                        cost, best = total, matches
                    matches *= 2
                asked.append(best)
                prefixes.append(tokens[:reach + best])
                sets.append(np.sort(tokens))
            yield pa.RecordBatch.from_arrays(
                [batch["rep"], batch["n"], pa.array(asked, pa.int64()),
                 pa.array(prefixes, pa.list_(pa.int64())), pa.array(sets, pa.list_(pa.int64()))],
                names=["rep", "n", "asked", "prefix", "tokens"])

    return run


def _clusters(ordered: DataFrame, percent: int) -> DataFrame:
    """(rep, cluster): sets that share a prefix token and fit in size are in one cluster."""
    band = F.floor(F.log("n") / F.log(F.lit(100 / percent)))
    postings = ordered.select("rep", band.alias("band"), F.explode("prefix").alias("token"))
    posts = postings.select("rep", "token", F.explode(F.array("band", F.col("band") + 1)).alias("band"))
    lowest = posts.groupBy("token", "band").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where(
        "low < high").select("token", "band", "low")
    links = posts.join(lowest, ["token", "band"]).select(F.col("rep").alias("u"), F.col("low").alias("v"))
    return components(links).select(F.col("node").alias("rep"), F.col("component").alias("cluster"))


def links_of(reps, sizes, asked, prefixes, sets, sides, percent: int) -> list[tuple[int, int]]:
    """A forest of the links between sets; with two sides, of those across them."""
    order = np.argsort(np.array(sizes), kind="stable")
    reps, sizes, asked, sides = (np.array(values)[order] for values in (reps, sizes, asked, sides))
    prefixes, sets = [prefixes[i] for i in order], [sets[i] for i in order]
    across = len(set(sides.tolist())) > 1

    def lists(arrays):
        """Posting lists: for each array, the starts and ends of its tokens' members."""
        tokens = np.concatenate(arrays)
        members = np.repeat(np.arange(len(arrays)), [len(a) for a in arrays])
        by_token = np.argsort(tokens, kind="stable")
        ordered = tokens[by_token]
        members = members[by_token]
        return members, [(np.searchsorted(ordered, a, "left"), np.searchsorted(ordered, a, "right")) for a in arrays]

    def counts(index, at):
        members, spans = index
        parts = [members[a:b] for a, b in zip(*spans[at])]
        found = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        return np.bincount(found[found < at], minlength=at)[:at]

    short, whole = lists(prefixes), None
    labels, forest = np.arange(len(reps)), []
    for at in range(1, len(reps)):
        matches = counts(short, at)
        possible = (
            (matches >= np.minimum(asked[at], asked[:at])) & (100 * sizes[:at] >= percent * sizes[at])
            & (labels[:at] != labels[at])
        )
        if across:
            possible &= sides[:at] != sides[at]
        candidates = np.flatnonzero(possible)
        if len(candidates) > MANY:
            whole = whole or lists(sets)
            common = counts(whole, at)[candidates]
        else:
            common = np.array([len(np.intersect1d(sets[at], sets[other], True)) for other in candidates], np.int64)
        linked = 100 * common >= percent * (sizes[at] + sizes[candidates] - common)
        for other in candidates[linked]:
            if labels[other] != labels[at]:
                labels[labels == labels[other]] = labels[at]
                forest.append((int(reps[at]), int(reps[other])))
    return forest


def _linked(percent: int):
    names = ["rep", "n", "asked", "prefix", "tokens", "block"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(rows):
            columns = [list(values) for values in zip(*rows)]
            found = links_of(*columns, percent) if len(rows) > 1 else []
            return pa.RecordBatch.from_arrays(
                [pa.array([u for u, _ in found], pa.int64()), pa.array([v for _, v in found], pa.int64())],
                names=["u", "v"])

        unit, rows = None, []
        for batch in batches:
            units = zip(*(batch[name].to_pylist() for name in ("cluster", "low", "high")))
            columns = [batch[name].to_pylist() if name not in ("prefix", "tokens") else
                       [value.values.to_numpy() for value in batch[name]] for name in names]
            for own, row in zip(units, zip(*columns)):
                if own != unit:
                    if rows:
                        yield result(rows)
                    unit, rows = own, []
                rows.append(row)
        if rows:
            yield result(rows)

    return run


def _links(ordered: DataFrame, clusters: DataFrame, percent: int, unit_tokens: int) -> DataFrame:
    placed = ordered.join(clusters, "rep")
    blocks = placed.groupBy("cluster").agg(
        F.ceil(F.sum(F.size("tokens")) / unit_tokens).alias("blocks"))
    block = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    units = (
        placed.join(blocks, "cluster").withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("cluster", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                "rep", "n", "asked", "prefix", "tokens", "block")
    )
    key = ["cluster", "low", "high"]
    return units.repartition(*key).sortWithinPartitions(*key).mapInArrow(_linked(percent), "u long, v long")


def near_components(documents: DataFrame, words: int, percent: int, unit_tokens: int = UNIT_TOKENS) -> DataFrame:
    """One row per document: row number, doc_id, n_shingles, component_id (smallest doc_id)."""
    texts = documents.select(
        ROW, F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).withColumn(
        TEXT, F.xxhash64("text"))
    counts = frequent_words(texts)
    first = staged(texts.mapInArrow(
        _sets(words, percent, counts),
        f"{ROW} long, doc_id long, {TEXT} long, n long, set_key binary, probe array<long>"), "sets")
    sets_path = first.staged_path
    first = first.withColumn("set_id", F.xxhash64("set_key"))
    groups = staged(first.where("n > 0").groupBy("set_id").agg(
        F.min(TEXT).alias("rep"), F.max("n").alias("n"), F.count("*").alias("copies")), "groups")
    members = staged(first.select(ROW, "doc_id", "n", "set_id").join(
        groups.select("set_id", "rep"), "set_id", "left").drop("set_id"), "set_members")
    alive = staged(_survivors(first, groups, percent), "survivors")
    discard(first.sparkSession, sets_path)
    whole = staged(
        # by merge at every size: the survivors grow with the documents
        texts.select(TEXT, "text").join(alive.hint("merge"), F.col(TEXT) == F.col("rep"), "left_semi")
        .dropDuplicates([TEXT]).mapInArrow(_whole_sets(words, counts), "rep long, n long, tokens array<long>"),
        "whole_sets")
    postings = whole.select("rep", "n", F.explode("tokens").alias("token"))
    frequency = postings.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    shared = postings.join(frequency, "token").groupBy("rep", "n").agg(
        F.sort_array(F.collect_list(F.struct("df", "token"))).alias("shared"))
    ordered = staged(
        shared.where(F.size("shared") >= F.ceil(F.col("n") * percent / 100))
        .mapInArrow(_chosen_prefix(percent),
                    "rep long, n long, asked long, prefix array<long>, tokens array<long>"), "ordered")
    clusters = staged(_clusters(ordered, percent), "clusters")
    links = staged(_links(ordered, clusters, percent, unit_tokens), "links")
    joined = components(links).withColumnRenamed("node", "rep")
    placed = staged(members.join(joined, "rep", "left").select(
        ROW, "doc_id", "n", F.coalesce("component", "rep").alias("component")), "members")
    names = placed.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return placed.join(names, "component", "left").select(
        ROW, "doc_id", F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"))


def near_copies(docs: DataFrame, words: int = 3, percent: int = 90) -> DataFrame:
    return near_components(numbered(docs, "doc_id", "text"), words, percent).drop(ROW)
