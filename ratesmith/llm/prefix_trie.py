"""Prefix trie of conversations by van Emde Boas recursion.

A node is a distinct sequence of first turns. Cutting all sequences at half of the longest depth
(a power of two) gives an upper trie and, below every distinct upper half, a lower forest; both are
cut again, all of one depth in parallel, until single turns are left.

1. Turns are numbered from a range partitioning by conversation and turn, so that one conversation
   may be spread over many tasks, and then stand in blocks of `BLOCK_TURNS`. Inside a block the
   recursion runs in its task, above it on block rows in Spark.
2. Naming. A cut at depth d = s + 2^j ends an upper half that begins at s; its name is a digest of
   the name of the cut at s (the forest it is in) and of the block of 2^j turns, itself named by
   its two halves. Every depth is a cut of exactly one level, the number j of its trailing zeros,
   so the names of the cuts are the names of all nodes.
3. The nodes are the distinct names, with the number and the smallest of their conversations.
4. Grafting. From the smallest blocks up, the total of each lower forest is added to the nodes of
   its upper half: the tops of the forest hold its total once all smaller blocks are grafted. A
   top takes part in one level only, a cut too, so a level is two aggregations of its own rows.
   Path pairs (cut, node above it in the upper half) are distinct, never pairs of conversations.

Names are 128-bit digests, held as two integers. NULL roles and texts are empty texts, rows without a
conv_id belong to no conversation, NULL turns come first, ties go by the digest of role and text,
repeated rows are turns of their own, other columns are not read. An empty table has no nodes.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ratesmith.sources.workspace import staged

BLOCK_TURNS = 256
ENDS_BYTES = 1 << 16
BATCH_ROWS = 50_000
ROOT = b"\0" * 16


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, digest, chars), NULL roles and texts as empty texts."""
    role, text = (F.coalesce(name, F.lit("")) for name in ("role", "text"))
    turns = conversations.where("conv_id IS NOT NULL").select("conv_id", "turn", role.alias("role"), text.alias("text"))
    content = F.concat(F.char_length("role"), F.lit(":"), "role", "text")
    return turns.withColumn("digest", F.substring(F.unhex(F.sha2(content, 256)), 1, 16)).withColumn(
        "chars", F.char_length("text").cast("long"))


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, digest, chars): turns in order, counted from 1.

    Rows are dealt by range, so a long conversation is not one task's; the few conversations that
    begin in an earlier partition are counted on from there.
    """
    turns = staged(turns_of(conversations).select("conv_id", "turn", "digest", "chars"), "digests")
    dealt = turns.repartitionByRange("conv_id", F.col("turn").asc_nulls_first(), "digest")
    part = F.spark_partition_id().alias("part")
    rows = staged(dealt.select(part, "*"), "turns")
    held = rows.groupBy("conv_id", "part").agg(F.count("*").alias("held"))
    spread = rows.groupBy("conv_id").agg(F.min("part").alias("low"), F.max("part").alias("high")).where(
        "low < high").select("conv_id")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.join(spread, "conv_id").select(
        "conv_id", "part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("before"))
    order = Window.partitionBy("conv_id", "part").orderBy(
        F.col("turn").asc_nulls_first(), "digest")
    return rows.withColumn("own", F.row_number().over(order)).join(offsets, ["conv_id", "part"], "left").select(
        "conv_id", (F.col("own") + F.coalesce("before", F.lit(0))).cast("long").alias("place"), "digest", "chars")


def _names_in(digests: list[bytes], start: bytes) -> tuple[list[bytes], list[bytes]]:
    """Names of the prefixes of a block that begins at the cut `start`, and of its dyadic parts."""
    parts, level = [digests], digests
    while len(level) > 1:
        level = [_joined(level[at], level[at + 1]) for at in range(0, len(level) - 1, 2)]
        parts.append(level)
    names = [start]
    for depth in range(1, len(digests) + 1):
        low = depth & -depth
        names.append(_joined(names[depth - low], parts[low.bit_length() - 1][(depth - low) // low]))
    return names, parts[-1]


def _joined(first: bytes, second: bytes) -> bytes:
    return sha256(first + second).digest()[:16]


def _joined_columns(first: str, second: str) -> Column:
    return F.substring(F.unhex(F.sha2(F.concat(first, second), 256)), 1, 16)


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names of full blocks as one part of the recursion above them."""
    for batch in batches:
        names = [_names_in(digests, ROOT)[1][0] for digests in batch["digests"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch["conv_id"], batch["block"], pa.array(names, pa.binary())], names=["conv_id", "block", "name"])


def _cuts_between_blocks(blocks: DataFrame, most: int) -> DataFrame:
    """(conv_id, block, start, end, covers): names of the cuts around each block of a long conversation.

    `end` is there after full blocks. `covers` holds the later cuts whose upper half includes the block. `most` is the largest number
    of blocks in a conversation.
    """
    size = F.size("digests")
    parts = [staged(blocks.where(size == BLOCK_TURNS).select("conv_id", "block", "digests").mapInArrow(
        _whole_blocks, "conv_id long, block long, name binary"), "block_names")]
    while most >> len(parts):
        pair = F.floor(F.col("block") / 2).cast("long")
        first = F.col("block") % 2 == 0
        parts.append(staged(
            parts[-1].groupBy("conv_id", pair.alias("block")).agg(
                F.max(F.when(first, F.col("name"))).alias("one"), F.max(F.when(~first, F.col("name"))).alias("two"))
            .where("one IS NOT NULL AND two IS NOT NULL")
            .select("conv_id", "block", _joined_columns("one", "two").alias("name")), "block_names"))
    starts = blocks.where("block = 0").select("conv_id", F.lit(0).cast("long").alias("block"), F.lit(ROOT).alias("start"))
    cuts = None
    for level in reversed(range(len(parts))):
        # cuts of this level: an upper half of 2^level blocks that begins at a cut of a higher one
        halves = parts[level].where(F.col("block") % 2 == 0).select(
            "conv_id", (F.col("block") * (1 << level)).alias("block"), "name")
        made = staged(starts.join(halves, ["conv_id", "block"]).select(
            "conv_id", (F.col("block") + (1 << level)).alias("block"), _joined_columns("start", "name").alias("start"),
            F.lit(1 << level).cast("long").alias("span")), "cuts")
        cuts = made if cuts is None else cuts.unionByName(made)
        starts = starts.unionByName(made.drop("span"))
    inside = F.sequence(F.col("block") - F.col("span"), F.col("block") - 1)
    covers = cuts.select(
        "conv_id", F.explode(inside).alias("block"), F.struct("block", "start").alias("cut")).groupBy(
        "conv_id", "block").agg(F.collect_list("cut").alias("covers"))
    ends = starts.select("conv_id", (F.col("block") - 1).alias("block"), F.col("start").alias("end"))
    return starts.join(covers, ["conv_id", "block"], "left").join(ends, ["conv_id", "block"], "left")


class _Named:
    """Turn rows (node, the one above) and path pairs (cut, node, the one above it) of blocks."""

    def __init__(self):
        self.turns, self.pairs = [], []

    def add(self, conv_id, block, digests, sizes, last, start, end, covers) -> None:
        names = _names_in(digests, start or ROOT)[0]
        names[-1] = end or names[-1]  # the upper half that ends here may begin in an earlier block
        first = block * BLOCK_TURNS
        for at in range(1, len(names)):
            goes_on = first + at < last
            self.turns.append((conv_id, first + at, sizes[at - 1], goes_on, names[at], names[at - 1]))
            if goes_on and at < BLOCK_TURNS:
                low = at & -at
                self._path(names, at, low.bit_length() - 1, first, range(at - low + 1, at + 1))
        for cut in covers or ():
            depth = cut["block"] * BLOCK_TURNS
            if depth < last:
                self._path(names, cut["start"], (depth & -depth).bit_length() - 1, first, range(1, len(names)))

    def _path(self, names, cut, level, first, places) -> None:
        name = names[cut] if isinstance(cut, int) else cut
        for place in places:
            self.pairs.append((level, first + place, name, names[place], names[place - 1]))

    def batch(self) -> pa.RecordBatch:
        conv_ids, depths, chars, goes_on, own, above = map(list, zip(*self.turns))
        levels, path_depths, cuts, on_path, over_path = map(list, zip(*self.pairs)) if self.pairs else ([],) * 5
        turns, no = len(conv_ids), [None] * len(cuts)
        self.turns, self.pairs = [], []
        return pa.RecordBatch.from_arrays(
            [pa.array([False] * turns + [True] * len(no)), pa.array(conv_ids + no, pa.int64()),
             pa.array(depths + path_depths, pa.int64()), pa.array(chars + no, pa.int64()),
             pa.array(goes_on + no, pa.bool_()), pa.array([None] * turns + levels, pa.int32()),
             *_halves(own + on_path), *_halves(above + over_path), *_halves([ROOT] * turns + cuts)],
            names=[field.split()[0] for field in NAMED.split(", ")])


def _halves(names: list[bytes]) -> list[pa.Array]:
    """128-bit names as two columns of integers."""
    pairs = np.frombuffer(b"".join(names), "<i8").reshape(-1, 2)
    return [pa.array(pairs[:, 0]), pa.array(pairs[:, 1])]


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = _Named()
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_TURNS):
            part = batch.slice(start, BLOCK_TURNS)
            for row in zip(*(part[name].to_pylist() for name in BLOCK_COLUMNS)):
                rows.add(*row)
                if len(rows.turns) + len(rows.pairs) > BATCH_ROWS:
                    yield rows.batch()
    if rows.turns:
        yield rows.batch()


BLOCK_COLUMNS = ["conv_id", "block", "digests", "chars", "last", "start", "end", "covers"]
NAMED = ("is_pair boolean, conv_id long, depth long, chars long, goes_on boolean, level int, "
         "a long, b long, up_a long, up_b long, cut_a long, cut_b long")


def named_turns(turns: DataFrame) -> DataFrame:
    """Turn rows and path pairs of (conv_id, place, digest, chars), staged."""
    block = F.floor((F.col("place") - 1) / BLOCK_TURNS).cast("long")
    turn = F.struct("place", "digest", "chars")
    blocks = turns.groupBy("conv_id", block.alias("block")).agg(F.sort_array(F.collect_list(turn)).alias("turns")).select(
        "conv_id", "block", F.col("turns.digest").alias("digests"), F.col("turns.chars").alias("chars"))
    lengths = turns.groupBy("conv_id").agg(F.max("place").alias("last"))
    blocks = staged(blocks.join(lengths, "conv_id"), "turn_blocks")
    most = (blocks.agg(F.max("block")).first()[0] or 0) + 1
    if most > 1:
        cuts = _cuts_between_blocks(blocks.where(F.col("last") > BLOCK_TURNS), most)
        blocks = blocks.join(cuts, ["conv_id", "block"], "left")
    else:
        no_cut = F.lit(None).cast("binary")
        blocks = blocks.withColumns({"start": no_cut, "end": no_cut}).withColumn(
            "covers", F.lit(None).cast("array<struct<block:long,start:binary>>"))
    return staged(blocks.mapInArrow(_named, NAMED), "named_turns")


def _trailing_zeros(column, most: int):
    level = F.lit(most)
    for bit in reversed(range(most)):
        level = F.when(column % (1 << (bit + 1)) != 0, F.lit(bit)).otherwise(level)
    return level


def _totals(nodes: DataFrame, pairs: DataFrame, deepest: int) -> DataFrame:
    """What lower forests add to the nodes: (a, b, saved, leaves), several rows a node."""
    levels = max(deepest - 1, 0).bit_length()
    # a node is a top of one forest, that of the cut above it
    tops = staged(nodes.where("depth > 1").select(
        F.col("up_a").alias("cut_a"), F.col("up_b").alias("cut_b"), "saved", "leaves",
        _trailing_zeros(F.col("depth") - 1, levels).alias("level")), "forest_tops")
    grafted = None
    for level in range(levels):
        totals = tops.where(F.col("level") == level).drop("level")
        if grafted is not None:
            totals = totals.unionByName(grafted.where(F.col("level") == level).select(
                F.col("up_a").alias("cut_a"), F.col("up_b").alias("cut_b"), "saved", "leaves"))
        totals = totals.groupBy("cut_a", "cut_b").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
        added = pairs.where(F.col("level") == level).drop("level").join(totals, ["cut_a", "cut_b"]).groupBy(
            "a", "b", "up_a", "up_b", "depth").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
        added = staged(added.withColumn("level", _trailing_zeros(F.col("depth") - 1, levels)), "grafted")
        grafted = added if grafted is None else grafted.unionByName(added)
    return grafted


def prefix_trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """One row per node with members: smallest one, depth, counts and subtree totals, and its name.

    `turns` has (conv_id, place from 1 without gaps, digest, chars); `members` names every
    conversation (conv_id), those without turns included. `a` and `b` are a node's name.
    """
    named = named_turns(turns)
    by_name = named.where("NOT is_pair").groupBy("a", "b", "up_a", "up_b", "depth").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("chars").alias("chars"),
        F.max("goes_on").alias("goes_on"))
    nodes = staged(by_name.select(
        "a", "b", "up_a", "up_b", "depth", "n_convs", "conv_id",
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
        F.when(F.col("goes_on"), 0).otherwise(1).cast("long").alias("leaves")), "nodes")
    pairs = staged(named.where("is_pair").select(
        "cut_a", "cut_b", "a", "b", "up_a", "up_b", "depth", "level").distinct(), "path_pairs")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    grafted = _totals(nodes, pairs, deepest)
    own = nodes.select("a", "b", "up_a", "up_b", "saved", "leaves", F.lit(0).alias("children"))
    sums = own if grafted is None else own.unionByName(
        grafted.select("a", "b", "up_a", "up_b", "saved", "leaves", F.lit(0).alias("children")))
    no_node = F.lit(None).cast("long")
    zero = F.lit(0).cast("long")
    counted = nodes.select(
        F.col("up_a").alias("a"), F.col("up_b").alias("b"), zero.alias("saved"), zero.alias("leaves"),
        F.lit(1).alias("children"))
    totals = sums.drop("up_a", "up_b").unionByName(counted).groupBy("a", "b").agg(
        F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"),
        F.sum("children").alias("n_children"))
    parents = nodes.select(F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv_id").alias("parent_conv_id"))
    below = nodes.where("depth > 1").join(parents, ["up_a", "up_b"]).select(
        "a", "b", "conv_id", "depth", "parent_conv_id", "n_convs")
    everyone = members.agg(F.min("conv_id").alias("least"), F.count("*").alias("count")).first()
    least = F.lit(everyone["least"]).cast("long")
    first = nodes.where("depth = 1").withColumn("parent_conv_id", least)
    placed = below.unionByName(first.select("a", "b", "conv_id", "depth", "parent_conv_id", "n_convs"))
    inner = placed.join(totals, ["a", "b"]).select(
        "a", "b", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
    # the root: its subtree is that of the nodes of depth 1
    tops = nodes.where("depth = 1").select("a", "b").join(totals, ["a", "b"]).agg(
        F.count("*").alias("n_children"), F.greatest(F.coalesce(F.sum("n_leaves"), zero), F.lit(1)).alias("n_leaves"),
        F.coalesce(F.sum("saved_tokens"), zero).alias("saved_tokens"))
    root = tops.where(F.lit(everyone["count"] > 0)).select(
        zero.alias("a"), zero.alias("b"), least.alias("conv_id"), zero.alias("depth"),
        no_node.alias("parent_conv_id"), F.lit(everyone["count"]).cast("long").alias("n_convs"),
        "n_children", "n_leaves", "saved_tokens")
    ends = named.where("NOT is_pair AND NOT goes_on").select("conv_id", "a", "b")
    turnless = members.join(turns.where("place = 1").select("conv_id"), "conv_id", "left_anti").select(
        "conv_id", zero.alias("a"), zero.alias("b"))
    hashes = ends_hashes(ends.unionByName(turnless))
    return inner.unionByName(root).join(hashes, ["a", "b"], "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(sha256().hexdigest())))


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one node's sorted members as texts of bounded size."""
    node, first, ids, size = None, None, [], 0

    def result():
        return pa.RecordBatch.from_arrays(
            [pa.array([node[0]], pa.int64()), pa.array([node[1]], pa.int64()), pa.array([first], pa.int64()),
             pa.array([",".join(ids)])], names=["a", "b", "first", "ids"])

    for batch in batches:
        for a, b, conv_id in zip(*(batch[name].to_pylist() for name in ("a", "b", "conv_id"))):
            if ids and ((a, b) != node or size > ENDS_BYTES):
                yield result()
                ids, size = [], 0
            if not ids:
                node, first = (a, b), conv_id
            ids.append(str(conv_id))
            size += len(ids[-1]) + 1
    if ids:
        yield result()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    node, state = None, None

    def result(rows):
        a, b, digests = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(digests)], names=["a", "b", "ends_sha256"])

    for batch in batches:
        rows = []
        for a, b, ids in zip(*(batch[name].to_pylist() for name in ("a", "b", "ids"))):
            if (a, b) == node:
                state.update(b",")
            else:
                if node is not None:
                    rows.append((*node, state.hexdigest()))
                node, state = (a, b), sha256()
            state.update(ids.encode())
        if rows:
            yield result(rows)
    if node is not None:
        yield result([(*node, state.hexdigest())])


def ends_hashes(ends: DataFrame) -> DataFrame:
    """(a, b, ends_sha256): hash of each node's conv_ids, ascending and comma-joined.

    Ids are sorted by range and joined to texts of about `ENDS_BYTES`, so that a node where very
    many conversations end sends few rows to the task that hashes them one after the other.
    """
    runs = ends.repartitionByRange("a", "b", "conv_id").sortWithinPartitions("a", "b", "conv_id").mapInArrow(
        _joined_ids, "a long, b long, first long, ids string")
    return runs.repartition("a", "b").sortWithinPartitions("a", "b", "first").mapInArrow(
        _hashed, "a long, b long, ends_sha256 string")


def rebuilt(conversations: DataFrame, family: int = 100, heads: int = 6) -> tuple[DataFrame, DataFrame]:
    """(turns, members) of rebuilt conversations.

    The first h turns come from the conversation whose number is the next multiple of `family`
    below, the rest from the conversation itself; h is the crc32 of its number modulo `heads`.
    """
    turns = staged(numbered_turns(conversations), "numbered_turns")
    base = F.col("conv_id") - F.col("conv_id") % family
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads)).cast("int")
    members = turns.where("place = 1").select("conv_id", base.alias("base"), taken.alias("taken"))
    head = turns.where((F.col("place") < heads) & (F.col("conv_id") == base)).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("place", "digest", "chars"))).alias("head")).withColumnRenamed("conv_id", "base")
    heads_of = staged(members.join(head, "base", "left").select(
        "conv_id", "taken", F.slice(F.coalesce("head", F.array().cast("array<struct<place:long,digest:binary,chars:long>>")),
                                    F.lit(1), F.col("taken")).alias("head")), "heads")
    given = heads_of.select("conv_id", F.explode("head").alias("turn")).select("conv_id", "turn.*")
    own = turns.join(heads_of.select("conv_id", "taken", F.size("head").alias("held")), "conv_id").where(
        "place > taken").select("conv_id", (F.col("place") - F.col("taken") + F.col("held")).alias("place"), "digest", "chars")
    return staged(given.unionByName(own), "rebuilt_turns"), heads_of.select("conv_id")
