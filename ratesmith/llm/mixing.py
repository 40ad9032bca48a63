"""Mixing sources to target weights.

The words of a source are one stream, its documents ordered by a hash of doc_id, cut into blocks
of a fixed number of words. Every output shard draws its source counts multinomially, with the chances of
the targets; where a source is drawn more often than its target asks, the last of its slots go to
sources drawn too seldom, so that targets are met and no block is used more than twice. A source's
slot j takes the block that a keyed permutation of the source's block indexes (swap-or-not, a new key
for every pass) assigns to it.
Slots and blocks meet by (source, block), so a hot source is spread over its blocks.

Targets: sources by code point (NULL last) weigh 5, 2, 1, repeating, and share 150 % of all words;
none exceeds twice its words, the excess is shared by weight. A block is used at most twice.
NULL and empty texts have size 0 and take nothing; an empty table gives an empty result. Rows with
the same doc_id are separate documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ratesmith.llm.common import ROW, WORD_PATTERN, numbered, text_of
from ratesmith.sources.workspace import staged

BLOCK_WORDS = 64
SHARD_SLOTS = 65536
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
ROUNDS = 12
SEED = 20
CHUNK_ROWS = 10000
CELLS = 4096
SHARD_BATCH = 4096


def sizes(documents: DataFrame) -> DataFrame:
    return documents.select(
        ROW, "doc_id", "source",
        F.regexp_count(text_of(), F.lit(WORD_PATTERN)).cast("long").alias("size"))


def targets(rows: DataFrame) -> DataFrame:
    """One row per source: its words, blocks, target words and slots.

    The windows without partition run over one row per source.
    """
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]),
                          (place % len(WEIGHTS) + 1).cast("int"))
    weighed = sources.withColumn("weight", weight).withColumn("most", MOST * F.col("source_size"))
    by_limit = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    after = by_limit.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    # words per unit of weight if all sources with a smaller limit stop at theirs
    level = (
        (SHARE * F.sum("source_size").over(everything)
         - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
        / F.sum("weight").over(after)
    )
    levelled = weighed.withColumn("level", level).withColumn(
        "open", F.col("most") / F.col("weight") >= F.col("level"))
    # the level of the first open source; those after it are lower, as open limits lie above it
    shared = F.max(F.when(F.col("open"), F.col("level"))).over(everything)
    target = F.when(F.col("open"), F.least("most", F.col("weight") * shared)).otherwise(F.col("most"))
    blocks = F.ceil(F.col("source_size") / BLOCK_WORDS)
    passes = F.floor(F.col("target") / F.col("source_size"))
    rest = F.round((F.col("target") / F.col("source_size") - passes) * F.col("blocks"))
    return (
        levelled.select("source", "source_size", target.alias("target"), blocks.alias("blocks"))
        .withColumn("slots", F.when(F.col("source_size") > 0, passes * F.col("blocks") + rest)
                    .otherwise(0).cast("long"))
    )


def _same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def pieces(rows: DataFrame) -> DataFrame:
    """The part of every document in each block of its source: first word, words."""
    chunks = max(1, rows.count() // CHUNK_ROWS)
    placed = rows.where("size > 0").withColumn(
        "chunk", F.pmod(F.xxhash64("doc_id"), F.lit(chunks)))
    totals = placed.groupBy("source", "chunk").agg(F.sum("size").alias("chunk_size"))
    earlier = Window.partitionBy("source").orderBy("chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    bases = totals.select(
        "source", "chunk", F.coalesce(F.sum("chunk_size").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("source", "chunk").orderBy(
        F.col("doc_id").asc_nulls_last(), F.col(ROW)).rowsBetween(Window.unboundedPreceding, -1)
    inner = placed.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0)))
    offset = F.col("base") + F.col("before")
    joined = inner.join(bases, _same(inner, bases, "source", "chunk")).select(
        ROW, inner["source"], "size", offset.alias("offset"))
    start = F.col("block") * BLOCK_WORDS
    first = F.greatest("offset", start)
    return joined.select(
        ROW, "source", "offset", "size",
        F.explode(F.sequence(F.floor(F.col("offset") / BLOCK_WORDS),
                             F.floor((F.col("offset") + F.col("size") - 1) / BLOCK_WORDS))).alias("block"),
    ).select(
        ROW, "source", "block",
        (first - F.col("offset")).alias("first_word"),
        (F.least(F.col("offset") + F.col("size"), start + BLOCK_WORDS) - first).alias("words"),
    )


def shard_counts(sources: DataFrame, total_slots: int) -> DataFrame:
    """How many of a shard's slots each source gets: shard, source, n.

    Every place of a shard draws its source with the chances that the sources' slots have among all
    slots, so a shard's counts are one multinomial draw. A place meets the sources of its cell of the
    drawn range only; there are at least as many cells as sources, so small sources that share a
    cell are drawn seldom enough for that. Counts are added up in the map tasks.
    """
    total = max(1, total_slots)
    width = -(-total // (CELLS + sources.count()))
    upto = F.sum("slots").over(Window.orderBy(F.col("source").asc_nulls_last()))
    ranges = sources.where("slots > 0").select("source", (upto - F.col("slots")).alias("low"), upto.alias("high"))
    cells = ranges.select("source", "low", "high", F.explode(F.sequence(
        F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width))).alias("cell"))
    drawn = F.pmod(F.xxhash64(F.lit(SEED), "id"), F.lit(total))
    places = sources.sparkSession.range(total_slots).select(
        F.floor(F.col("id") / SHARD_SLOTS).alias("shard"), drawn.alias("drawn"))
    places = places.withColumn("cell", F.floor(F.col("drawn") / width))
    return places.join(cells, "cell").where("drawn >= low AND drawn < high").groupBy("shard", "source").agg(
        F.count("*").alias("n"))


def _first_slots(counts: DataFrame) -> DataFrame:
    """The counts with the number of the source's slots in earlier shards, added up group by group."""
    grouped = counts.withColumn("batch", F.floor(F.col("shard") / SHARD_BATCH))
    sums = grouped.groupBy("source", "batch").agg(F.sum("n").alias("batch_n"))
    earlier = Window.partitionBy("source").orderBy("batch").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("source", "batch", F.coalesce(F.sum("batch_n").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("source", "batch").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    inner = grouped.withColumn("before", F.coalesce(F.sum("n").over(within), F.lit(0)))
    return inner.join(bases, _same(inner, bases, "source", "batch")).select(
        "shard", inner["source"], "n", (F.col("base") + F.col("before")).alias("first"))


def _moved_slots(placed: DataFrame, counts: DataFrame, sources: DataFrame) -> DataFrame:
    """The slots drawn beyond their source's number, given to the sources drawn too seldom.

    Both are numbered from 0 and there are equally many, of the order of the square root of a source's
    slots. The windows run over one row per source, and over the last shards of the sources
    drawn too often.
    """
    upto = F.sum("over").over(Window.orderBy("shard", F.col("source").asc_nulls_last()))
    beyond = placed.where("over > 0").select("shard", "over", upto.alias("upto")).select(
        "shard", F.explode(F.sequence(F.col("upto") - F.col("over"), F.col("upto") - 1)).alias("number"))
    sums = counts.groupBy("source").agg(F.sum("n").alias("n"))
    drawn = sources.join(sums, _same(sources, sums, "source"), "left").select(
        sources["source"], "blocks", "slots", F.coalesce("n", F.lit(0)).alias("n"))
    short = drawn.where("slots > n").withColumn("short", F.col("slots") - F.col("n"))
    low = F.sum("short").over(Window.orderBy(F.col("source").asc_nulls_last())) - F.col("short")
    fills = short.withColumn("low", low).select(
        "source", "blocks", "n", "low",
        F.explode(F.sequence(F.col("low"), F.col("low") + F.col("short") - 1)).alias("number"))
    return beyond.join(fills, "number").select(
        "shard", "source", "blocks", (F.col("n") + F.col("number") - F.col("low")).alias("slot"))


def draws(sources: DataFrame, total_slots: int) -> DataFrame:
    """One row per slot of the mixture: shard, source, slot, block."""
    counts = staged(shard_counts(sources, total_slots), "shard_counts")
    firsts = _first_slots(counts)
    placed = firsts.join(sources, _same(firsts, sources, "source")).select(
        "shard", firsts["source"], "blocks", "first",
        F.greatest(F.lit(0), F.least("n", F.col("slots") - F.col("first"))).alias("kept"), "n",
    ).withColumn("over", F.col("n") - F.col("kept"))
    step = 4096
    spans = (
        placed.where("kept > 0")
        .select("shard", "source", "blocks", "first", "kept",
                F.explode(F.sequence(F.lit(0), F.floor((F.col("kept") - 1) / step))).alias("span"))
        .repartition("shard", "source", "span")
    )
    own = spans.select(
        "shard", "source", "blocks",
        F.explode(F.sequence(F.col("span") * step,
                             F.least(F.col("kept"), (F.col("span") + 1) * step) - 1)).alias("place"), "first",
    ).select("shard", "source", "blocks", (F.col("first") + F.col("place")).alias("slot"))
    slots = own.unionByName(_moved_slots(placed, counts, sources)).withColumns({
        "pass": F.floor(F.col("slot") / F.col("blocks")),
        "block": F.pmod("slot", "blocks"),
    })
    for key in range(SEED, SEED + ROUNDS):
        shift = F.pmod(F.xxhash64(F.lit(key), "source", "pass"), F.col("blocks"))
        slots = slots.withColumn("partner", F.pmod(shift - F.col("block"), F.col("blocks")))
        swap = F.xxhash64(F.lit(key), F.greatest("block", "partner"), "source", "pass")
        slots = slots.withColumn(
            "block", F.when(swap.bitwiseAND(F.lit(1)) == 1, F.col("partner")).otherwise(F.col("block")))
    return slots.select("shard", "source", "slot", "block")


def mixture(documents: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sizes per row, targets per source, and the drawn parts: shard, slot, row, words."""
    rows = staged(sizes(documents), "sizes")
    sources = staged(targets(rows), "targets")
    total = sources.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    slots, parts = draws(sources, total), pieces(rows)
    # by merge: planning takes the generated slots for a few rows and would broadcast them
    drawn = slots.hint("merge").join(parts, _same(slots, parts, "source", "block")).select(
        "shard", slots["source"], "slot", slots["block"], ROW, "first_word", "words")
    return rows, sources, drawn


def taken_words(documents: DataFrame) -> DataFrame:
    """One row per document: row number, doc_id, size, source_size, target, taken."""
    rows, sources, drawn = mixture(documents)
    taken = drawn.groupBy(ROW).agg(F.sum("words").alias("taken"))
    with_source = rows.join(sources, _same(rows, sources, "source")).select(
        ROW, "doc_id", "size", "source_size", "target")
    return with_source.join(taken, ROW, "left").withColumn(
        "taken", F.coalesce("taken", F.lit(0)))


def mix_report(docs: DataFrame) -> DataFrame:
    return taken_words(numbered(docs, "doc_id", "text", "source")).drop(ROW)


def mixed_documents(documents: DataFrame) -> DataFrame:
    """The documents as the mixture holds them; `documents` carries row numbers and is staged.

    A document that is taken whole comes back unchanged. One that is taken in part holds the
    words of its drawn blocks with the white space before each; a second copy holds what is drawn
    twice. Documents without drawn words go.
    """
    _, _, drawn = mixture(documents)
    copies = drawn.groupBy(ROW, "first_word", "words").agg(F.count("*").alias("uses"))
    parts = (
        copies.select(ROW, "first_word", "words", F.explode(F.sequence(F.lit(1), F.col("uses"))).alias("copy"))
        .groupBy(ROW, "copy")
        .agg(F.sort_array(F.collect_list(F.struct("first_word", "words"))).alias("parts"),
             F.sum("words").alias("words"))
    )
    found = F.regexp_extract_all("text", F.lit("[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+"), F.lit(0))

    def cut(words: Column) -> Column:
        return F.array_join(F.flatten(F.transform(
            "parts", lambda part: F.slice(words, (part["first_word"] + 1).cast("int"), part["words"].cast("int")))), "")

    columns = [name for name in documents.columns if name != ROW]
    whole = F.col("words") == F.regexp_count("text", F.lit(WORD_PATTERN))
    joined = documents.join(parts, ROW)
    # a lambda's argument is evaluated once, whereas a column would be put into every part's expression
    text = F.get(F.transform(F.array(found), cut), F.lit(0))
    return joined.withColumn("text", F.when(whole, F.col("text")).otherwise(text)).select(*columns)
