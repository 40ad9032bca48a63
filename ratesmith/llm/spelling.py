"""Spelling variants by asymmetric q-chunks.

Two words are near if one inserted, deleted or replaced code point turns one into the other.

1. A word of length L is cut into two disjoint chunks, its halves. One edit leaves one of them
   whole. The word posts its chunks; the other word posts grams of the same lengths: at the chunk's
   place if it is as long, and, if it has one code point more, the first chunk at its place and the
   second one place later. Other grams can meet no chunk within a shift of one, so none is posted.
   The shorter word of a pair is always the one in chunks, so that a pair is looked for once.
2. Words meet by key: lengths, place and text of what stayed whole. A key of at most `GROUP_WORDS`
   words is settled by comparing them. The words of a larger one are cut again, in the half that
   holds the edit: what stays whole then is a chunk and half of the other one. Halving ends with
   the place of the edit alone, where a key's words differ in one letter, so that a group has at
   most as many words as the alphabet letters; nothing is dropped.
3. Every pair that meets is verified by its edit distance and counted once.
4. A word's form is its near word of largest count (ties: smallest in code-point order) if that
   is at least `FORM_RATIO` times the word's own. Roots are found by doubling pointers; counts
   double along a chain, so a few rounds do.

Words are the maximal runs of A-Z, a-z and U+00C0 to U+00FF in the whole texts, A-Z lower-cased. NULL
and empty texts have none, a NULL doc_id counts as empty, repeated rows count again, other columns
are not read, and an empty table gives no rows. Texts of any length are read in slices.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ratesmith.sources.workspace import staged

LEAST_LENGTH = 5
LEAST_COUNT = 3
FORM_RATIO = 2
GROUP_WORDS = 24
SLICE = 1 << 20
FLUSH_WORDS = 200_000

#: Latin-1 bytes: letters stay, A-Z lower-cased, everything else is a blank.
_LETTERS = bytes(
    code + 32 if 65 <= code <= 90 else code if 97 <= code <= 122 or code >= 0xC0 else 32 for code in range(256))


def words_of(text: str) -> Iterator[list[bytes]]:
    """The words of a text in Latin-1, slice by slice; no word is cut."""
    letters = text.encode("latin-1", "replace").translate(_LETTERS)
    start = 0
    while start < len(letters):
        end = letters.find(b" ", start + SLICE)
        end = len(letters) if end < 0 else end
        yield letters[start:end].split()
        start = end


def shortened(word: bytes, started: int, every: int) -> bytes:
    """The word without one code point if `every` divides the checksum of doc_id and word."""
    number = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), started)
    if number % every:
        return word
    place = number % len(word)
    return word[:place] + word[place + 1:]


def _counted(least_length: int, every: int | None):
    def result(counts: Counter[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([word.decode("latin-1") for word in counts], pa.string()),
             pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                started = zlib.crc32(f"{doc_id.as_py()}:".encode())
                for found in words_of(text.as_py()):
                    for word, n in Counter(found).items():
                        if every:
                            word = shortened(word, started, every)
                        if len(word) >= least_length:
                            counts[word] += n
                    if len(counts) > FLUSH_WORDS:
                        yield result(counts)
                        counts.clear()
        yield result(counts)

    return run


def word_counts(
    docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, shorten_every: int | None = None,
) -> DataFrame:
    """(word, n) of all words with enough letters and occurrences.

    With `shorten_every`, an occurrence loses one code point when that number divides the crc32 of
    `<doc_id>:<word>`.
    """
    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")
    counts = texts.where("text <> ''").mapInArrow(_counted(least_length, shorten_every), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _halves(regions: DataFrame) -> DataFrame:
    """Each region of a possible edit cut in two, and the key of what stays whole outside.

    Regions are given in the places of the shorter word; `side` is 1 for words one longer.
    """
    middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    # a region of one place: the code point there is replaced, or one is inserted before or after it
    single = F.col("hi") - F.col("lo") == 1
    parts = F.when(single & ~F.col("inserts"), F.array(F.struct("lo", "hi"))).when(single, F.array(F.struct(F.col("lo").alias("lo"), F.col("lo").alias("hi")),
                                   F.struct(F.col("hi").alias("lo"), F.col("hi").alias("hi")))).otherwise(
        F.array(F.struct(F.col("lo").alias("lo"), middle.alias("hi")),
                F.struct(middle.alias("lo"), F.col("hi").alias("hi"))))
    cut = regions.withColumn("part", F.explode(parts)).withColumn("lo", F.col("part.lo")).withColumn(
        "hi", F.col("part.hi")).drop("part")
    key = F.concat_ws(
        ":", "inserts", "base", "lo", "hi", F.substr("word", F.lit(1), F.col("lo")),
        F.substr("word", F.col("hi") + F.col("side") + 1))
    return cut.withColumn("key", key)


def _pairs(settled: DataFrame) -> DataFrame:
    """Near words among those of one small group."""
    groups = settled.groupBy("key", "inserts").agg(F.collect_list(F.struct("side", "word", "n")).alias("words"))
    met = groups.select("inserts", "words", F.explode("words").alias("one")).where("one.side = 0").select(
        "inserts", "one", F.explode("words").alias("two"))
    across = F.when(F.col("inserts"), F.col("two.side") == 1).otherwise(F.col("one.word") < F.col("two.word"))
    return met.where(across).where(F.levenshtein("one.word", "two.word", 1) == 1).select(
        F.col("one.word").alias("word"), F.col("one.n").alias("n"),
        F.col("two.word").alias("near"), F.col("two.n").alias("near_n"))


def near_pairs(words: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """(word, n, near, near_n): each pair of near words once; `words` has distinct `word` and `n`."""
    length = F.char_length("word")

    def whole(inserts: bool, side: int) -> DataFrame:
        base = length - side
        return words.where(base > 0).select(
            "word", "n", F.lit(inserts).alias("inserts"), F.lit(side).alias("side"), base.alias("base"),
            F.lit(0).alias("lo"), base.alias("hi"))

    regions = whole(False, 0).unionByName(whole(True, 0)).unionByName(whole(True, 1))
    found = None
    while True:
        postings = staged(_halves(regions), "chunks")
        # no word and one longer, or no second word: nothing meets at this key
        counts = postings.groupBy("key").agg(
            F.sum(1 - F.col("side")).alias("shorter"), F.sum("side").alias("longer"))
        placed = postings.join(counts.where("shorter > 0 AND shorter + longer > 1"), "key").where(
            "NOT inserts OR longer > 0")
        small = (F.col("shorter") + F.col("longer") <= group_words) | (
            F.col("hi") - F.col("lo") <= F.when(F.col("inserts"), 0).otherwise(1))
        pairs = staged(_pairs(placed.where(small)), "near_words")
        found = pairs if found is None else found.unionByName(pairs)
        regions = staged(placed.where(~small).drop("key", "shorter", "longer"), "open_chunks")
        if regions.isEmpty():
            return found.distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each chain of forms; pointers double every round."""
    reached = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        reached = staged(reached.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if reached.where("moved").isEmpty():
            return reached.drop("moved")
        reached = reached.drop("moved")


def variant_groups(words: DataFrame, form_ratio: float = FORM_RATIO, group_words: int = GROUP_WORDS) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root."""
    words = staged(words.select("word", "n"), "words")
    pairs = staged(near_pairs(words, group_words), "near_pairs")
    swapped = pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"),
                           F.col("word").alias("near"), F.col("n").alias("near_n"))
    best: Column = F.min(F.struct((-F.col("near_n")).alias("order"), "near"))
    near = staged(pairs.unionByName(swapped).groupBy("word", "n").agg(
        F.count("*").alias("n_near"), best.alias("best")).select(
        "word", "n_near", F.when(-F.col("best.order") >= form_ratio * F.col("n"), F.struct(
            F.col("best.near").alias("form"), (-F.col("best.order")).alias("form_n"))).alias("best")), "near")
    formed = near.where("best IS NOT NULL").select("word", F.col("best.form").alias("form"))
    return (
        words.join(near, "word", "left").join(_roots(formed), "word", "left")
        .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                F.col("best.form").alias("form"), F.col("best.form_n").alias("form_n"),
                F.coalesce("root", "word").alias("root"))
    )
