"""Packing and mixing against plain versions."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratesmith.llm import common, mixing, packing
from ratesmith.llm.queries import QUERIES, packed_pieces, tokenizer_path

DATA = "/root/testdata/sf0.001"
ODD = [None, "", " ", "\n\n", "a  b\n c\t d ", "x" * 5000, "it's 12 o'clock   café 　z \x1c q",
       "<|endoftext|> tail <|endoftext|>", "́ accent  ​ zero \r\n\r\n  end  ", "1 2  3   4    5"]


@pytest.fixture(scope="module")
def plain_ids():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def test_packing_holds_every_id_once(spark, plain_ids):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame(list(enumerate(ODD, 10**6)), "doc_id long, text string")
    docs = docs.unionByName(odd)
    found = defaultdict(list)
    names = set()
    for row in packed_pieces(docs).collect():
        found[row.doc_id].append(row)
        names.add(row.sequence_id)
        assert row.length & (row.length - 1) == 0 and row.length <= 2048 and row.offset == 0
    assert len(names) == sum(map(len, found.values()))
    for row in docs.collect():
        ids, at = plain_ids(row.text), 0
        for piece in sorted(found[row.doc_id], key=lambda p: p.start):
            assert piece.start == at and piece.doc_tokens == len(ids)
            part = np.array(ids[at:at + piece.length], "<u4").tobytes()
            assert zlib.crc32(part) == piece.ids_crc32
            at += piece.length
        assert at == len(ids)


def test_both_vocabularies_give_the_same_ids(plain_ids):
    import public_tokenizers

    encoder = packing.Encoder(
        tokenizer_path(), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    for ch in map(chr, range(0x24F + 2)):
        for text in (ch, f"a{ch}", f" {ch}a", f"  {ch} b", f"{ch}1{ch}", ch * 3 + " ", f".{ch}\n{ch}", f"it{ch}'s{ch}'ll"):
            assert encoder.ids(text) == np.array(plain_ids(text)[:-1], "<u4").tobytes()


def test_pieces_are_the_binary_digits():
    assert packing.pieces_of(2048 * 2 + 5) == [(0, 2048), (2048, 2048), (4096, 4), (4100, 1)]
    assert packing.pieces_of(1) == [(0, 1)]
    assert packing.pieces_of(0) == []


def plain_targets(sizes: dict) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in fixed]
        unit = (total - sum(fixed.values())) / max(1, sum(weight[s] for s in rest))
        above = [s for s in rest if weight[s] * unit > 2 * sizes[s]]
        if not above:
            return fixed | {s: weight[s] * unit for s in rest}
        fixed |= {s: 2 * sizes[s] for s in above}


@pytest.mark.parametrize("sizes", [
    {"a": 1000, "b": 1000, "c": 1000, "d": 1000}, {"a": 9000, "b": 300, "c": 20, None: 4000},
    {"a": 10, "b": 9000, "c": 9000, "d": 9000, "e": 9000}, {"a": 0, "b": 5}, {None: 7}])
def test_targets_by_levels(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    found = {row.source: row.target for row in mixing.targets(rows).collect()}
    assert found == pytest.approx(plain_targets(sizes))


def test_mixture_meets_its_targets(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "source")
    more = spark.createDataFrame(
        [(None, "one two", None), (7, None, "src1"), (7, "", "src1"), (7, "same words", "src1"),
         (7, "same words", "src1"), (8, "w " * 30000, "src3"), (9, " ", "none")],
        "doc_id long, text string, source string")
    rows = mixing.mix_report(docs.unionByName(more)).collect()
    again = mixing.mix_report(docs.unionByName(more)).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))
    assert len(rows) == docs.count() + 7
    by_target = defaultdict(int)
    for row in rows:
        assert 0 <= row.taken <= 2 * row["size"]
        by_target[row.target, row.source_size] += row.taken
    sizes = defaultdict(int)
    for row in docs.unionByName(more).collect():
        sizes[row.source] += len((row.text or "").encode().split())
    expected = plain_targets(sizes)
    found = {target for target, _ in by_target}
    assert sorted(found) == pytest.approx(sorted(set(expected.values())))
    for (target, _), taken in by_target.items():
        assert abs(taken - target) <= mixing.BLOCK_WORDS + 0.01 * target
    assert sum(by_target.values()) == pytest.approx(1.5 * sum(sizes.values()), rel=0.02)


def test_mixed_documents_hold_the_taken_words(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    documents = common.numbered_documents(docs)
    taken = {row.doc_id: row.taken for row in mixing.taken_words(documents).collect()}
    mixed = mixing.mixed_documents(documents)
    assert mixed.columns == docs.columns
    texts = {row.doc_id: row.text for row in docs.collect()}
    held = defaultdict(int)
    for row in mixed.collect():
        held[row.doc_id] += len(row.text.encode().split())
        words = set(texts[row.doc_id].encode().split())
        assert set(row.text.encode().split()) <= words
    assert all(held[name] == count for name, count in taken.items())


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert packed_pieces(empty).count() == 0
    assert mixing.mix_report(empty).count() == 0
    assert mixing.mixed_documents(common.numbered_documents(empty)).count() == 0


def test_permutation_uses_every_block_once(spark):
    sources = spark.createDataFrame([("a", 1000, 1000), (None, 7, 14)], "source string, blocks long, slots long")
    drawn = mixing.draws(sources, 1014)
    counts = {tuple(r) for r in drawn.groupBy("source", "block").count().groupBy("source", "count").count().collect()}
    assert counts == {("a", 1, 1000), (None, 2, 7)}
    order = [r.block for r in drawn.where("source = 'a'").orderBy("slot").collect()]
    assert order != sorted(order)


def test_shards_draw_their_counts(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 500)
    slots = {"a": 12000, "b": 6000, "c": 2400, None: 7, "d": 0, "e": 1800}
    sources = spark.createDataFrame(
        [(name, max(1, n // 2), n) for name, n in slots.items()], "source string, blocks long, slots long")
    total = sum(slots.values())
    rows = mixing.draws(sources, total).collect()
    again = mixing.draws(sources, total).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))
    by_source, by_shard = defaultdict(list), defaultdict(lambda: defaultdict(int))
    for row in rows:
        by_source[row.source].append(row.slot)
        by_shard[row.shard][row.source] += 1
    # targets are met and every slot occurs once
    assert {name: sorted(found) for name, found in by_source.items()} == {
        name: list(range(n)) for name, n in slots.items() if n}
    assert [sum(by_shard[k].values()) for k in range(len(by_shard))] == [500] * (total // 500) + [total % 500]
    # spread of a multinomial draw: variance 500 p (1 - p) over the shards whose counts were not adjusted
    early = np.array([[by_shard[k][name] for name in "abce"] for k in range(total // 500 - 5)])
    chance = np.array([slots[name] for name in "abce"]) / total
    variance = 500 * chance * (1 - chance)
    assert np.all(np.abs(early.mean(axis=0) - 500 * chance) < 4 * np.sqrt(variance / len(early)))
    assert np.all((early.var(axis=0) > 0.4 * variance) & (early.var(axis=0) < 2 * variance))


def test_many_small_sources_share_a_cell(spark):
    sources = spark.createDataFrame(
        [("big", 10**5, 10**5)] + [(f"s{k}", 1, 1) for k in range(3000)], "source string, blocks long, slots long")
    counts = mixing.draws(sources, 103000).groupBy("source").count().collect()
    assert {row.source: row["count"] for row in counts} == {"big": 10**5} | {f"s{k}": 1 for k in range(3000)}
