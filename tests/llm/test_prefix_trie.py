"""The trie of conversations against one built turn by turn."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from ratesmith.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_trie(sequences):
    """Rows of all nodes from conv_id -> list of (role, text)."""
    members = defaultdict(list)
    for conv_id, turns in sequences.items():
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].append(conv_id)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[c] for c in below) or 1
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        saved[node] = own + sum(saved[c] for c in below)
    rows = []
    for node, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if len(sequences[c]) == len(node))))
        rows.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]),
                     leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=repr)


def ordered(rows):
    """conv_id -> turns in order, from rows without ties."""
    found = defaultdict(list)
    for conv_id, turn, role, text in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        found[conv_id].append((role or "", text or ""))
    return dict(found)


def rebuilt(rows):
    given = ordered(rows)
    out = {}
    for c, turns in given.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = given.get(c - c % 100, [])[:h] + turns[h:]
    return out


def corpus(seed):
    draw = random.Random(seed)
    words = ["hi", "", "yes é", "no 😀", "a longer reply", None]
    rows = []
    for c in [*range(0, 12), *range(95, 112), 200, 207, 1003, 5000, 5001]:
        for turn in range(draw.choice([1, 2, 3, 5, 9])):
            rows.append((c, turn if turn else draw.choice([0, None]), draw.choice(["user", "bot", None]),
                         draw.choice(words)))
    return rows + [(c, 0, "user", "alone") for c in range(3101, 3113)]  # no conversation 3100


@pytest.mark.parametrize("seed", [1, 2])
def test_rebuilt_conversations(spark, seed):
    rows = corpus(seed)
    frame = spark.createDataFrame(rows + [(None, 0, "user", "no conversation")], SCHEMA).repartition(4)
    found = pt.prefix_trie(*pt.rebuilt(frame)).select(COLUMNS)
    sequences = rebuilt(rows)
    assert any(not turns for turns in sequences.values())
    assert sorted(map(tuple, found.collect()), key=repr) == plain_trie(sequences)


def trie_of(spark, sequences):
    rows = [(c, n, *turn) for c, turns in sequences.items() for n, turn in enumerate(turns)]
    turns = pt.numbered_turns(spark.createDataFrame(rows, SCHEMA).repartition(5))
    members = spark.createDataFrame([(c,) for c in sequences], "conv_id long")
    return sorted(map(tuple, pt.prefix_trie(turns, members).select(COLUMNS).collect()), key=repr)


def test_long_conversations_span_blocks(spark):
    draw = random.Random(3)
    base = [("u", draw.choice("ab")) for _ in range(900)]
    sequences = {1: base, 2: base[:255], 3: base[:256], 4: base[:257], 5: base[:512] + [("x", "other")] * 3,
                 6: base[:700] + [("x", "y")] * 80, 7: [], 8: base[:512], 9: base, 10: base[:1], 11: base[:1023]}
    assert trie_of(spark, sequences) == plain_trie(sequences)


def test_copies_and_ties(spark):
    sequences = {c: [("u", "same"), ("b", "reply" if c % 3 else "other")] for c in range(500)}
    assert trie_of(spark, sequences) == plain_trie(sequences)
    # two turns of one number, and repeated rows, are turns of their own in a fixed order
    rows = [(1, 1, "u", "b"), (1, 1, "u", "a"), (2, 1, "u", "a"), (2, 1, "u", "b"), (3, 1, "u", "a"), (3, 1, "u", "a")]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    places = {(r.conv_id, r.place, bytes(r.digest)) for r in pt.numbered_turns(frame).collect()}
    assert {p[1:] for p in places if p[0] == 1} == {p[1:] for p in places if p[0] == 2}
    assert len({p for p in places if p[0] == 3}) == 2


def test_ends_of_many_members_are_hashed_in_runs(spark):
    ids = random.Random(1).sample(range(-10**12, 10**12), 20000)
    rows = [(7, 7, i) for i in ids] + [(7, 8, 3), (9, 1, 10), (9, 1, 9)]
    frame = spark.createDataFrame(rows, "a long, b long, conv_id long").repartition(6)
    found = {(r.a, r.b): r.ends_sha256 for r in pt.ends_hashes(frame).collect()}
    text = lambda values: hashlib.sha256(",".join(map(str, sorted(values))).encode()).hexdigest()
    assert found == {(7, 7): text(ids), (7, 8): text([3]), (9, 1): text([9, 10])}


def test_empty_table_and_other_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert pt.prefix_trie(*pt.rebuilt(empty)).count() == 0
    extra = spark.createDataFrame(
        [(1, 0, "u", "t" * 100_000, 5, "x", "y")],
        SCHEMA + ", place long, digest string, a string")
    assert pt.prefix_trie(*pt.rebuilt(extra)).count() == len(plain_trie(rebuilt([(1, 0, "u", "t")])))
