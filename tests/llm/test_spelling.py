"""Spelling variants against all pairs of words."""

import random
import zlib
from collections import Counter

import pytest

from ratesmith.llm import spelling

LETTERS = "abcdeé"


def is_near(one, two):
    if len(one) > len(two):
        one, two = two, one
    if len(two) - len(one) > 1 or one == two:
        return False
    if len(one) == len(two):
        return sum(a != b for a, b in zip(one, two)) == 1
    return any(two[:k] + two[k + 1:] == one for k in range(len(two)))


def plain(words, ratio=2):
    near = {w: [v for v in words if is_near(w, v)] for w in words}
    forms = {}
    for word, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        forms[word] = best if best is not None and words[best] >= ratio * words[word] else None
    rows = []
    for word, n in words.items():
        root = word
        while forms[root]:
            root = forms[root]
        rows.append((word, n, len(near[word]), forms[word], words.get(forms[word]), root))
    return sorted(rows)


def grouped(spark, words, **options):
    frame = spark.createDataFrame(list(words.items()), "word string, n long").repartition(4)
    return sorted(map(tuple, spelling.variant_groups(frame, **options).collect()))


@pytest.mark.parametrize("group_words", [2, spelling.GROUP_WORDS])
def test_near_words(spark, group_words):
    draw = random.Random(13)
    words = {}
    for _ in range(120):
        base = "".join(draw.choices(LETTERS, k=draw.choice([1, 2, 3, 5, 6, 8, 13])))
        for _ in range(draw.choice([1, 4])):
            at, kind = draw.randrange(len(base) + 1), draw.choice("idr")
            new = base[:at] + draw.choice(LETTERS) * (kind != "d") + base[at + (kind != "i"):]
            words[new] = draw.choice([1, 3, 7, 20, 50, 400])
        words[base] = draw.choice([3, 30, 300])
    words.pop("", None)
    assert grouped(spark, words, group_words=group_words) == plain(words)


def test_one_chunk_shared_by_all_words(spark):
    draw = random.Random(14)
    words = {"prefix" + "".join(draw.choices("abcd", k=6)): draw.randint(1, 900) for _ in range(700)}
    words |= {"a" * k: 1 << k for k in range(5, 25)}  # every word near the next, a chain of forms
    found = grouped(spark, words)
    assert found == plain(words)
    assert {row[5] for row in found if row[0].strip("a") == ""} == {"a" * 24}


def counted(texts):
    total = Counter()
    for doc_id, text in texts:
        word = ""
        runs = []
        for ch in (text or "") + " ":
            if ch.isascii() and ch.isalpha() or "À" <= ch <= "ÿ":
                word += ch.lower() if ch.isascii() else ch
            elif word:
                runs.append(word)
                word = ""
        for run in runs:
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 7 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def test_words_of_whole_texts(spark):
    odd = [(1, None), (2, ""), (3, "ÀÉÎ÷×straße Straße STRASSE naïve\tnaïve"), (None, "Wörter Wörter Wörter"),
           (4, "abcde1abcde_abcde-ABCDE 中文words words😀words words ſhort"), (5, "letter" * 60_000),
           (6, "word another " * 120_000), (6, "word another"), (2**40, "x" * 5 + " " + "xxxxx xxxxx")]
    frame = spark.createDataFrame(odd, "doc_id long, text string")
    found = {r.word: r.n for r in spelling.word_counts(frame, shorten_every=7).collect()}
    assert found == counted(odd)


def test_slices_cut_no_word(monkeypatch):
    monkeypatch.setattr(spelling, "SLICE", 10)
    text = "one seven letters " + "z" * 50 + " end"
    assert [w for part in spelling.words_of(text) for w in part] == [w.encode() for w in text.split()]


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    words = {r.word: r.n for r in spelling.word_counts(docs).collect()}
    frame = spelling.word_counts(docs)
    assert sorted(map(tuple, spelling.variant_groups(frame).collect())) == plain(words)


def test_empty_tables_and_other_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variant_groups(spelling.word_counts(empty)).count() == 0
    extra = spark.createDataFrame([(1, "hello hello hello", "x", 1)], "doc_id long, text string, word string, n long")
    assert spelling.variant_groups(spelling.word_counts(extra)).collect()[0].root == "hello"
