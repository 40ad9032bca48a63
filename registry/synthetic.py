"""Synthetic columns, drawn from the keys of a given table.

The values are random, so the registered results are their properties over all rows: shares
within a tolerance and numbers of violations, next to the number of rows drawn.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ratesmith.functions import templates as tp
from ratesmith.functions.synth import Draws
from ratesmith.operators import generate
from registry.catalogue import register
from registry.views import Tables

_KEYS = "SELECT l_orderkey * 1000003 + l_partkey * 11 + l_linenumber AS row_key, l_linenumber FROM {lineitem}"
_ROWS = "(SELECT COUNT(*) AS n FROM {lineitem}) k"


def _shares(rows: DataFrame, weights: dict) -> DataFrame:
    """Per value: all rows drawn, and whether its share is near its weight."""
    total = sum(weights.values())
    counts = rows.agg(
        F.count("*").alias("rows_drawn"),
        *[F.count_if(F.col("value") == value).alias(f"n_{i}") for i, value in enumerate(weights)],
    )
    cells = F.inline(F.array(*[
        F.struct(
            F.lit(str(value)).alias("value"),
            (F.abs(F.col(f"n_{i}") / F.col("rows_drawn") - weight / total) < 0.02).alias("near"),
        )
        for i, (value, weight) in enumerate(weights.items())
    ]))
    return counts.select("rows_drawn", cells)


@register(f"SELECT v.value, TRUE AS near, n AS rows_drawn FROM (VALUES ('a'), ('b'), ('c')) v(value), {_ROWS}")
def gen_weighted(t: Tables) -> DataFrame:
    weights = {"a": 0.6, "b": 0.3, "c": 0.1}
    rows = t.sql(_KEYS).select(Draws("row_key", seed=1).weighted(weights).alias("value"))
    return _shares(rows, weights)


@register(f"SELECT v.value, TRUE AS near, n AS rows_drawn FROM (VALUES ('1'), ('2'), ('3'), ('4')) v(value), {_ROWS}")
def gen_uniform(t: Tables) -> DataFrame:
    rows = t.sql(_KEYS).select(Draws("row_key", seed=2).choice([1, 2, 3, 4]).alias("value"))
    return _shares(rows, dict.fromkeys([1, 2, 3, 4], 1))


@register(f"""
SELECT n AS rows_drawn, CAST(0 AS BIGINT) AS outside, CAST(0 AS BIGINT) AS outside_columns, 5 AS lowest, 14 AS highest FROM {_ROWS}""")
def gen_randint(t: Tables) -> DataFrame:
    """Whole numbers between constants, and between a column and twice that column."""
    draws = Draws("row_key", seed=3)
    rows = t.sql(_KEYS).select(
        "l_linenumber",
        draws.integer(5, 14).alias("fixed"),
        draws.integer("l_linenumber", F.col("l_linenumber") * 2).alias("bounded"),
    )
    inside = F.col("bounded").between(F.col("l_linenumber"), F.col("l_linenumber") * 2)
    return rows.agg(
        F.count("*").alias("rows_drawn"),
        F.count_if(~F.col("fixed").between(5, 14)).alias("outside"),
        F.count_if(~inside).alias("outside_columns"),
        F.min("fixed").alias("lowest"),
        F.max("fixed").alias("highest"),
    )


@register(f"""
SELECT n AS rows_drawn, CAST(0 AS BIGINT) AS changed_content, TRUE AS first_is_uniform FROM {_ROWS}""")
def gen_shuffle(t: Tables) -> DataFrame:
    """Shuffled arrays keep their elements, and every element comes first equally often."""
    ordered = F.sequence(F.lit(1), F.lit(5))
    shuffled = t.sql(_KEYS).select(Draws("row_key", seed=4).shuffle(ordered).alias("items"))
    first = [F.count_if(F.col("items")[0] == i) / F.count("*") for i in range(1, 6)]
    return shuffled.agg(
        F.count("*").alias("rows_drawn"),
        F.count_if(F.array_sort("items") != ordered).alias("changed_content"),
        reduce(lambda a, c: a & c, [F.abs(s - 0.2) < 0.02 for s in first]).alias("first_is_uniform"),
    )


def _violations(keys: DataFrame, drawn: dict[str, tuple[Column, Callable[[Column], Column]]]) -> DataFrame:
    """Per property: all rows drawn and the rows that lack it; the keys are read once.

    `drawn` holds a column and the test of its values, given as a function of the column.
    """
    values = keys.select(*(column.alias(f"value_{i}") for i, (column, _) in enumerate(drawn.values())))
    counts = values.agg(
        F.count("*").alias("rows_drawn"),
        *(F.count_if(~F.coalesce(holds(F.col(f"value_{i}")), F.lit(False))).alias(f"v_{i}")
          for i, (_, holds) in enumerate(drawn.values())),
    )
    cells = F.inline(F.array(*[
        F.struct(F.lit(name).alias("property"), F.col(f"v_{i}").alias("violations"))
        for i, name in enumerate(drawn)
    ]))
    return counts.select("rows_drawn", cells)


def _property_check(names: list[str]) -> str:
    listed = ", ".join(f"('{name}')" for name in names)
    return f"SELECT p.property, CAST(0 AS BIGINT) AS violations, n AS rows_drawn FROM (VALUES {listed}) p(property), {_ROWS}"


_STRINGS = [
    "exact length", "length range", "default length", "custom alphabet", "list alphabet",
    "include", "include within length", "exclude", "digits", "letters", "nondigits",
    "unambiguous", "urlsafe", "postalsafe", "long", "length bounds",
]


@register(_property_check(_STRINGS))
def gen_string_props(t: Tables) -> DataFrame:
    draws = Draws("row_key", seed=5, vowels="AEIOU")
    def like(pattern: str) -> Callable[[Column], Column]:
        return lambda value: value.rlike(pattern)

    drawn = [
        (draws.text("A", 5), like("^A{5}$")),
        (draws.text("A", 11, 20), like("^A{11,20}$")),
        (draws.text("AA"), like("^A{1,10}$")),
        (draws.text("vowels"), like("^[AEIOU]{1,10}$")),
        (draws.text(["A", "A"]), like("^A{1,10}$")),
        (draws.text("ABC", include="@"), like("^[ABC]*@[ABC]*$")),
        (draws.text("ABC", 5, include="@"), lambda value: value.rlike("^[ABC@]{5}$") & value.contains("@")),
        (draws.text("ABC", exclude="C"), like("^[AB]{1,10}$")),
        (draws.text("digits"), like("^\\d{1,10}$")),
        (draws.text("letters"), like("^[a-zA-Z]{1,10}$")),
        (draws.text("nondigits"), like("^\\D{1,10}$")),
        (draws.text("unambiguous"), like("^[a-km-zA-HJ-NP-Z2-9]{1,10}$")),
        (draws.text("urlsafe"), like("^[a-zA-Z0-9._~-]{1,10}$")),
        (draws.text("postalsafe"), like("^[a-zA-Z0-9 .#/-]{1,10}$")),
        (draws.text("letters", 1, 200), like("^[a-zA-Z]{1,200}$")),
        (draws.text("printable", 3, 4), lambda value: F.length(value).between(3, 4)),
    ]
    return _violations(t.sql(_KEYS), dict(zip(_STRINGS, drawn)))


TEMPLATES = {
    "literal": tp.text("foo"),
    "dot": tp.repeat(tp.any_character(), 1, 8),
    "digit": tp.digit(),
    "non-digit": tp.non_digit(),
    "word": tp.word(),
    "non-word": tp.non_word(),
    "repeat": tp.repeat(tp.text("A"), 3, 3),
    "range repeat": tp.repeat(tp.text("A"), 2, 5),
    "either": tp.either(tp.text("foo"), tp.text("bar")),
    "span": tp.span("A", "F"),
    "class": tp.any_of("ABC"),
    "negated class": tp.none_of("AEIOU"),
    "anchors": tp.at_start() + tp.text("foo") + tp.at_end(),
    "look-ahead": tp.text("foo") + tp.followed_by(tp.text("bar")),
    "look-behind": tp.preceded_by(tp.text("foo")) + tp.text("bar"),
    "negative look-ahead": tp.text("foo") + tp.not_followed_by(tp.text("bar")),
    "back-reference": tp.group("w", tp.either(tp.text("foo"), tp.text("bar")))
    + tp.text("baz") + tp.back("w"),
    "lazy repeat": tp.repeat(tp.text("a"), 0, 10, lazy=True),
    "open repeat": tp.repeat(tp.digit(), 2, longest=30),
    "group in a repeat": tp.repeat(tp.group("d", tp.digit()) + tp.back("d"), 1, 3) + tp.text("-") + tp.back("d"),
    "nested": tp.repeat(tp.either(tp.digit(), tp.span("x", "z") + tp.text("-")), 1, 4),
}
UNANCHORED = {"look-ahead", "look-behind"}


@register(_property_check(list(TEMPLATES)))
def gen_pattern_props(t: Tables) -> DataFrame:
    """Values drawn from templates, matched as a whole against the template's own pattern."""
    draws = Draws("row_key", seed=6)
    drawn = {}
    for name, template in TEMPLATES.items():
        whole = template.pattern if name in UNANCHORED else f"\\A(?:{template.pattern})\\z"
        drawn[name] = (template.column(draws), lambda value, whole=whole: value.rlike(whole))
    return _violations(t.sql(_KEYS), drawn)


_EPISODES = [
    "unique key kept", "practice", "admission date", "age", "sex", "code form", "short code",
    "first code listed", "birth month", "procedure form",
]


@register(_property_check(_EPISODES))
def gen_episodes(t: Tables) -> DataFrame:
    """One synthetic episode per given row, with the properties of an episode table."""
    keys = t.sql(_KEYS)
    rows = generate.synthetic_episodes(keys, "row_key", practices=100, seed=7)
    col = F.col
    conditions = [
        col("EPIKEY").isNotNull(),
        col("GPPRAC").cast("int").between(1, 100),
        col("ADMIDATE").between(F.lit("1999-04-01").cast("date"), F.lit("2001-03-31").cast("date")),
        col("STARTAGE").between(0, 110),
        col("SEX").isin("1", "2", "9"),
        col("DIAG_4_01").rlike("^[EGHIJLNORX]\\d{3}$"),
        col("DIAG_3_01") == F.substring("DIAG_4_01", 1, 3),
        F.startswith("DIAG_4_CONCAT", F.concat("DIAG_4_01", F.lit(","))),
        col("MYDOB").rlike("^(0[1-9]|1[0-2])\\d{4}$"),
        col("OPERTN_3_01").isNull() | col("OPERTN_3_01").rlike("^[AKSXZ]\\d{2}$"),
    ]
    counts = rows.agg(
        F.count("*").alias("rows_drawn"),
        *[F.count_if(~F.coalesce(ok, F.lit(False))).alias(f"v_{i}")
          for i, ok in enumerate(conditions)],
    )
    cells = F.inline(F.array(*[
        F.struct(F.lit(name).alias("property"), F.col(f"v_{i}").alias("violations"))
        for i, name in enumerate(_EPISODES)
    ]))
    return counts.select("rows_drawn", cells)
