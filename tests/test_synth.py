import re

import pytest
from pyspark.sql import functions as F

from ratesmith.functions import templates as tp
from ratesmith.functions.synth import ALPHABETS, Draws


def test_draws_depend_on_key_and_seed_only(spark, rows):
    keys = spark.range(1000)

    def drawn(partitions, seed):
        draws = Draws("id", seed=seed)
        return keys.repartition(partitions).select(
            "id", draws.integer(1, 10**6).alias("n"), draws.text("letters", 3, 9).alias("t"))

    assert rows(drawn(1, 5)) == rows(drawn(7, 5))
    assert rows(drawn(1, 5)) != rows(drawn(1, 6))


def test_draws_of_one_row_are_independent(spark):
    draws = Draws("id")
    both = spark.range(20000).select(
        draws.choice([0, 1]).alias("a"), draws.choice([0, 1]).alias("b"))
    agree = both.where("a = b").count() / 20000
    assert abs(agree - 0.5) < 0.02


def test_weights_and_bounds(spark):
    draws = Draws("id")
    table = spark.range(20000).select(
        draws.weighted({"x": 8, "y": 1, "z": 1}).alias("w"), draws.weighted({7: 1}).alias("only"),
        draws.integer(0, 0).alias("zero"), draws.uniform().alias("u"))
    shares = {r.w: r["count"] / 20000 for r in table.groupBy("w").count().collect()}
    assert shares == {"x": pytest.approx(0.8, abs=0.02), "y": pytest.approx(0.1, abs=0.02),
                      "z": pytest.approx(0.1, abs=0.02)}
    row = table.agg(F.max("zero"), F.min("only"), F.min("u"), F.max("u"), F.avg("u")).first()
    assert row[0] == 0 and row[1] == 7 and 0 <= row[2] and row[3] < 1
    assert row[4] == pytest.approx(0.5, abs=0.02)


def test_included_characters_move(spark):
    places = spark.range(3000).select(
        F.instr(Draws("id").text("A", 4, include="@"), "@").alias("p")).groupBy("p").count()
    assert {r.p for r in places.collect()} == {1, 2, 3, 4}
    lengths = spark.range(3000).select(F.length(Draws("id").text("A", 1, 3, include="@")).alias("n"))
    assert {r.n for r in lengths.distinct().collect()} == {1, 2, 3}
    assert "@" not in ALPHABETS["word"]


def test_impossible_strings_are_refused():
    draws = Draws(F.lit(1))
    for bad in (dict(alphabet="A", exclude="A"), dict(alphabet="A", start=3, stop=2),
                dict(alphabet="A", start=1, include="xyz")):
        with pytest.raises(ValueError):
            draws.text(**bad)
    with pytest.raises(ValueError):
        tp.repeat(tp.digit(), 3, 2)


def test_custom_alphabets(spark):
    draws = Draws("id", vowels="AEIOU")
    draws.add_alphabet("evens", "02468")
    table = spark.range(500).select(draws.text("vowels").alias("v"), draws.text("evens").alias("e"))
    assert table.where("NOT v RLIKE '^[AEIOU]{1,10}$' OR NOT e RLIKE '^[02468]{1,10}$'").isEmpty()


def test_back_references_repeat_the_drawn_value(spark):
    template = tp.group("w", tp.repeat(tp.any_of("abc"), 1, 5)) + tp.text("-") + tp.back("w")
    table = spark.range(500).select(template.column(Draws("id")).alias("v"))
    halves = F.split("v", "-")
    assert table.where(halves[0] != halves[1]).isEmpty()
    assert table.select("v").distinct().count() > 50


def test_unbounded_repeat_reaches_its_limit(spark):
    lengths = spark.range(5000).select(
        F.length(tp.repeat(tp.text("a"), 0).column(Draws("id"))).alias("n"))
    row = lengths.agg(F.min("n"), F.max("n")).first()
    assert tuple(row) == (0, tp.UNBOUNDED_MAX)


def test_very_long_strings_are_one_expression(spark):
    long = Draws("id").text("letters", 1, 10_000)
    table = spark.range(300).select(long.alias("t"))
    row = table.agg(F.max(F.length("t")), F.min(F.length("t")), F.count_if(~F.col("t").rlike("^[a-zA-Z]+$"))).first()
    assert 9000 < row[0] <= 10_000 and 1 <= row[1] < 1500 and row[2] == 0
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 2000
    exact = spark.range(5).select(F.length(Draws("id").text("ab", 10_000, include="@#")).alias("n"))
    assert {r.n for r in exact.collect()} == {10_000}


def test_places_of_a_repeat_are_independent(spark):
    value = tp.repeat(tp.any_of("ab"), 12, 12).column(Draws("id"))
    assert spark.range(3000).select(value.alias("v")).distinct().count() > 1500


def test_open_repeats_take_their_longest_as_an_argument(spark):
    lengths = spark.range(3000).select(
        F.length(tp.repeat(tp.text("a"), 2, longest=7).column(Draws("id"))).alias("n"))
    assert {r.n for r in lengths.distinct().collect()} == set(range(2, 8))


def test_groups_inside_a_repeat(spark):
    part = tp.group("d", tp.digit()) + tp.text("=") + tp.back("d")
    template = tp.repeat(part + tp.text(";"), 1, 4) + tp.back("d")
    table = spark.range(400).select(template.column(Draws("id")).alias("v"))
    assert table.where(~F.col("v").rlike(f"^{template.pattern}$")).isEmpty()
    assert table.where("v RLIKE '^(.=.;){3}.$'").count() > 50


def test_short_texts_are_drawn_without_a_lambda_per_character(spark):
    """A lambda costs each character most of a microsecond; it may only stand where it never runs."""
    for options in (dict(), dict(include="@#", start=4, stop=9), dict(start=1, stop=200)):
        text = Draws("id").text("letters", **options)
        plan = spark.range(5).select(text.alias("t"))._jdf.queryExecution().optimizedPlan().toString()
        assert "xxhash64(xxhash64" in plan or re.search(r"xxhash64\(\(xxhash64", plan)
        before, guarded, _ = plan.partition("THEN array_join")
        assert guarded and "transform(" not in before and "sequence(" not in before


def test_many_texts_stay_out_of_whole_stage_code(spark):
    """One method for all of them would be too long for the JVM to compile."""
    draws = Draws("id")
    table = spark.range(50).select(*(draws.text("printable", 1, 60).alias(f"t{i}") for i in range(20)))
    project = [line for line in table._jdf.queryExecution().executedPlan().toString().split("\n") if "Project" in line]
    assert project and not any("*(" in line for line in project)


def test_characters_and_lengths_are_drawn_alike(spark, rows):
    def near(column, values):
        counts = {r[0]: r[1] for r in column.groupBy("c").count().collect()}
        total = sum(counts.values())
        assert set(counts) == set(values)
        assert all(abs(n / total * len(values) - 1) < 0.15 for n in counts.values())

    for alphabet in ("printable", "letters", "whitespace"):
        texts = spark.range(20000).select(Draws("id", seed=3).text(alphabet, 1, 20).alias("t"))
        near(texts.select(F.explode(F.split("t", "")).alias("c")), ALPHABETS[alphabet])
        near(texts.select(F.length("t").alias("c")), range(1, 21))
    # neighbours within a block of eight characters and across two blocks
    texts = spark.range(20000).select(Draws("id").text("abc", 20).alias("t"))
    for place in (1, 8, 9, 16):
        near(texts.select(F.substring("t", place, 2).alias("c")), [a + b for a in "abc" for b in "abc"])


def test_characters_given_twice_weigh_double(spark):
    texts = spark.range(20000).select(Draws("id").text("AAB", 1).alias("t"))
    assert abs(texts.where("t = 'A'").count() / 20000 - 2 / 3) < 0.02


def test_every_order_of_included_characters_is_as_likely(spark):
    texts = spark.range(12000).select(Draws("id").text("x", 4, include="ab").alias("t"))
    counts = {r.t: r["count"] for r in texts.groupBy("t").count().collect()}
    assert len(counts) == 12 and all(850 < n < 1150 for n in counts.values())
    # nothing but the included characters, and characters beyond ASCII
    only = spark.range(600).select(Draws("id").text("x", 3, include="a\u00e9\U0001f600").alias("t"))
    assert only.distinct().count() == 6


def test_texts_of_any_characters_and_lengths(spark):
    draws = Draws("id")
    table = spark.range(500).select(
        draws.text("a\u00e9\U0001f600", 3, 12).alias("wide"), draws.text(["ab", "cd"], 2).alias("pairs"),
        draws.text("x", 4, include=["yz"]).alias("included"), draws.text("\x00\t~", 1, 9).alias("control"),
        draws.text("letters", 256).alias("last"), draws.text("letters", 257).alias("longer"),
        draws.text("letters", 3, include="@#!").alias("full"))
    bad = table.where(
        (~F.col("wide").rlike("^[a\u00e9\U0001f600]{3,12}$")) | (~F.col("pairs").rlike("^(ab|cd){2}$"))
        | (F.length("included") != 5) | (~F.col("included").contains("yz"))
        | (~F.col("control").rlike(r"\A[\x00\t~]{1,9}\z"))
        | (F.length("last") != 256) | (F.length("longer") != 257)
        | (F.length("full") != 3) | (F.array_join(F.array_sort(F.split("full", "")), "") != "!#@"))
    assert bad.isEmpty()


def test_later_draws_do_not_depend_on_how_a_text_is_drawn():
    counts = set()
    for options in (dict(start=5), dict(start=300), dict(start=5, include="@#")):
        draws = Draws(F.lit(1))
        draws.text("letters", **options)
        counts.add((options.get("include", ""), draws.count))
    assert counts == {("", 2), ("@#", 3)}


def test_texts_of_null_and_repeated_keys(spark):
    table = spark.createDataFrame([(None,), (None,), (1,), (1,)], "k bigint").select(
        "k", Draws("k").text("letters", include="@").alias("t"))
    assert table.distinct().count() == 2 and table.where("t IS NULL OR NOT t LIKE '%@%'").isEmpty()
