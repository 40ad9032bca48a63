from datetime import date

import pytest
from pyspark.sql import functions as F

from ratesmith.functions.bands import age_key_names
from ratesmith.functions.period import ReportingPeriod
from ratesmith.operators import population, reshape, standardise

MAPPING = "PRACTICE_CODE string, PCN_CODE string, PCN_NAME string"
COHORT = (
    "GPPRAC string, EPIKEY bigint, STARTAGE string, SEX string, FAE_EMERGENCY int, "
    "RP_month_start date, RPSD date"
)
DAY = date(2000, 12, 1)


def cohort_of(spark, *cases):
    data = [(*case, DAY, date(2000, 4, 1)) for case in cases]
    return spark.createDataFrame(data, COHORT)


def counts(spark, data, value):
    return spark.createDataFrame(data, f"unit string, stratum string, {value} bigint")


def rates(spark, units, events, people, standard):
    found = standardise.standardise_counts(
        spark.createDataFrame([(u,) for u in units], "unit string"),
        counts(spark, events, "events"), counts(spark, people, "population"),
        spark.createDataFrame(standard, "stratum string, standard bigint"), "unit", "stratum")
    return {r.unit: r for r in found.collect()}


def test_unpivot(spark, rows):
    wide = spark.createDataFrame(
        [("A1111", 2, 4), ("A2222", 1, 7)], "Practice_code string, Males_0_to_10 int, Males_11_to_20 int")
    assert rows(reshape.unpivot_counts(wide, ["Practice_code"])) == [
        ("A1111", "Males_0_to_10", 2), ("A1111", "Males_11_to_20", 4),
        ("A2222", "Males_0_to_10", 1), ("A2222", "Males_11_to_20", 7)]
    with pytest.raises(ValueError):
        reshape.unpivot_counts(wide.withColumn("x", F.lit("text")), ["Practice_code"])


def wide_table(spark, data):
    """(practice, date, {column: count}) as a wide table; absent columns are NULL."""
    names = age_key_names() + ["OTHER"]
    schema = "PRACTICE_CODE string, EXTRACT_DATE date, " + ", ".join(f"{n} bigint" for n in names)
    return spark.createDataFrame(
        [(p, d, *[cells.get(n) for n in names]) for p, d, cells in data], schema)


def test_folding_equals_summing_the_long_table(spark, rows):
    wide = wide_table(spark, [
        ("A", DAY, {"MALE_0_1": 1, "MALE_4_5": 2, "MALE_5_6": 4, "FEMALE_95_96": 8,
                    "FEMALE_119_120": 16, "OTHER": 32}),
        ("B", DAY, {"MALE_0_1": 64, "FEMALE_3_4": None}),
        ("C", date(2000, 4, 1), {"MALE_0_1": 128}),
    ])
    folded = reshape.totals_by_band(wide, population.IDS, ["EXTRACT_DATE"], "band", "n")
    long = reshape.unpivot_counts(wide, population.IDS)
    bands = {name: reshape.five_year_band(name) for name in age_key_names()}
    lookup = spark.createDataFrame(list(bands.items()), "key string, band string")
    summed = long.join(lookup, "key", "left").groupBy("EXTRACT_DATE", "band").agg(F.sum("val"))
    assert rows(folded) == rows(summed)
    found = {(r.EXTRACT_DATE, r.band): r.n for r in folded.collect()}
    assert found[DAY, "MALE_0_4"] == 67 and found[DAY, "FEMALE_95+"] == 24
    assert found[DAY, None] == 32 and found[DAY, "FEMALE_0_4"] is None


def test_national_population_counts_unmapped_practices(spark, rows):
    wide = wide_table(spark, [
        ("A", DAY, {"MALE_0_1": 10}), ("B", DAY, {"MALE_0_1": 5}), ("C", DAY, {"MALE_2_3": 1})])
    practices = spark.createDataFrame([("A", "N1", "one"), ("C", "N1", "one")], MAPPING)
    bands = population.network_bands(wide, practices, [DAY])
    sizes = population.list_size_from(bands, {DAY: "id"}).where("COUNT IS NOT NULL")
    assert rows(sizes, "PCN_CODE", "AGE_FIVE_YEAR", "COUNT", "Attribute_ID") == [
        ("N1", "MALE_0_4", 11, "id")]
    for standard in (population.standard_from(bands, DAY), population.standard_population(wide, DAY)):
        assert rows(standard.where("Count IS NOT NULL"), "AGE_FIVE_YEAR", "Count") == [
            ("MALE_0_4", 16)]
    with pytest.raises(ValueError):
        population.standard_population(wide, "2000-12-31")


def test_rate_by_hand(spark):
    found = rates(
        spark, ["N1", "N2", "N3"],
        [("N1", "young", 2), ("N1", "old", 3), ("N2", "old", 1), ("N1", None, 7)],
        [("N1", "young", 100), ("N1", "old", 50), ("N2", "young", 10), ("N2", "old", 20),
         ("not listed", "old", 5)],
        [("young", 1000), ("old", 500)])
    expected = 2 * 1000 / 100 + 3 * 500 / 50
    assert found["N1"].expected == pytest.approx(expected)
    assert found["N1"].rate == pytest.approx(expected / 1500)
    # events without a stratum count as events but not in the rate
    assert found["N1"].events == 12 and found["N1"].population == 150
    assert found["N2"].rate == pytest.approx(25 / 1500)
    assert set(found) == {"N1", "N2", "N3"}
    # a unit without population has neither rate nor standard, but it stays
    assert found["N3"].events == 0
    assert found["N3"].rate is None and found["N3"].standard_total is None


def test_strata_that_cannot_be_weighted_are_counted(spark):
    found = rates(
        spark, ["N1"], [("N1", "empty", 4), ("N1", "unknown", 4), ("N1", "old", 1)],
        [("N1", "empty", 0), ("N1", "unknown", 10), ("N1", "old", 10)],
        [("old", 100), ("empty", 100)])["N1"]
    assert found.expected == pytest.approx(10.0) and found.strata_skipped == 2


def test_same_age_mix_gives_the_crude_rate(spark):
    mix = {"a": 500, "b": 300, "c": 200}
    people = [(u, s, n * k) for u, k in (("N1", 1), ("N2", 3)) for s, n in mix.items()]
    events = [("N1", "a", 5), ("N1", "b", 9), ("N2", "a", 2), ("N2", "c", 4)]
    found = rates(spark, ["N1", "N2"], events, people, list(mix.items()))
    for row in found.values():
        assert row.rate == pytest.approx(row.events / row.population)


def test_published_rates_to_five_digits(spark):
    """Rates calculated by hand from the national population and the weighted sum."""
    for unit, weighted, rate in (("U78157", 1400783.897, 0.02306), ("U26379", 1240751.946, 0.02043)):
        # one stratum whose weight reproduces the weighted sum
        found = rates(spark, [unit], [(unit, "s", 1)], [(unit, "s", 1000)], [
            ("s", round(weighted * 1000)), ("rest", 60744002 * 1000 - round(weighted * 1000))])
        assert round(found[unit].rate * 1000, 5) == rate


def test_cases_collapse_only_if_all_fields_agree(spark, rows):
    practices = spark.createDataFrame([("A", "N1", "one"), ("B", "N1", "one"), ("C", "N2", "two")], MAPPING)
    cases = cohort_of(
        spark, ("A", 1, "7", "MALE", 1), ("A", 1, "7", "MALE", 1), ("A", 1, "8", "MALE", 1),
        ("A", 2, "95+", "FEMALE", 0), ("B", 1, "7", "MALE", 1), ("X", 9, "7", "MALE", 1),
        (None, 10, "7", "MALE", 1))
    cells = standardise.admission_cells(cases, practices)
    assert rows(cells) == [("N1", "FEMALE_95+", 0), ("N1", "MALE_5_9", 3)]
    by_band = standardise.admissions_by_band(cases, practices)
    assert by_band.count() == 80
    assert rows(by_band.where("admissions > 0")) == [("N1", "MALE_5_9", 3)]
    assert rows(standardise.admissions_by_network(cases, practices)) == [("N1", 3), ("N2", 0)]
    listed = standardise.cases_by_network(cases, practices)
    assert rows(listed, "PRACTICE_CODE", "EPIKEY", "AGE", "PCN_CODE") == [
        ("A", 1, "7", "N1"), ("A", 1, "8", "N1"), ("A", 2, "95+", "N1"), ("B", 1, "7", "N1"),
        (None, None, None, "N2")]


def test_dense_grid(spark):
    practices = spark.createDataFrame([("A", "N1", "one"), ("B", "N1", "one")], MAPPING)
    grid = standardise.dense_grid(practices)
    assert grid.count() == 2 * 192
    assert grid.select("AGE_FIVE_YEAR").distinct().count() == 40
    assert grid.where("AGE = '95+'").count() == 4


def test_percentage_change_without_admissions(spark):
    practices = spark.createDataFrame([("A", "N1", "one")], MAPPING)
    period = ReportingPeriod.parse("2000-12-31")
    wide = wide_table(spark, [("A", DAY, {"MALE_7_8": 10}), ("A", date(2000, 4, 1), {"MALE_7_8": 10})])
    bands = population.network_bands(wide, practices, [DAY, period.start])
    found = standardise.standardised_numerator(
        cohort_of(spark, ("A", 1, "7", "MALE", 0)), practices,
        population.list_size_from(bands, {DAY: ""}), population.standard_from(bands, period.start),
        "id").first()
    assert found.admissions == 0 and found.standardised_admissions == 0
    assert found.percentage_change is None
