from datetime import date

import pytest
from pyspark.sql import functions as F

from ratesmith.operators import quality

M = [date(2000, 4, 30), date(2000, 5, 31), date(2000, 6, 30)]


def table(spark, *data):
    return spark.createDataFrame(
        data, "ORG_ID string, ACHIEVEMENT_DATE date, ATTRIBUTE_IDENTIFIER string, "
        "ATTRIBUTE_VALUE string")


def test_month_totals_must_rise_except_in_april(spark, rows):
    data = table(
        spark, ("A", date(2000, 3, 31), "x", "90"), ("A", M[0], "x", "10"), ("A", M[1], "x", "20"),
        ("A", M[2], "x", "20"), ("A", M[2], "y", "5"))
    trend = quality.month_total(data, "x")
    found = {r.ACHIEVEMENT_DATE: r for r in trend.collect()}
    assert found[M[0]].perc_change < 0 and not found[M[0]].breach
    assert found[M[1]].perc_change == pytest.approx(100.0)
    assert found[date(2000, 3, 31)].perc_change == 0 and found[date(2000, 3, 31)].breach
    assert rows(quality.breaches(trend), "ACHIEVEMENT_DATE") == [(date(2000, 3, 31),), (M[2],)]


def test_change_after_a_month_of_zero(spark):
    data = table(spark, ("A", M[0], "x", "0"), ("A", M[1], "x", "5"))
    month = {r.ACHIEVEMENT_DATE: r for r in quality.month_total(data, "x").collect()}
    assert month[M[1]].perc_change is None and not month[M[1]].breach
    org = {r.ACHIEVEMENT_DATE: r for r in quality.organisation_total(data, "x").collect()}
    assert org[M[1]].perc_change == 0


def test_organisation_totals(spark, rows):
    data = table(
        spark, ("A", M[0], "x", "10"), ("A", M[1], "x", "8"), ("B", M[0], "x", "5"), ("B", M[1], "x", "5"),
        ("A", M[0], "pop", "100"), ("A", M[1], "pop", "105"), ("B", M[0], "pop", "10"),
        ("B", M[1], "pop", "20"))
    trend = quality.organisation_total(data, "x")
    assert rows(quality.breaches(trend), "ORG_ID") == [("A",)]
    both = quality.organisation_total_with_population(data, "x", "pop")
    assert rows(quality.breaches(both), "ORG_ID", "pop_perc_change") == [("A", 5.0)]
    assert quality.breaches(
        quality.organisation_total_with_population(data, "x", "pop", 6.0)).isEmpty()


def test_only_the_latest_organisation_count_matters(spark, rows):
    early = [(str(i), M[0], "x", "1") for i in range(10)] + [("1", M[1], "x", "1")]
    trend = quality.organisation_count(table(spark, *early))
    assert rows(quality.breaches(trend), "ACHIEVEMENT_DATE", "perc_change") == [(M[1], -90.0)]
    steady = early + [("1", M[2], "x", "1")]
    assert quality.breaches(quality.organisation_count(table(spark, *steady))).isEmpty()


def test_shares_and_counts(spark, rows):
    data = table(
        spark, ("A", M[0], "n", "11"), ("A", M[0], "d", "10"), ("B", M[0], "n", "5"),
        ("C", M[0], "n", "*"), ("C", M[0], "d", "0"))
    share = quality.numerator_share(data, "n", "d")
    assert rows(quality.breaches(share), "ORG_ID", "perc_of_denominator") == [("A", pytest.approx(110))]
    assert share.count() == 3
    assert rows(quality.breaches(quality.attribute_count(data, 2)), "ORG_ID") == [("B",)]
    summary = quality.summary({"a": quality.breaches(share), "b": data.limit(0)})
    assert rows(summary) == [("a", 1, False), ("b", 0, True)]


def test_repeated_practices(spark, rows):
    mapping = spark.createDataFrame([("A", "1"), ("A", "2"), ("B", "1")], "PRACTICE_CODE string, PCN_CODE string")
    assert rows(quality.repeated_practices(mapping)) == [("A", 2)]


def test_sketches_count_like_the_rows(spark, rows):
    early = [(str(i), M[0], "x", "1") for i in range(500)] + [(str(i), M[1], "x", "1") for i in range(250, 900)]
    data = table(spark, *early, ("a", None, "x", "1"))
    sketches = quality.organisation_sketches(data)
    exact = {r.ACHIEVEMENT_DATE: r.TOTAL_PRAC_COUNT for r in quality.organisation_count(data).collect()}
    for row in quality.organisation_count_from(sketches).collect():
        assert row.TOTAL_PRAC_COUNT == pytest.approx(exact[row.ACHIEVEMENT_DATE], rel=0.05)
    assert quality.all_organisations(sketches).first()[0] == pytest.approx(901, rel=0.05)
    fresh = quality.organisation_sketches(table(spark, ("z", M[1], "x", "1"), ("b", None, "x", "1"), ("c", None, "x", "1")))
    merged = quality.replace_sketches(sketches, fresh)
    counts = {r.ACHIEVEMENT_DATE: r.TOTAL_PRAC_COUNT for r in quality.organisation_count_from(merged).collect()}
    assert counts[M[1]] == 1 and counts[None] == 2 and counts[M[0]] == pytest.approx(500, rel=0.05)


def test_stored_sketches_follow_a_publication(spark, tmp_path):
    from ratesmith.plans.store import Store

    store = Store(spark, str(tmp_path))
    first = table(spark, *[(str(i), month, "x", "1") for i in range(50) for month in M[:2]]).withColumn(
        "DATA_REFERENCE_IDENTIFIER", F.lit("r"))
    store.publish("p", first)
    store.sketch("p", first)
    late = table(spark, *[(f"late{i}", M[1], "x", "1") for i in range(7)], ("A", M[2], "x", "1")).withColumn(
        "DATA_REFERENCE_IDENTIFIER", F.lit("r"))
    store.publish("p", late)
    found = quality.organisation_count_from(store.sketch("p", late))
    assert {r.ACHIEVEMENT_DATE: r.TOTAL_PRAC_COUNT for r in found.collect()} == {M[0]: 50, M[1]: 57, M[2]: 1}
