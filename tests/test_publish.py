from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ratesmith import constants as c
from ratesmith.operators import publish, rollup
from ratesmith.sources import reference, sinks
from ratesmith.sources.workspace import new_path

LONG = (
    "ORG_ID string, ACHIEVEMENT_DATE date, DATA_REFERENCE_IDENTIFIER string, "
    "ATTRIBUTE_IDENTIFIER string, ATTRIBUTE_VALUE string, ATTRIBUTE_TYPE string, "
    "CREATED_AT timestamp"
)
D1, D2 = date(2000, 11, 30), date(2000, 12, 31)
T1, T2 = datetime(2000, 12, 5), datetime(2001, 1, 5)


def long_table(spark, *data, at=T1):
    return spark.createDataFrame(
        [(org, day, "ref", att, value, "int", at) for org, day, att, value in data], LONG)


def test_long_rows(spark, rows):
    table = spark.createDataFrame(
        [("N1", c.ADMISSIONS_NUMERATOR, 12345678.4), ("N1", c.ADMISSIONS_NUMERATOR, 0.2),
         ("N1", "unknown", 1.0), ("N2", c.ADMISSIONS_NUMERATOR, None)],
        "PCN_CODE string, ATTRIBUTE_ID string, v double")
    codes = reference.attribute_codes(reference.attribute_mapping(spark))
    found = publish.long_rows(table, "PCN_CODE", "2000-12-31", {}, "v", codes, T1)
    assert found.columns == publish.LONG_COLUMNS
    assert rows(found, "ORG_ID", "DATA_REFERENCE_IDENTIFIER", "ATTRIBUTE_VALUE") == [
        ("N1", c.ADMISSIONS_INDICATOR, "12345679"), ("N1", None, "1"),
        ("N2", c.ADMISSIONS_INDICATOR, None)]
    crude = publish.long_rows(table, "PCN_CODE", D2, c.CRUDE_IDS, "v", codes, T1)
    assert (c.ADMISSIONS_CRUDE,) in rows(crude, "ATTRIBUTE_IDENTIFIER")
    assert {r.CREATED_AT for r in crude.collect()} == {T1}


def test_lookup_does_not_repeat_rows(spark):
    codes = reference.attribute_codes(reference.attribute_mapping(spark))
    assert codes.count() == 10
    assert codes.where(F.col("ATTRIBUTE_IDENTIFIER") == c.ROUNDS_NUMERATOR).count() == 1


def test_activity_totals_fill_zeros(spark, rows):
    table = spark.createDataFrame(
        [("A", "Walk-in", "1 Day", 5), ("A", "Walk-in", "15 to 21 Days", 7),
         ("B", "Group Consultation", "1 Day", 9), ("C", "Walk-in", "1 Day", None),
         ("D", c.CARE_HOME_ROUND, "Same Day", 2)],
        "GP_Code string, National_Slot_Type string, Wait_Time string, Appointments bigint")
    found = rollup.activity_totals(table, rollup.appointment_measures(), "2000-12-31")
    values = {(r.ORG_ID, r.FRIENDLY_IDENTIFIER): r.ATTRIBUTE_VALUE for r in found.collect()}
    assert len(values) == 4 * 3
    assert values["A", c.WAITS_DENOMINATOR_LABEL] == "12"
    assert values["A", c.WAITS_NUMERATOR_LABEL] == "5"
    assert values["B", c.WAITS_NUMERATOR_LABEL] == "0"
    # matching rows without a count have an unknown total, not zero
    assert values["C", c.WAITS_NUMERATOR_LABEL] is None
    assert values["D", c.ROUNDS_NUMERATOR_LABEL] == "2"
    named = reference.with_attribute_ids(found, reference.attribute_mapping(spark))
    assert named.where(F.col("ATTRIBUTE_IDENTIFIER") == c.ATTRIBUTE_MISSING).isEmpty()


def test_zero_fill_keeps_text(spark, rows):
    totals = spark.createDataFrame([("A", "3"), ("B", None)], "k string, v string")
    universe = spark.createDataFrame([("A",), ("B",), ("C",)], "k string")
    filled = rollup.zero_fill(totals, universe, "k", "v")
    assert rows(filled, "k", "v") == [("A", "3"), ("B", None), ("C", "0")]
    assert rows(rollup.zero_fill(totals, universe.where("k = 'A'"), "k", "v")) == [("A", "3")]


def test_replace_by_key_is_idempotent(spark, rows):
    existing = long_table(
        spark, ("A", D1, "x", "1"), ("A", D2, "x", "2"), ("B", D2, "x", "3")).withColumn(
        "ACHIEVEMENT_DATE", F.col("ACHIEVEMENT_DATE").cast("string"))
    batch = long_table(spark, ("A", D2, "x", "9"), ("C", D2, "x", "4"), at=T2)
    once = publish.replace_by_key(existing, batch)
    expected = [("A", D1, "1"), ("A", D2, "9"), ("B", D2, "3"), ("C", D2, "4")]
    assert rows(once, "ORG_ID", "ACHIEVEMENT_DATE", "ATTRIBUTE_VALUE") == expected
    assert rows(publish.replace_by_key(once, batch)) == rows(once)


def test_published_update_touches_only_its_dates(spark, rows):
    target = new_path(spark, "test-published")
    sinks.start_published(
        long_table(spark, ("A", D1, "x", "1"), ("A", D2, "x", "2"), ("B", D2, "x", "3")), target)
    untouched = {path for path in spark.read.parquet(target).inputFiles() if str(D1) in path}
    batch = long_table(spark, ("A", D2, "x", "9"), at=T2)
    for _ in range(2):
        sinks.update_published(batch, target)
    sinks.update_published(batch.limit(0), target)
    found = sinks.read_published(spark, target)
    assert rows(found, "ORG_ID", "ACHIEVEMENT_DATE", "ATTRIBUTE_VALUE") == [
        ("A", D1, "1"), ("A", D2, "9"), ("B", D2, "3")]
    assert untouched and untouched <= set(found.inputFiles())


def test_archive_takes_newer_batches_only(spark, rows):
    target = new_path(spark, "test-archive")
    first, second = long_table(spark, ("A", D1, "x", "1")), long_table(spark, ("A", D2, "x", "2"), at=T2)
    assert not sinks.archive(first.limit(0), target)
    assert sinks.archive(first, target)
    assert not sinks.archive(first, target)
    assert sinks.archive(second, target)
    assert not sinks.archive(second.limit(0), target)
    archive = sinks.read_archive(spark, target)
    assert rows(publish.batch_sizes(archive)) == [(T1, 1), (T2, 1)]
    assert publish.append_if_newer(first.limit(0), second).count() == 1
    assert publish.append_if_newer(second, first).count() == 1


def test_only_a_missing_table_counts_as_absent(spark, tmp_path):
    assert not sinks.exists(spark, str(tmp_path / "nothing"))
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part.parquet").write_text("no table")
    with pytest.raises(Exception):
        sinks.exists(spark, str(tmp_path / "broken"))


def test_folders_get_few_files(spark):
    target = new_path(spark, "test-folders")
    data = [(str(i), day, "x", "1") for i in range(50) for day in (D1, D2)]
    sinks.start_published(long_table(spark, *data).repartition(8), target)
    assert len(spark.read.parquet(target).inputFiles()) == 2


def test_suppression_leaves_denominators(spark, rows):
    table = long_table(spark, ("A", D1, "num", "3"), ("A", D1, "den", "3"), ("B", D1, "num", "12"))
    assert rows(publish.suppressed(table, ["num"]), "ATTRIBUTE_IDENTIFIER", "ATTRIBUTE_VALUE") == [
        ("den", "3"), ("num", "*"), ("num", "10")]


def test_stack_aligns_by_name(spark, rows):
    left = spark.createDataFrame([(1, "a")], "n int, t string")
    right = spark.createDataFrame([("b", 2, True)], "t string, n int, more boolean")
    assert rows(publish.stack([left, right])) == [(1, "a"), (2, "b")]


def test_routing(spark, rows):
    target = new_path(spark, "test-routed")
    table = long_table(spark, ("A", D1, "x", "1"), ("B", D1, "x", "2")).withColumn(
        "DATA_REFERENCE_IDENTIFIER", F.col("ORG_ID"))
    sinks.route(table, target)
    assert rows(sinks.read_routed(spark, target, "B"), "ORG_ID") == [("B",)]
