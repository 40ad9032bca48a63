from datetime import date

from pyspark.sql import functions as F

from ratesmith.operators import mapping

HISTORY = (
    "PRACTICE_NAME string, PRACTICE_CODE string, RELATIONSHIP_START_DATE date, "
    "RELATIONSHIP_END_DATE date, PCN_NAME string, PCN_CODE string"
)


def test_latest_valid_version_wins(spark, rows):
    d = date
    history = spark.createDataFrame([
        ("one", "A", d(2000, 1, 1), None, "first", "N1"),
        ("one", "A", d(2000, 6, 1), None, "second", "N2"),
        ("one", "A", d(2001, 1, 1), None, "future", "N3"),
        ("two", "B", d(2000, 1, 1), d(2000, 12, 31), "last day", "N1"),
        ("three", "C", d(2000, 1, 1), d(2000, 12, 30), "ended", "N1"),
        ("four", "D", d(2000, 3, 1), None, "tie high", "N9"),
        ("four", "D", d(2000, 3, 1), None, "tie low", "N4"),
        ("four", "D", d(2000, 3, 1), d(2002, 1, 1), "tie low", "N4"),
    ], HISTORY)
    found = mapping.mapping_as_of(history, "2000-12-31")
    assert found.columns == history.columns + ["EXTRACT_DATE"]
    assert rows(found, "PRACTICE_CODE", "PCN_CODE", "RELATIONSHIP_START_DATE") == [
        ("A", "N2", d(2000, 6, 1)), ("B", "N1", d(2000, 1, 1)), ("D", "N4", d(2000, 3, 1))]
    assert dict(found.dtypes)["RELATIONSHIP_START_DATE"] == "date"


def test_version_dates_survive_ranking(spark, rows):
    d = date
    history = spark.createDataFrame([
        ("A", d(1900, 2, 3), None, "N1"), ("A", d(1900, 2, 3), d(9999, 12, 31), "N1"),
        ("B", d(1960, 1, 1), d(2000, 12, 31), "N1"), ("B", d(1960, 1, 1), d(9999, 12, 31), "N1"),
        ("C", d(1, 1, 1), d(2010, 1, 1), "N1"),
    ], "PRACTICE_CODE string, RELATIONSHIP_START_DATE date, RELATIONSHIP_END_DATE date, PCN_CODE string")
    found = mapping.mapping_as_of(history, "2000-12-31")
    assert rows(found.drop("EXTRACT_DATE")) == [
        ("A", d(1900, 2, 3), None, "N1"), ("B", d(1960, 1, 1), d(2000, 12, 31), "N1"),
        ("C", d(1, 1, 1), d(2010, 1, 1), "N1")]


def test_active_practices(spark, rows):
    d = date
    register = spark.createDataFrame([
        ("A", d(1990, 4, 1), None, d(1990, 4, 1), None),
        ("A", d(1990, 4, 1), None, d(1995, 4, 1), None),
        ("B", d(2001, 1, 1), None, d(1990, 4, 1), None),
        ("C", d(1990, 4, 1), d(1999, 6, 30), d(1990, 4, 1), None),
        ("D", d(1990, 4, 1), None, d(1990, 4, 1), d(2000, 6, 30)),
        ("E", d(1990, 4, 1), d(2000, 12, 1), d(1990, 4, 1), None),
        ("F", d(1990, 4, 1), None, d(1990, 4, 1), None),
    ], "CODE string, OPEN_DATE date, CLOSE_DATE date, DSS_RECORD_START_DATE date, "
       "DSS_RECORD_END_DATE date")
    sizes = spark.createDataFrame(
        [(code, d(2000, 12, 1), 5) for code in "ABCDE"] + [("F", d(2000, 4, 1), 5)],
        "PRACTICE_CODE string, EXTRACT_DATE date, n int")
    active = mapping.active_practices(register, sizes, "2000-12-01")
    assert rows(active) == [("A",), ("A",), ("E",)]
    kept = mapping.active_only(sizes, active)
    assert rows(kept, "PRACTICE_CODE", "n") == [("A", 5), ("E", 5)]
    pairs = mapping.active_on_dates(register, ["2000-12-01", "2000-04-01"])
    assert rows(mapping.active_only(sizes, pairs), "PRACTICE_CODE") == [("A",), ("E",), ("F",)]


def test_membership_needs_roles_and_operational_parties(spark, rows):
    orgs = spark.createDataFrame(
        [("P1", "prac", "Operational"), ("P2", "legal", "Legal"), ("P3", "other", "Operational"),
         ("N1", "net", "Operational"), ("N2", "branch", "Operational")],
        "organisationID string, Name string, datetype string")
    roles = spark.createDataFrame(
        [("P1", "RO76", 1, "Operational"), ("P2", "RO76", 1, "Operational"),
         ("P3", "RO999", 1, "Operational"), ("N1", "RO272", 1, "Operational"),
         ("N2", "RO272", 0, "Operational")],
        "organisationID string, roleID string, primaryRole int, datetype string")
    codes = spark.createDataFrame(
        [("RO76", "GP PRACTICE"), ("RO999", "OTHER"), ("RO272", "PRIMARY CARE NETWORK"),
         ("RE8", "IS PARTNER TO"), ("RE4", "IS COMMISSIONED BY")], "ID string, displayname string")
    links = spark.createDataFrame(
        [("P1", "N1", "RE8"), ("P1", "N2", "RE8"), ("P1", "N1", "RE4"), ("P2", "N1", "RE8"),
         ("P3", "N1", "RE8")],
        "organisationID string, targetOrganisationID string, relationshipID string").selectExpr(
        "*", "date'2000-01-01' AS StartDate", "CAST(NULL AS DATE) AS EndDate")
    found = mapping.membership_history(orgs, roles, codes, links)
    assert rows(found, "PRACTICE_NAME", "PRACTICE_CODE", "PCN_CODE", "PCN_NAME") == [
        ("prac", "P1", "N1", "net")]


def test_key_sets(spark, rows):
    left = spark.createDataFrame([("a",), ("b",), ("b",)], "k string")
    right = spark.createDataFrame([("b",), ("c",)], "k string")
    assert rows(mapping.shared_keys(left, right, "k")) == [("b",)]
    assert mapping.shared_keys(left, right.where("k = 'c'"), "k").isEmpty()


def test_intervals_merge_where_they_overlap_or_touch(spark, rows):
    d = date
    history = spark.createDataFrame([
        ("p", "A", d(2000, 1, 1), d(2000, 3, 31), "n", "N1"), ("p", "A", d(2000, 4, 1), d(2000, 6, 30), "n", "N1"),
        ("p", "A", d(2000, 2, 1), d(2000, 2, 10), "n", "N1"), ("p", "A", d(2000, 8, 1), None, "n", "N1"),
        ("p", "A", d(2001, 1, 1), d(2001, 2, 1), "n", "N1"), ("p", "A", d(2000, 5, 1), None, "m", "N2"),
        ("q", "B", None, d(2001, 1, 1), "n", "N1"), ("q", "B", d(2000, 5, 1), d(2000, 4, 1), "n", "N1"),
        ("q", "B", d(2000, 1, 1), d(2000, 1, 1), "n", "N1"), ("q", "B", d(2000, 1, 3), d(2000, 1, 4), "n", "N1"),
    ], HISTORY)
    found = mapping.merged_history(history)
    assert found.columns == history.columns
    assert rows(found, "PRACTICE_CODE", "PCN_CODE", "RELATIONSHIP_START_DATE", "RELATIONSHIP_END_DATE") == [
        ("A", "N1", d(2000, 1, 1), d(2000, 6, 30)), ("A", "N1", d(2000, 8, 1), None),
        ("A", "N2", d(2000, 5, 1), None), ("B", "N1", d(2000, 1, 1), d(2000, 1, 1)),
        ("B", "N1", d(2000, 1, 3), d(2000, 1, 4))]
    # validity on any day is what it was
    for day in ("2000-02-05", "2000-03-31", "2000-07-15", "2000-01-02", "2001-06-01"):
        when = F.lit(date.fromisoformat(day))
        valid = mapping.valid_on(when, "RELATIONSHIP_START_DATE", "RELATIONSHIP_END_DATE")
        assert rows(found.where(valid).select("PRACTICE_CODE", "PCN_CODE").distinct()) == rows(
            history.where(valid).select("PRACTICE_CODE", "PCN_CODE").distinct())
    assert mapping.merged_history(history.limit(0)).isEmpty()


def test_many_rows_of_one_relationship_merge_by_day(spark):
    history = spark.range(0, 200_000, 1, 8).select(
        F.lit("p").alias("PRACTICE_NAME"), F.lit("A").alias("PRACTICE_CODE"),
        F.date_add(F.lit(date(1990, 1, 1)), (F.col("id") % 2000 * 2).cast("int")).alias("RELATIONSHIP_START_DATE"),
        F.date_add(F.lit(date(1990, 1, 1)), (F.col("id") % 2000 * 2).cast("int")).alias("RELATIONSHIP_END_DATE"),
        F.lit("n").alias("PCN_NAME"), F.lit("N1").alias("PCN_CODE"))
    found = mapping.merged_history(history).collect()
    assert len(found) == 2000  # every second day lies between two intervals of one day
    plan = mapping.merged_history(history)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan
