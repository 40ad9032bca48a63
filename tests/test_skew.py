"""One practice with a third of all rows: results stay whole and the work stays split."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from ratesmith.operators import cohort, mapping, rollup, standardise

ROWS = 300_000


@pytest.fixture(scope="module")
def hot(spark):
    """Cohort rows of which every third belongs to one practice; the rest spread over 500."""
    key = F.col("id")
    return spark.range(0, ROWS, 1, 8).select(
        F.when(key % 3 == 0, F.lit("hot")).otherwise((key % 500).cast("string")).alias("GPPRAC"),
        (key - key % 2).alias("EPIKEY"),  # every key twice, half of them exact copies
        F.when(key % 4 < 2, (key % 100).cast("string")).otherwise("95+").alias("STARTAGE"),
        F.lit("MALE").alias("SEX"), F.lit(1).alias("FAE_EMERGENCY"),
        F.lit(date(2000, 12, 1)).alias("RP_month_start"), F.lit(date(2000, 4, 1)).alias("RPSD"),
    )


@pytest.fixture(scope="module")
def practices(spark):
    return spark.range(501).select(
        F.when(F.col("id") == 500, F.lit("hot")).otherwise(F.col("id").cast("string")).alias(
            "PRACTICE_CODE"),
        (F.col("id") % 7).cast("string").alias("PCN_CODE"),
        F.lit("n").alias("PCN_NAME"))


@pytest.fixture
def small_partitions(spark):
    """Thresholds lowered so that the test data is large in comparison."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_single_events_join_in_split_partitions(spark, hot, practices, small_partitions):
    found = standardise.cases_by_network(hot, practices)
    expected = hot.distinct().count()
    assert found.where("EPIKEY IS NOT NULL").count() == expected
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan or "skewed" in plan


def test_totals_shuffle_few_rows_per_practice(spark, hot, practices, small_partitions):
    totals = standardise.practice_totals(hot)
    assert totals.agg(F.sum("admissions")).first()[0] == hot.distinct().count()
    assert totals.groupBy("PRACTICE_CODE").count().agg(F.max("count")).first()[0] <= 192
    cells = standardise.admission_cells(hot, practices)
    assert cells.agg(F.sum("admissions")).first()[0] == hot.distinct().count()


def test_hot_history_and_hot_activity(spark, rows):
    history = spark.range(0, ROWS, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
            (F.col("id") % 50).cast("string")).alias("PRACTICE_CODE"),
        (F.col("id") % 11).cast("string").alias("PCN_CODE"),
        F.date_add(F.lit(date(1990, 1, 1)), (F.col("id") % 3000).cast("int")).alias(
            "RELATIONSHIP_START_DATE"),
        F.lit(None).cast("date").alias("RELATIONSHIP_END_DATE"))
    chosen = mapping.mapping_as_of(history, "2000-12-31")
    expected = history.groupBy("PRACTICE_CODE").agg(F.max("RELATIONSHIP_START_DATE"))
    assert rows(chosen, "PRACTICE_CODE", "RELATIONSHIP_START_DATE") == rows(expected)

    activity = history.select(
        F.col("PRACTICE_CODE").alias("GP_Code"), F.lit("Walk-in").alias("National_Slot_Type"),
        F.lit("1 Day").alias("Wait_Time"), F.lit(2).alias("Appointments"))
    totals = rollup.activity_totals(activity, rollup.appointment_measures(), "2000-12-31")
    hot = totals.where("ORG_ID = 'hot'").collect()
    assert sorted(r.ATTRIBUTE_VALUE for r in hot) == ["0", str(ROWS // 3 * 2), str(ROWS // 3 * 2)]


def test_copies_of_one_row_collapse(spark):
    """A third of an episode table may be copies of one row."""
    base = spark.range(0, 90_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("EPIKEY"))
    one = {
        "GPPRAC": "A", "ADMIDATE": date(2000, 5, 1), "ADMIMETH": "21", "EPISTAT": "3",
        "EPIORDER": 1, "EPITYPE": "1", "STARTAGE": 40, "MYDOB": "051960", "SEX": "1",
        "MAINSPEF": "100", "FAE_EMERGENCY": 1, "DIAG_3_01": "J45", "DIAG_3_CONCAT": "J45",
        "DIAG_4_01": "J459", "DIAG_4_CONCAT": "J459", "OPERTN_3_01": "Z23"}
    table = base.withColumns({name: F.lit(value) for name, value in one.items()})
    found = cohort.select_cohort(table, "2000-04-01", "2000-12-31", "2000-12-01")
    assert found.count() == 60_001
