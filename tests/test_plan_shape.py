"""The physical plans that matter at scale: scans, pushed filters, shuffles."""

import re
from datetime import date

import pytest

from ratesmith.operators import cohort, mapping, rollup, standardise
from ratesmith.sources import scans, sinks
from ratesmith.sources.workspace import new_path, staged
from registry import bindings as b
from registry.views import Tables

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def simple(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def episodes(spark):
    """The episode table as a stored table, as a run finds it."""
    path = new_path(spark, "test-episodes")
    Tables(spark, FOLDER)["fx_episode_table"].write.parquet(path)
    return spark.read.parquet(path)


def test_cohort_scans_once_and_pushes_its_filters(episodes):
    plan = plan_of(cohort.select_cohort(
        scans.episodes(episodes), "2000-04-01", "2000-12-31", "2000-12-01"))
    assert len(re.findall(r"\(\d+\) Scan parquet", plan)) == 1
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan).group(1)
    for part in ("GreaterThanOrEqual(ADMIDATE,2000-04-01)", "LessThanOrEqual(ADMIDATE,2000-12-31)",
                 "EqualTo(EPISTAT,3)", "EqualTo(EPIORDER,1)", "In(ADMIMETH", "IsNotNull(MYDOB)"):
        assert part in pushed, part
    assert len(re.findall(r"\(\d+\) Exchange", plan)) == 1


def test_admission_cells_shuffle_totals_not_episodes(spark, episodes):
    practices = spark.createDataFrame(
        [("1", "N", "n")], "PRACTICE_CODE string, PCN_CODE string, PCN_NAME string")
    rows = cohort.cohort_rows(
        scans.episodes(episodes), "2000-04-01", "2000-12-31", "2000-12-01")
    plan = simple(standardise.admission_cells(rows, practices))
    # the joins stand above the aggregation of the episodes, not below it
    assert plan.index("Join") < plan.index("partial_sum(FAE_EMERGENCY")
    # a scan reads the columns it needs and no others
    assert "MAINSPEF" in plan and "DIAG_3_CONCAT" in plan


def test_appointment_measures_take_one_scan_and_one_shuffle(spark):
    table = Tables(spark, FOLDER)["fx_appointments"]
    totals = rollup.activity_totals(
        scans.appointments(table, b.PERIOD), rollup.appointment_measures(), b.PERIOD.end)
    plan = simple(totals)
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in plan
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate,2000-04-01" in plan


def test_mapping_is_reduced_before_its_shuffle(spark):
    path = new_path(spark, "test-history")
    Tables(spark, FOLDER)["fx_mapping_history"].write.parquet(path)
    plan = simple(mapping.mapping_as_of(spark.read.parquet(path), date(2000, 12, 31)))
    # reading upwards from the scan: a hash aggregate, then the first shuffle, and no sort before
    below_first_shuffle = plan[plan.rindex("Exchange"):]
    assert "HashAggregate" in below_first_shuffle and "partial_max" in below_first_shuffle
    assert "Sort" not in below_first_shuffle
    assert "LessThanOrEqual(RELATIONSHIP_START_DATE,2000-12-31)" in plan


def test_published_update_reads_only_its_dates(spark):
    path = new_path(spark, "test-published-plan")
    sinks.start_published(b.published(Tables(spark, FOLDER)), path)
    table = sinks.read_published(spark, path)
    plan = simple(table.where("ACHIEVEMENT_DATE BETWEEN date'2000-11-30' AND date'2000-12-31'"))
    assert re.search(r"PartitionFilters: \[isnotnull\(ACHIEVEMENT_DATE", plan)


def test_staged_tables_survive_in_the_shared_folder(spark):
    df = staged(spark.range(5), "test")
    assert df.count() == 5 and "FileScan" in simple(df)


@pytest.fixture
def merge_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_totals_reach_the_grid_with_one_scan_of_the_mapping(spark, episodes, merge_joins):
    path = new_path(spark, "test-mapping")
    spark.createDataFrame([("1", "N", "n")], "PRACTICE_CODE string, PCN_CODE string, PCN_NAME string").write.parquet(path)
    rows = cohort.cohort_rows(scans.episodes(episodes), "2000-04-01", "2000-12-31", "2000-12-01")
    for build in (standardise.admissions_by_band, standardise.admissions_by_network):
        plan = simple(build(rows, spark.read.parquet(path)))
        assert plan.count("FileScan") == 2  # the episodes and the mapping
