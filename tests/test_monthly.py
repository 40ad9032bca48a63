"""Whole monthly runs on the smallest given tables."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ratesmith import constants as c
from ratesmith.functions.period import ReportingPeriod
from ratesmith.plans import admissions, appointments
from ratesmith.plans.store import Store
from ratesmith.sources.workspace import new_path
from registry import bindings as b
from registry.views import Tables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, FOLDER)


def test_admissions_run_twice(spark, tables, rows):
    store = Store(spark, new_path(spark, "test-admissions"))
    episodes = tables["fx_episode_table"]
    inputs = admissions.AdmissionsInputs(
        episodes, episodes, b.wide_list_size(tables), b.register_rows(tables),
        tables["fx_mapping_history"])
    first, again = datetime(2001, 1, 5), datetime(2001, 1, 6)
    summary = admissions.run(inputs, b.PERIOD, store, first)
    passed = {r["check"]: r.passed for r in summary.collect()}
    assert passed["mapping: one row per practice"] and passed["cqrs and udal agree"]
    assert passed["cqrs: attributes per organisation"]
    assert passed["udal: attributes per organisation"]
    networks = store.read("mapping").select("PCN_CODE").distinct().count()
    before = rows(store.published(admissions.CQRS).drop("CREATED_AT"))
    assert len(before) == networks * 4
    admissions.landing_tables(b.PERIOD, store, again)
    admissions.run(inputs, b.PERIOD, store, again)
    assert rows(store.published(admissions.CQRS).drop("CREATED_AT")) == before
    assert store.archived("archive_published_cqrs").count() == 2 * len(before)
    assert store.read(admissions.PUBLICATION).count() == networks * 6
    assert "CREATED_AT" not in store.read(admissions.PUBLICATION).columns
    # the offending rows themselves are stored
    listed = {r["check"]: r["count"] for r in store.read(admissions.OFFENDERS).groupBy("check").count().collect()}
    assert listed == {r["check"]: r.offenders for r in summary.collect() if r.offenders}
    assert [r["check"] for r in summary.collect() if r["check"] not in admissions.CHECK_NAMES] == []
    assert len(passed) == len(admissions.CHECK_NAMES) == 2 + 8 + 12
    # a batch with the same stamp does not reach the archive again
    plain = {r["check"]: r.offenders for r in summary.collect()}
    hiding = admissions.run(inputs, b.PERIOD, store, again, suppress=True)
    assert {r["check"]: r.offenders for r in hiding.collect()} == plain
    assert store.archived("archive_published_cqrs").count() == 2 * len(before)
    hidden = store.published(admissions.UDAL)
    crude = hidden.where(F.col("ATTRIBUTE_IDENTIFIER") == c.ADMISSIONS_CRUDE)
    assert crude.where("NOT (ATTRIBUTE_VALUE IN ('0', '*') OR ATTRIBUTE_VALUE % 5 = 0)").isEmpty()


def test_appointments_over_two_months(spark, tables):
    store = Store(spark, new_path(spark, "test-appointments"))
    for end, created in (("2000-11-30", datetime(2000, 12, 5)), ("2000-12-31", datetime(2001, 1, 5))):
        summary = appointments.run(
            tables["fx_appointments"], tables["fx_mapping_history"], ReportingPeriod.parse(end),
            store, created)
    found = {r["check"]: r.offenders for r in summary.collect()}
    assert found["waits: share"] == 0 and found["waits: attributes per organisation"] == 0
    assert found["rounds: attributes per organisation"] == 0
    waits = store.published("published_cqrs_waits")
    assert waits.select("ACHIEVEMENT_DATE").distinct().count() == 2
    assert waits.where(F.col("DATA_REFERENCE_IDENTIFIER") != c.WAITS_INDICATOR).isEmpty()
    rounds = store.published("published_udal_rounds")
    assert rounds.groupBy("ORG_ID", "ACHIEVEMENT_DATE").count().where("count <> 1").isEmpty()
    assert store.archived("archive").count() == waits.count() + rounds.count()
