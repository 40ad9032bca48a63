"""Monthly run of the appointment indicators."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from ratesmith import constants as c
from ratesmith.functions.period import ReportingPeriod
from ratesmith.operators import audit, mapping, publish, rollup
from ratesmith.plans.store import Store
from ratesmith.sources import reference, scans, sinks

# Consumer tables of each indicator.
CONSUMERS = {
    c.ROUNDS_INDICATOR: ("published_cqrs_rounds", "published_udal_rounds"),
    c.WAITS_INDICATOR: ("published_cqrs_waits", "published_udal_waits"),
}


def export_rows(
    appointments: DataFrame, memberships: DataFrame, period: ReportingPeriod, created_at: datetime
) -> DataFrame:
    """All measures of every practice that belongs to a network on the report date."""
    spark = appointments.sparkSession
    totals = rollup.activity_totals(
        scans.appointments(appointments, period), rollup.appointment_measures(), period.end
    )
    rows = publish.finish_activity_rows(
        reference.with_attribute_ids(totals, reference.attribute_mapping(spark)), created_at
    )
    return mapping.mapped_only(rows, mapping.mapping_as_of(memberships, period.end))


def _checks(table: str, expected: int, numerator: str) -> list[audit.Check]:
    return [
        audit.attributes(f"{table}: attributes per organisation", expected),
        audit.organisations(f"{table}: organisation count"),
        audit.month_total(f"{table}: month total", numerator),
        audit.organisation_total(f"{table}: organisation total", numerator),
    ]


WAITS_CHECKS = [
    audit.share("waits: share", c.WAITS_NUMERATOR, c.WAITS_DENOMINATOR),
    *_checks("waits", 2, c.WAITS_NUMERATOR),
]
ROUNDS_CHECKS = _checks("rounds", 1, c.ROUNDS_NUMERATOR)
OFFENDERS = "check_offenders"


def checked(store: Store) -> DataFrame:
    """Offending rows of every check, stored; each published table is read by one scan."""
    parts = []
    for indicator, wanted in ((c.WAITS_INDICATOR, WAITS_CHECKS), (c.ROUNDS_INDICATOR, ROUNDS_CHECKS)):
        name = CONSUMERS[indicator][0]
        cells = store.stage(f"check_cells_{name}", audit.cells(store.published(name), wanted))
        parts.append(audit.offenders(cells, wanted))
    return store.stage(OFFENDERS, audit.all_offenders(parts))


def run(
    appointments: DataFrame,
    memberships: DataFrame,
    period: ReportingPeriod,
    store: Store,
    created_at: datetime,
) -> DataFrame:
    """Whole run; returns the summary of its checks; offending rows are in the store's `OFFENDERS`."""
    export = store.stage("export", export_rows(appointments, memberships, period, created_at))
    store.archive("archive", export)
    landing = publish.landing_rows(export)
    sinks.route(landing, store.path("landing"))
    for indicator, tables in CONSUMERS.items():
        batch = sinks.read_routed(store.spark, store.path("landing"), indicator)
        for name in tables:
            store.publish(name, batch.select(*publish.LONG_COLUMNS))
    return audit.summary(checked(store), [check.name for check in WAITS_CHECKS + ROUNDS_CHECKS])
