"""Monthly run of the standardised admissions indicator.

Every stage is written to the store and read back. Single episodes are read once per year; all
steps after the cohorts work on tables of a few rows per network.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame

from ratesmith import constants as c
from ratesmith.functions.period import ReportingPeriod
from ratesmith.operators import audit, cohort, diff, mapping, population, publish, quality, standardise
from ratesmith.plans.store import Store
from ratesmith.sources import reference, scans

CQRS, UDAL, PUBLICATION = "published_cqrs", "published_udal", "publication"
CHECKED = "checked_udal"  # the second consumer's rows before suppression


@dataclass(frozen=True)
class AdmissionsInputs:
    """Source tables: episodes of both years, wide population, register, memberships."""

    episodes: DataFrame
    baseline_episodes: DataFrame
    population: DataFrame
    register: DataFrame
    memberships: DataFrame


def prepare(inputs: AdmissionsInputs, period: ReportingPeriod, store: Store) -> None:
    """Mapping, populations and cohorts."""
    practices = store.stage("mapping", mapping.mapping_as_of(inputs.memberships, period.end))
    days = [period.month_start, period.baseline_month_start, period.start]
    bands = store.stage("network_bands", population.network_bands(
        inputs.population, practices, days, inputs.register
    ))
    attributes = population.denominator_attributes(period)
    store.stage("list_size", population.list_size_from(bands, attributes))
    store.stage("standard", population.standard_from(bands, period.start))
    store.stage("cohort", cohort.select_cohort(
        scans.episodes(inputs.episodes), period.start, period.end, period.month_start
    ))
    store.stage("baseline_cohort", cohort.select_cohort(
        scans.episodes(inputs.baseline_episodes), period.baseline_start, period.baseline_end,
        period.baseline_month_start,
    ))


def numerators(period: ReportingPeriod, store: Store) -> DataFrame:
    """Standardised admissions of both years, with the network names."""
    practices, standard = store.read("mapping"), store.read("standard")
    list_size = store.read("list_size")
    years = [
        standardise.standardised_numerator(
            store.read(table), practices, population.snapshot(list_size, month), standard,
            attribute,
        )
        for table, month, attribute in (
            ("cohort", period.month_start, c.ADMISSIONS_NUMERATOR),
            ("baseline_cohort", period.baseline_month_start, c.ADMISSIONS_BASE_NUMERATOR),
        )
    ]
    both = years[0].unionByName(years[1], allowMissingColumns=True)
    return store.stage("numerator", standardise.with_network_names(both, practices))


def landing_tables(
    period: ReportingPeriod, store: Store, created_at: datetime, suppress: bool = False
) -> dict[str, DataFrame]:
    """Rows for the three consumers; suppression is optional and applies to numerators only."""
    list_size, numerator = store.read("list_size"), store.read("numerator")
    codes = reference.attribute_codes(reference.attribute_mapping(store.spark))

    def long(table: DataFrame, value: str, labels: dict[str, str] | None = None) -> DataFrame:
        return publish.long_rows(
            table, "PCN_CODE", period.end, labels or {}, value, codes, created_at
        )

    def labelled(table: DataFrame, value: str, labels: dict[str, str]) -> DataFrame:
        return publish.publication_rows(
            table, c.NETWORK_TYPE, "PCN_CODE", "PCN_NAME", period.year_label, period.end,
            c.ADMISSIONS_CODE, labels, value, created_at,
        )

    cqrs = publish.stack([long(list_size, "COUNT"), long(numerator, "standardised_admissions")])
    udal = publish.stack([cqrs, long(numerator, "admissions", c.CRUDE_IDS)])
    checked = udal
    if suppress:
        udal = publish.suppressed(udal, [
            c.ADMISSIONS_NUMERATOR, c.ADMISSIONS_BASE_NUMERATOR,
            c.ADMISSIONS_CRUDE, c.ADMISSIONS_BASE_CRUDE,
        ])
    publication = publish.stack([
        labelled(list_size, "COUNT", c.DENOMINATOR_LABELS),
        labelled(numerator, "standardised_admissions", c.NUMERATOR_LABELS),
        labelled(numerator, "admissions", c.CRUDE_LABELS),
    ])
    return {CQRS: cqrs, CHECKED: checked, UDAL: udal, PUBLICATION: publication}


def _pair_checks(table: str, pairs: list[tuple[str, str]]) -> list[audit.Check]:
    return [check for numerator, denominator in pairs for check in (
        audit.month_total(f"{table}: month total {numerator}", numerator),
        audit.organisation_total_with_population(
            f"{table}: organisation total {numerator}", numerator, denominator),
    )]


_CURRENT = (c.ADMISSIONS_NUMERATOR, c.ADMISSIONS_DENOMINATOR)
_BASELINE = (c.ADMISSIONS_BASE_NUMERATOR, c.ADMISSIONS_BASE_DENOMINATOR)
_CRUDE = (c.ADMISSIONS_CRUDE, c.ADMISSIONS_DENOMINATOR)
_BASE_CRUDE = (c.ADMISSIONS_BASE_CRUDE, c.ADMISSIONS_BASE_DENOMINATOR)
CQRS_CHECKS = [
    audit.attributes("cqrs: attributes per organisation", 4),
    audit.organisations("cqrs: organisation count"),
    *(audit.share(f"cqrs: share {pair[0]}", *pair) for pair in (_CURRENT, _BASELINE)),
    *_pair_checks("cqrs", [_CURRENT, _BASELINE]),
]
UDAL_CHECKS = [
    audit.attributes("udal: attributes per organisation", 6),
    audit.organisations("udal: organisation count"),
    *(audit.share(f"udal: share {pair[0]}", *pair) for pair in (_CRUDE, _BASE_CRUDE)),
    *_pair_checks("udal", [_CURRENT, _BASELINE, _CRUDE, _BASE_CRUDE]),
]
ONE_MAPPING, TABLES_AGREE = "mapping: one row per practice", "cqrs and udal agree"
CHECK_NAMES = [ONE_MAPPING, *(check.name for check in CQRS_CHECKS + UDAL_CHECKS), TABLES_AGREE]
OFFENDERS = "check_offenders"


def checked(store: Store) -> DataFrame:
    """Offending rows of every check, stored; each published table is read by two scans."""
    cqrs, udal = store.published(CQRS), store.published(CHECKED)
    parts = [audit.as_offenders(
        ONE_MAPPING, quality.repeated_practices(store.read("mapping")), "PRACTICE_CODE", "mappings")]
    for name, table, wanted in (("cqrs", cqrs, CQRS_CHECKS), ("udal", udal, UDAL_CHECKS)):
        cells = store.stage(f"check_cells_{name}", audit.cells(table, wanted))
        parts.append(audit.offenders(cells, wanted))
    different = diff.tables_match(cqrs, udal, [c.ADMISSIONS_CRUDE, c.ADMISSIONS_BASE_CRUDE])
    parts.append(audit.as_offenders(TABLES_AGREE, different, "ORG_ID", "left_rows", "right_rows"))
    return store.stage(OFFENDERS, audit.all_offenders(parts))


def run(
    inputs: AdmissionsInputs,
    period: ReportingPeriod,
    store: Store,
    created_at: datetime,
    suppress: bool = False,
) -> DataFrame:
    """Whole run; returns the summary of its checks, which read the values before suppression.

    The offending rows themselves are in the store's table `OFFENDERS`.
    """
    prepare(inputs, period, store)
    numerators(period, store)
    for name, rows in landing_tables(period, store, created_at, suppress).items():
        batch = store.stage(f"landing_{name}", rows)
        if name != CHECKED:
            store.archive(f"archive_{name}", batch)
        if name == PUBLICATION:
            store.stage(name, batch.drop("CREATED_AT"))
        else:
            store.publish(name, batch)
    return audit.summary(checked(store), CHECK_NAMES)
