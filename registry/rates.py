"""Standardised rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ratesmith import constants as c
from ratesmith.operators import population, standardise
from ratesmith.sources.workspace import staged
from registry import bindings as b
from registry.catalogue import register
from registry.check_views import CURRENT
from registry.views import Tables

_RATE_COLUMNS = (
    "PCN_CODE, CAST(admissions AS BIGINT) AS admissions, CAST(eng_population AS BIGINT) AS eng_population, ROUND(stan_sum, 4) AS stan_sum, ROUND(DSR, 10) AS DSR, "
    "CAST(pcn_pop AS BIGINT) AS pcn_pop, standardised_admissions, ROUND(percentage_change, 6) AS percentage_change, ATTRIBUTE_ID"
)


def _rounded(rates: DataFrame) -> DataFrame:
    digits = {"stan_sum": 4, "DSR": 10, "percentage_change": 6}
    return rates.withColumns({name: F.round(name, n) for name, n in digits.items()}).drop(
        "strata_skipped"
    )


def numerator(
    t: Tables, practices: DataFrame, bands: DataFrame, baseline: bool = False
) -> DataFrame:
    """Numerator of one year. Both years use the current mapping and the same standard."""
    month = b.PERIOD.baseline_month_start if baseline else b.PERIOD.month_start
    attribute = c.ADMISSIONS_BASE_NUMERATOR if baseline else c.ADMISSIONS_NUMERATOR
    return standardise.standardised_numerator(
        b.baseline_cohort(t) if baseline else b.current_cohort(t),
        practices,
        population.list_size_from(bands, {month: ""}),
        population.standard_from(bands, b.PERIOD.start),
        attribute,
    )


def staged_inputs(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Mapping and banded population, written once because every later step reads them."""
    practices = staged(b.practice_mapping(t), "pcn_mapping")
    return practices, staged(b.network_bands(t, practices), "network_bands")


def both_numerators(t: Tables, practices: DataFrame, bands: DataFrame) -> DataFrame:
    current = numerator(t, practices, bands)
    baseline = numerator(t, practices, bands, baseline=True)
    both = current.unionByName(baseline, allowMissingColumns=True)
    return standardise.with_network_names(both, practices)


@register(f"SELECT {_RATE_COLUMNS} FROM {{ck_numerator}}")
def dsr_numerator(t: Tables) -> DataFrame:
    """Flagship: directly standardised admissions per network, current year."""
    return _rounded(numerator(t, *staged_inputs(t)))


@register(f"SELECT {_RATE_COLUMNS}, PCN_NAME FROM {{ck_both_numerators}}")
def dsr_two_periods(t: Tables) -> DataFrame:
    return _rounded(both_numerators(t, *staged_inputs(t)))


@register(f"""
SELECT DISTINCT c.GPPRAC AS PRACTICE_CODE, c.EPIKEY, c.STARTAGE AS AGE, c.SEX, c.FAE_EMERGENCY,
 CASE WHEN c.GPPRAC IS NOT NULL THEN DATE '{CURRENT[2]}' END AS EXTRACT_DATE, CASE WHEN c.GPPRAC IS NOT NULL THEN DATE '{CURRENT[0]}' END AS RPSD,
 m.PCN_CODE, m.PCN_NAME FROM {{ck_mapping}} m LEFT JOIN {{ck_cohort}} c ON c.GPPRAC = m.PRACTICE_CODE""")
def cohort_by_pcn(t: Tables) -> DataFrame:
    practices = staged(b.practice_mapping(t), "pcn_mapping")
    return standardise.cases_by_network(b.current_cohort(t), practices)


@register("""
SELECT m.PRACTICE_CODE, m.PCN_CODE, m.PCN_NAME, s.SEX, CASE WHEN a.age = 95 THEN '95+' ELSE CAST(a.age AS VARCHAR) END AS AGE,
 s.SEX || '_' || CASE WHEN a.age = 95 THEN '95+' ELSE CAST(a.age - a.age % 5 AS VARCHAR) || '_' || CAST(a.age - a.age % 5 + 4 AS VARCHAR) END AS AGE_FIVE_YEAR
FROM {ck_mapping} m, (VALUES ('MALE'), ('FEMALE')) s(SEX), (SELECT CAST(unnest(range(0, 96)) AS INT) AS age) a""")
def dense_grid(t: Tables) -> DataFrame:
    return standardise.dense_grid(b.practice_mapping(t))


@register("""
SELECT g.PCN_CODE, g.AGE_FIVE_YEAR, CAST(COALESCE(c.admissions, 0) AS BIGINT) AS admissions
FROM (SELECT DISTINCT PCN_CODE, AGE_FIVE_YEAR FROM (SELECT DISTINCT PCN_CODE FROM {ck_mapping}) p, {ck_england}) g
LEFT JOIN {ck_cells} c ON c.PCN_CODE = g.PCN_CODE AND c.AGE_FIVE_YEAR = g.AGE_FIVE_YEAR""")
def admissions_by_band(t: Tables) -> DataFrame:
    return standardise.admissions_by_band(b.current_cohort(t), b.practice_mapping(t))


@register("""
SELECT p.PCN_CODE, CAST(COALESCE(SUM(c.admissions), 0) AS BIGINT) AS admissions
FROM (SELECT DISTINCT PCN_CODE FROM {ck_mapping}) p LEFT JOIN {ck_cells} c ON c.PCN_CODE = p.PCN_CODE GROUP BY 1""")
def admissions_by_pcn(t: Tables) -> DataFrame:
    return standardise.admissions_by_network(b.current_cohort(t), b.practice_mapping(t))
