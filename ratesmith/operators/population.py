"""Registered population by network and age band, and the standard population."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from ratesmith import constants as c
from ratesmith.functions.period import ReportingPeriod, as_date
from ratesmith.functions.values import relabel
from ratesmith.operators.mapping import active_on_dates, active_only
from ratesmith.operators.reshape import totals_by_band

IDS = ["PRACTICE_CODE", "EXTRACT_DATE"]
ADMIN_COLUMNS = ("GP_PATIENT_LIST_KEY", "SYSTEM_CREATED_DATE")


def snapshot(wide: DataFrame, *days: date | str) -> DataFrame:
    """Population table as extracted on the given dates, without its admin columns."""
    dates = [F.lit(as_date(day)) for day in days]
    return wide.where(F.col("EXTRACT_DATE").isin(dates)).drop(*ADMIN_COLUMNS)


def _active(
    wide: DataFrame, register: DataFrame | None, days: Sequence[date | str]
) -> DataFrame:
    rows = snapshot(wide, *days)
    return rows if register is None else active_only(rows, active_on_dates(register, days))


def network_bands(
    wide: DataFrame,
    mapping: DataFrame,
    days: Sequence[date | str],
    register: DataFrame | None = None,
) -> DataFrame:
    """Population per snapshot date, network and 5-year band, in one scan for all dates.

    Practices outside any network form the NULL network, so that national totals are complete.
    The result holds 40 rows per network and date; runs stage it and derive the rest from it.
    """
    members = mapping.select("PRACTICE_CODE", "PCN_CODE", "PCN_NAME")
    rows = _active(wide, register, days).join(members, "PRACTICE_CODE", "left")
    return totals_by_band(
        rows, [*IDS, "PCN_CODE", "PCN_NAME"], ["PCN_CODE", "PCN_NAME", "EXTRACT_DATE"],
        "AGE_FIVE_YEAR", "COUNT",
    )


def list_size_from(bands: DataFrame, attributes: Mapping[date | str, str]) -> DataFrame:
    """Population of the networks on some dates, with the attribute id of each date."""
    labels = {as_date(day).isoformat(): label for day, label in attributes.items()}
    dates = [F.lit(as_date(day)) for day in attributes]
    kept = bands.where(F.col("PCN_CODE").isNotNull() & F.col("EXTRACT_DATE").isin(dates))
    return kept.select(
        "PCN_CODE", "PCN_NAME", "AGE_FIVE_YEAR", "COUNT",
        relabel(F.col("EXTRACT_DATE").cast("string"), labels).alias("Attribute_ID"),
        "EXTRACT_DATE",
    )


def standard_from(bands: DataFrame, day: date | str) -> DataFrame:
    """National population per band on a date, practices outside any network included."""
    if as_date(day).day != 1:
        raise ValueError("the standard population needs the first day of a month")
    return (
        bands.where(F.col("EXTRACT_DATE") == F.lit(as_date(day)))
        .groupBy("AGE_FIVE_YEAR", "EXTRACT_DATE")
        .agg(F.sum("COUNT").alias("Count"))
    )


def denominator_attributes(period: ReportingPeriod) -> dict[date, str]:
    """Snapshot date and attribute id of the current and the baseline population."""
    return {
        period.month_start: c.ADMISSIONS_DENOMINATOR,
        period.baseline_month_start: c.ADMISSIONS_BASE_DENOMINATOR,
    }


def list_size_by_network(
    wide: DataFrame,
    mapping: DataFrame,
    attributes: Mapping[date | str, str],
    register: DataFrame | None = None,
) -> DataFrame:
    """Population of the networks straight from the wide table."""
    return list_size_from(network_bands(wide, mapping, list(attributes), register), attributes)


def standard_population(
    wide: DataFrame, day: date | str, register: DataFrame | None = None
) -> DataFrame:
    """National population per band straight from the wide table; needs no mapping."""
    if as_date(day).day != 1:
        raise ValueError("the standard population needs the first day of a month")
    rows = _active(wide, register, [day])
    return totals_by_band(rows, IDS, ["EXTRACT_DATE"], "AGE_FIVE_YEAR", "Count").select(
        "AGE_FIVE_YEAR", "EXTRACT_DATE", "Count"
    )
