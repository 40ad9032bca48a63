"""Appointment measures."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ratesmith import constants as c
from ratesmith.operators import publish, rollup
from ratesmith.sources import reference
from registry import bindings as b
from registry.catalogue import register
from registry.check_views import AT
from registry.views import Tables

_EIGHT = (
    "national_category IN ('General Consultation Acute', 'General Consultation Routine', 'Unplanned Clinical Activity', 'Clinical Triage', "
    "'Walk-in', 'Home Visit', 'Care Home Visit', 'Care Related Encounter but does not fit into any other category')"
)
_SHORT = "time_between_booking_and_appt IN ('Same Day', '1 Day', '2 to 7 Days', '8 to 14 Days')"
_ROUND = "national_category = 'Patient contact during Care Home Round'"
_IDS = {
    c.WAITS_DENOMINATOR_LABEL: ("283A5FDD-D4BA-4DF7-AC70-B59C83285D3E", "FB4D2185-044E-44A4-9C11-02A0A4034A02"),
    c.WAITS_NUMERATOR_LABEL: ("283A5FDD-D4BA-4DF7-AC70-B59C83285D3E", "767390F9-FD7E-4B01-A8AE-82B41DE00A02"),
    c.ROUNDS_NUMERATOR_LABEL: ("FB4334A8-2E9C-43AB-9D1F-51C4A4F14E6B", "982C9A99-A4EA-48FB-ABE9-B60B3E2F1719"),
}


def measure_check(label: str, condition: str, extra: str = "TRUE") -> str:
    """Filter, sum per practice, then add the practices without a row at zero."""
    indicator, attribute = _IDS[label]
    return f"""
SELECT u.gp_code AS ORG_ID, COALESCE(CAST(s.total AS VARCHAR), '0') AS ATTRIBUTE_VALUE, '{label}' AS FRIENDLY_IDENTIFIER, DATE '{AT}' AS ACHIEVEMENT_DATE,
 '{indicator}' AS DATA_REFERENCE_IDENTIFIER, '{attribute}' AS ATTRIBUTE_IDENTIFIER, 'int' AS ATTRIBUTE_TYPE, '2001-01-05 09:30:00' AS CREATED_AT
FROM (SELECT DISTINCT gp_code FROM {{ck_window}} WHERE {extra}) u
LEFT JOIN (SELECT gp_code, CAST(SUM(appt_count) AS BIGINT) AS total FROM {{ck_window}} WHERE {extra} AND {condition} GROUP BY 1) s ON s.gp_code = u.gp_code"""


DENOMINATOR_CHECK = measure_check(c.WAITS_DENOMINATOR_LABEL, _EIGHT)
NUMERATOR_CHECK = measure_check(c.WAITS_NUMERATOR_LABEL, f"{_EIGHT} AND {_SHORT}")
ROUNDS_CHECK = measure_check(c.ROUNDS_NUMERATOR_LABEL, _ROUND)


def measured(t: Tables, labels: list[str], activity: DataFrame | None = None) -> DataFrame:
    """Export rows of some measures."""
    measures = {label: rollup.appointment_measures()[label] for label in labels}
    source = b.appointments(t) if activity is None else activity
    totals = rollup.activity_totals(source, measures, b.PERIOD.end)
    identified = reference.with_attribute_ids(totals, reference.attribute_mapping(t.spark))
    return publish.finish_activity_rows(identified, b.CREATED_AT)


@register(DENOMINATOR_CHECK)
def acc_denominator(t: Tables) -> DataFrame:
    return b.stamp_text(measured(t, [c.WAITS_DENOMINATOR_LABEL]))


@register(NUMERATOR_CHECK)
def acc_numerator(t: Tables) -> DataFrame:
    return b.stamp_text(measured(t, [c.WAITS_NUMERATOR_LABEL]))


@register(ROUNDS_CHECK)
def care_home_rounds(t: Tables) -> DataFrame:
    return b.stamp_text(measured(t, [c.ROUNDS_NUMERATOR_LABEL]))


@register(measure_check(
    c.WAITS_NUMERATOR_LABEL, f"{_EIGHT} AND {_SHORT}",
    "context_type = 'Care Related Encounter' AND appt_status IN ('Unknown', 'Attended', 'Seen', 'DNA')",
))
def appt_context_filtered(t: Tables) -> DataFrame:
    """The same measure with the optional context and status filter."""
    kept = rollup.care_related_only(b.appointments(t))
    return b.stamp_text(measured(t, [c.WAITS_NUMERATOR_LABEL], kept))


@register(f"""
SELECT u.gp_code AS GP_Code, CAST(COALESCE(s.total, 0) AS BIGINT) AS total FROM (SELECT DISTINCT gp_code FROM {{fx_appointments}}) u
LEFT JOIN (SELECT gp_code, SUM(appt_count) AS total FROM {{ck_window}} WHERE {_ROUND} AND appt_date >= DATE '2000-12-01' GROUP BY 1) s ON s.gp_code = u.gp_code""")
def zero_fill(t: Tables) -> DataFrame:
    """Care-home rounds of one month for every practice that ever reported."""
    rows = b.appointments(t).where(
        rollup.care_home_rounds() & (F.col("Appointment_Date") >= F.lit(b.PERIOD.month_start))
    )
    totals = rows.groupBy("GP_Code").agg(F.sum("Appointments").alias("total"))
    universe = t["fx_appointments"].select(F.col("gp_code").alias("GP_Code")).distinct()
    return rollup.zero_fill(totals, universe, "GP_Code", "total")
