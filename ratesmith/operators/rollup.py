"""Plain activity roll-ups with zero-fill."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ratesmith import constants as c
from ratesmith.functions.period import as_date


def waits_denominator() -> Column:
    return F.col("National_Slot_Type").isin(c.WAITS_CATEGORIES)


def waits_numerator() -> Column:
    return waits_denominator() & F.col("Wait_Time").isin(c.SHORT_WAITS)


def care_home_rounds() -> Column:
    return F.col("National_Slot_Type") == c.CARE_HOME_ROUND


def appointment_measures() -> dict[str, Column]:
    """The published appointment measures, by attribute description."""
    return {
        c.WAITS_DENOMINATOR_LABEL: waits_denominator(),
        c.WAITS_NUMERATOR_LABEL: waits_numerator(),
        c.ROUNDS_NUMERATOR_LABEL: care_home_rounds(),
    }


def care_related_only(appointments: DataFrame) -> DataFrame:
    """Optional restriction to care-related contexts and counted statuses."""
    return appointments.where(
        (F.col("Context_Type") == c.CARE_CONTEXT)
        & F.col("Appointment_Status").isin(c.COUNTED_STATUSES)
    )


def practice_universe(appointments: DataFrame) -> DataFrame:
    return appointments.select("GP_Code").distinct()


def activity_totals(
    activity: DataFrame,
    measures: Mapping[str, Column],
    achieved: date | str,
    org_column: str = "GP_Code",
    count_column: str = "Appointments",
) -> DataFrame:
    """Total of each measure for every organisation seen, as one row per organisation and measure.

    An organisation without a row for a measure gets zero. All measures come from one scan and
    one aggregation, partially summed before its shuffle; nothing is joined back.
    """
    names = {label: f"measure_{number}" for number, label in enumerate(measures)}
    aggregates = []
    for label, condition in measures.items():
        aggregates += [
            F.count_if(condition).alias(f"{names[label]}_rows"),
            F.sum(F.when(condition, F.col(count_column))).alias(names[label]),
        ]
    totals = activity.groupBy(F.col(org_column).alias("ORG_ID")).agg(*aggregates)
    cells = F.explode(F.array(*[
        F.struct(
            F.lit(label).alias("label"),
            F.when(F.col(f"{name}_rows") == 0, F.lit(0)).otherwise(F.col(name)).alias("total"),
        )
        for label, name in names.items()
    ])).alias("cell")
    return totals.select("ORG_ID", cells).select(
        "ORG_ID",
        F.col("cell.total").cast("string").alias("ATTRIBUTE_VALUE"),
        F.col("cell.label").alias("FRIENDLY_IDENTIFIER"),
        F.lit(as_date(achieved)).alias("ACHIEVEMENT_DATE"),
    )


def zero_fill(totals: DataFrame, universe: DataFrame, key: str, value: str) -> DataFrame:
    """Totals for every member of a universe, zero where it has no row."""
    zero = F.lit(0).cast(totals.schema[value].dataType)
    return (
        universe.join(totals.withColumn("present", F.lit(True)), key, "left")
        .withColumn(value, F.when(F.col("present"), F.col(value)).otherwise(zero))
        .drop("present")
    )
