"""Typed scans of the source tables. Names in, DataFrames out; nothing is read eagerly."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratesmith.functions.period import ReportingPeriod
from ratesmith.operators.filters import keep_period

# Fixed column names and types of an episode table.
EPISODE_TYPES = {
    "GPPRAC": "string", "EPIKEY": "bigint", "ADMIDATE": "date", "ADMIMETH": "string",
    "EPISTAT": "string", "EPIORDER": "int", "EPITYPE": "string", "STARTAGE": "int",
    "MYDOB": "string", "SEX": "string", "MAINSPEF": "string", "FAE_EMERGENCY": "int",
    "DIAG_3_01": "string", "DIAG_3_CONCAT": "string", "DIAG_4_01": "string",
    "DIAG_4_CONCAT": "string", "OPERTN_3_01": "string",
}

# Fixed column names of an appointment table and the names used for them.
APPOINTMENT_NAMES = {
    "supplier": "Supplier", "gp_code": "GP_Code", "time_between_booking_and_appt": "Wait_Time",
    "context_type": "Context_Type", "appt_status": "Appointment_Status",
    "national_category": "National_Slot_Type", "appt_count": "Appointments",
    "appt_date": "Appointment_Date",
}


def read_table(spark: SparkSession, source: str) -> DataFrame:
    """A catalog table by name, or Parquet files by path."""
    return spark.read.parquet(source) if "/" in source else spark.table(source)


def episodes(table: DataFrame) -> DataFrame:
    """The episode columns with their declared types."""
    return table.select(*[
        F.col(name).cast(dtype).alias(name) for name, dtype in EPISODE_TYPES.items()
    ])


def appointments(table: DataFrame, period: ReportingPeriod) -> DataFrame:
    """Appointments of the financial year to date under their working names."""
    columns = [F.col(old).alias(new) for old, new in APPOINTMENT_NAMES.items()]
    return keep_period(table, "appt_date", period.start, period.end).select(*columns)


def published_subset(table: DataFrame, attribute_ids: Sequence[str]) -> DataFrame:
    """Published rows of the given attributes."""
    return table.where(F.col("ATTRIBUTE_IDENTIFIER").isin(list(attribute_ids)))


def latest_month(table: DataFrame, column: str = "ACHIEVEMENT_DATE") -> DataFrame:
    """Rows of the latest date, found by one aggregate and no window."""
    return table.where(F.col(column) == table.agg(F.max(column).alias("latest")).scalar())
