"""Inputs several queries share, in the shape the engine expects."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from ratesmith.functions.bands import age_key_names
from ratesmith.functions.period import ReportingPeriod
from ratesmith.operators import cohort, mapping, population
from ratesmith.sources import scans
from ratesmith.sources.workspace import new_path
from registry.views import REPORT_DATE, Tables

PERIOD = ReportingPeriod.parse(REPORT_DATE)
CREATED_AT = datetime(2001, 1, 5, 9, 30)
EARLIER = datetime(2000, 12, 5, 9, 30)


def stamp_text(df: DataFrame) -> DataFrame:
    """Batch stamps as text, which both engines print alike."""
    return df.withColumn("CREATED_AT", F.date_format("CREATED_AT", "yyyy-MM-dd HH:mm:ss"))


def episodes(t: Tables) -> DataFrame:
    return scans.episodes(t["fx_episode_table"])


def current_cohort(t: Tables) -> DataFrame:
    return cohort.cohort_rows(episodes(t), PERIOD.start, PERIOD.end, PERIOD.month_start)


def baseline_cohort(t: Tables) -> DataFrame:
    return cohort.cohort_rows(
        episodes(t), PERIOD.baseline_start, PERIOD.baseline_end, PERIOD.baseline_month_start
    )


def practice_mapping(t: Tables) -> DataFrame:
    return mapping.mapping_as_of(t["fx_mapping_history"], PERIOD.end)


_wide_tables: dict[tuple, str] = {}


def _state(t: Tables, *tables: str) -> tuple:
    """Names, lengths and times of the files of given tables."""
    hadoop, configuration = t.spark._jvm.org.apache.hadoop.fs, t.spark._jsc.hadoopConfiguration()
    found = []
    for name in tables:
        path = hadoop.Path(f"{t.folder}/{name}.parquet")
        found += [(status.getPath().toString(), status.getLen(), status.getModificationTime())
                  for status in path.getFileSystem(configuration).listStatus(path)]
    return tuple(sorted(found))


def wide_list_size(t: Tables) -> DataFrame:
    """The wide population table as stored input, written once per session and state of its source."""
    key = (t.spark.sparkContext.applicationId, _state(t, "lineitem"))
    if key not in _wide_tables:
        path = new_path(t.spark, "wide_list_size")
        _pivoted_list_size(t).write.parquet(path)
        _wide_tables[key] = path
    return t.spark.read.parquet(_wide_tables[key])


def _pivoted_list_size(t: Tables) -> DataFrame:
    """Population snapshots with one column per sex and year of age, and two admin columns."""
    long = t["fx_list_size_snapshots"].withColumn(
        "key", F.concat_ws("_", "SEX", "AGE_FROM", F.col("AGE_FROM") + 1)
    )
    keys = age_key_names()
    wide = long.groupBy("PRACTICE_CODE", "EXTRACT_DATE").pivot("key", keys).agg(F.sum("val"))
    return wide.fillna(0, keys).withColumns({
        "GP_PATIENT_LIST_KEY": F.concat_ws("-", "PRACTICE_CODE", "EXTRACT_DATE"),
        "SYSTEM_CREATED_DATE": F.col("EXTRACT_DATE"),
    })


def register_rows(t: Tables) -> DataFrame:
    return t["fx_practice_register"]


def network_bands(t: Tables, practices: DataFrame) -> DataFrame:
    """Population of every network on the three dates of a run."""
    days = [PERIOD.month_start, PERIOD.baseline_month_start, PERIOD.start]
    return population.network_bands(wide_list_size(t), practices, days, register_rows(t))


def appointments(t: Tables) -> DataFrame:
    return scans.appointments(t["fx_appointments"], PERIOD)


def published(t: Tables, created_at: datetime = EARLIER) -> DataFrame:
    return t["fx_published"].withColumn("CREATED_AT", F.lit(created_at).cast("timestamp"))


def late_batch(t: Tables, created_at: datetime = CREATED_AT) -> DataFrame:
    return t["fx_late_batch"].withColumn("CREATED_AT", F.lit(created_at).cast("timestamp"))
