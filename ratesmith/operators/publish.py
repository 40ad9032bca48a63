"""Published long-format rows: shaping, suppression, keyed replacement and archiving.

Everything here is a pure transformation; `ratesmith.sources.sinks` writes the results. A batch
carries one CREATED_AT literal, so that every table and every guard sees the same stamp.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ratesmith.functions.period import as_date
from ratesmith.functions.values import relabel, suppress_small_count, whole_number_text

KEY = ["ORG_ID", "ACHIEVEMENT_DATE", "DATA_REFERENCE_IDENTIFIER", "ATTRIBUTE_IDENTIFIER"]
LONG_COLUMNS = KEY + ["ATTRIBUTE_VALUE", "ATTRIBUTE_TYPE", "CREATED_AT"]
EXPORT_COLUMNS = [
    "ORG_ID", "ACHIEVEMENT_DATE", "FRIENDLY_IDENTIFIER", "DATA_REFERENCE_IDENTIFIER",
    "ATTRIBUTE_IDENTIFIER", "ATTRIBUTE_VALUE", "ATTRIBUTE_TYPE", "CREATED_AT",
]
PUBLICATION_COLUMNS = [
    "ORGANISATION_TYPE", "ORGANISATION_CODE", "ORGANISATION_NAME", "QUALITY_SERVICE", "ACH_DATE",
    "IND_CODE", "MEASURE", "VALUE",
]


def stamp(created_at: datetime) -> Column:
    return F.lit(created_at).cast("timestamp")


def long_rows(
    table: DataFrame,
    org_column: str,
    achieved: date | str,
    labels: Mapping[str, str],
    value_column: str,
    codes: DataFrame,
    created_at: datetime,
) -> DataFrame:
    """Totals per organisation and attribute as published text values."""
    totals = (
        table.select(
            F.col(org_column).alias("ORG_ID"),
            relabel(F.col("Attribute_ID"), labels).alias("ATTRIBUTE_IDENTIFIER"),
            F.col(value_column).alias("value"),
        )
        .groupBy("ORG_ID", "ATTRIBUTE_IDENTIFIER")
        .agg(whole_number_text(F.sum("value")).alias("ATTRIBUTE_VALUE"))
    )
    return (
        totals.join(codes, "ATTRIBUTE_IDENTIFIER", "left")
        .withColumns({
            "ACHIEVEMENT_DATE": F.lit(as_date(achieved)),
            "ATTRIBUTE_TYPE": F.lit("int"),
            "CREATED_AT": stamp(created_at),
        })
        .select(*LONG_COLUMNS)
    )


def publication_rows(
    table: DataFrame,
    org_type: str,
    org_column: str,
    name_column: str,
    year_label: str,
    achieved: date | str,
    indicator_code: str,
    labels: Mapping[str, str],
    value_column: str,
    created_at: datetime,
) -> DataFrame:
    """Totals per organisation and measure with their publication labels."""
    totals = (
        table.select(
            F.col(org_column).alias("ORGANISATION_CODE"),
            F.col(name_column).alias("ORGANISATION_NAME"),
            relabel(F.col("Attribute_ID"), labels).alias("MEASURE"),
            F.col(value_column).alias("value"),
        )
        .groupBy("ORGANISATION_CODE", "ORGANISATION_NAME", "MEASURE")
        .agg(F.sum("value").cast("double").alias("VALUE"))
    )
    return totals.withColumns({
        "ORGANISATION_TYPE": F.lit(org_type),
        "QUALITY_SERVICE": F.lit(f"NCD{year_label}"),
        "ACH_DATE": F.lit(as_date(achieved).isoformat()),
        "IND_CODE": F.lit(indicator_code),
        "CREATED_AT": stamp(created_at),
    }).select(*PUBLICATION_COLUMNS, "CREATED_AT")


def finish_activity_rows(totals: DataFrame, created_at: datetime) -> DataFrame:
    """Activity totals with identifiers as export rows."""
    return totals.withColumns(
        {"ATTRIBUTE_TYPE": F.lit("int"), "CREATED_AT": stamp(created_at)}
    ).select(*EXPORT_COLUMNS)


def landing_rows(export: DataFrame) -> DataFrame:
    """Export rows as the landing table holds them."""
    return export.drop("FRIENDLY_IDENTIFIER")


def indicator_rows(landing: DataFrame, indicator: str) -> DataFrame:
    return landing.where(F.col("DATA_REFERENCE_IDENTIFIER") == indicator)


def stack(tables: Sequence[DataFrame]) -> DataFrame:
    """All rows of several tables, columns aligned by name to the first."""
    columns = tables[0].columns
    return reduce(DataFrame.unionByName, [table.select(columns) for table in tables])


def suppressed(rows: DataFrame, numerators: Sequence[str]) -> DataFrame:
    """Small-number suppression of the given attributes; all other rows keep their value."""
    value = F.col("ATTRIBUTE_VALUE")
    hidden = F.when(
        F.col("ATTRIBUTE_IDENTIFIER").isin(list(numerators)), suppress_small_count(value)
    ).otherwise(value)
    return rows.withColumn("ATTRIBUTE_VALUE", hidden)


def replace_by_key(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Existing rows whose key is not in the batch, and the batch."""
    dated = existing.withColumn("ACHIEVEMENT_DATE", F.col("ACHIEVEMENT_DATE").cast("date"))
    fresh = batch.withColumn("ACHIEVEMENT_DATE", F.col("ACHIEVEMENT_DATE").cast("date"))
    kept = dated.join(fresh.select(*KEY).distinct(), KEY, "left_anti")
    return kept.unionByName(fresh)


def append_if_newer(archive: DataFrame, batch: DataFrame) -> DataFrame:
    """The archive, and the batch if it is newer than everything archived."""
    newest = archive.agg(F.max("CREATED_AT").alias("at")).scalar()
    arriving = batch.agg(F.max("CREATED_AT").alias("at")).scalar()
    return archive.unionByName(batch.where(newest.isNull() | (arriving > newest)))


def batch_sizes(archive: DataFrame) -> DataFrame:
    return archive.groupBy("CREATED_AT").agg(F.count("*").alias("rows"))


def latest_first(rows: DataFrame) -> DataFrame:
    return rows.orderBy(F.col("ACHIEVEMENT_DATE").desc(), "ORG_ID", "ATTRIBUTE_IDENTIFIER")
