"""Month-on-month quality checks of published tables.

Trend functions return every row with a boolean `breach`; `breaches` keeps the offenders, none
if a check passes. Windows run only over totals: one row per month, or one per organisation and
month.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ratesmith.functions.values import percent_change

DATE, ORG, ATTRIBUTE = "ACHIEVEMENT_DATE", "ORG_ID", "ATTRIBUTE_IDENTIFIER"


def breaches(trend: DataFrame) -> DataFrame:
    return trend.where("breach").drop("breach")


def summary(checks: Mapping[str, DataFrame]) -> DataFrame:
    """One row per check with its number of offending rows."""
    rows = [
        offenders.agg(F.count("*").alias("offenders")).select(
            F.lit(name).alias("check"), "offenders", (F.col("offenders") == 0).alias("passed")
        )
        for name, offenders in checks.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def _value() -> Column:
    return F.col("ATTRIBUTE_VALUE").try_cast("bigint")


def repeated_practices(mapping: DataFrame) -> DataFrame:
    """Practices with more than one row in a mapping that should hold one."""
    return (
        mapping.groupBy("PRACTICE_CODE")
        .agg(F.count("*").alias("mappings"))
        .where(F.col("mappings") > 1)
    )


def attribute_count(published: DataFrame, expected: int) -> DataFrame:
    """Attributes per organisation and month, against the expected number."""
    return (
        published.groupBy(DATE, ORG)
        .agg(F.count(ATTRIBUTE).alias("INDICATOR_COUNT"))
        .withColumn("breach", F.col("INDICATOR_COUNT") != expected)
    )


def numerator_share(published: DataFrame, numerator: str, denominator: str) -> DataFrame:
    """Numerator and denominator side by side; the first must not exceed the second."""
    return (
        published.where(F.col(ATTRIBUTE).isin(numerator, denominator))
        .groupBy(ORG, DATE)
        .pivot(ATTRIBUTE, [numerator, denominator])
        .agg(F.sum(_value()))
        .withColumnsRenamed({numerator: "numerator", denominator: "denominator"})
        .withColumn(
            "perc_of_denominator", F.try_divide("numerator", F.col("denominator")) * 100
        )
        .withColumn(
            "breach", F.coalesce(F.col("numerator") > F.col("denominator"), F.lit(False))
        )
    )


def organisation_count(published: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """Organisations per month; the latest month must stay within the tolerance in %."""
    counts = published.groupBy(DATE).agg(F.count_distinct(ORG).alias("TOTAL_PRAC_COUNT"))
    return _organisation_trend_of_months(counts, tolerance)


def _organisation_trend_of_months(counts: DataFrame, tolerance: float) -> DataFrame:
    by_month = Window.orderBy(DATE)  # one row per month
    trend = counts.withColumns({
        "prev_month_value": F.lag("TOTAL_PRAC_COUNT").over(by_month),
        "is_latest": F.lead(DATE).over(by_month).isNull(),
    })
    change = _change("TOTAL_PRAC_COUNT")
    return trend.withColumn("perc_change", change).withColumn(
        "breach",
        F.col("is_latest")
        & ~F.coalesce(F.abs("perc_change") < tolerance, F.lit(False)),
    )


SKETCH_BITS = 12


def organisation_sketches(published: DataFrame, bits: int = SKETCH_BITS) -> DataFrame:
    """One sketch of the organisations per month, of at most about 2^bits bytes.

    The relative standard error of a count is about 0.8 / sqrt(2^bits): 1.3 % for 12 bits, below
    which small counts are far.
    """
    return published.groupBy(DATE).agg(F.hll_sketch_agg(ORG, bits).alias("sketch"))


def replace_sketches(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Stored sketches with those of some months replaced."""
    kept = stored.join(fresh.select(F.col(DATE).alias("month")), F.col(DATE).eqNullSafe(F.col("month")), "left_anti")
    return kept.unionByName(fresh)


def all_organisations(sketches: DataFrame) -> DataFrame:
    """Estimated number of different organisations over all months, from the sketches alone."""
    return sketches.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("organisations"))


def organisation_count_from(sketches: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """As `organisation_count`, from stored sketches instead of the published rows."""
    return _organisation_trend_of_months(
        sketches.select(DATE, F.hll_sketch_estimate("sketch").alias("TOTAL_PRAC_COUNT")), tolerance)


def _change(total: str, previous: str = "prev_month_value") -> Column:
    """Change in %: zero for the first month, NULL after a month of zero."""
    step = F.col(total) - F.col(previous)
    return F.when(step.isNull(), 0.0).otherwise(percent_change(F.col(total), F.col(previous)))


def month_total(published: DataFrame, attribute: str) -> DataFrame:
    """Total per month; a cumulative figure must rise except in April."""
    totals = (
        published.where(F.col(ATTRIBUTE) == attribute)
        .groupBy(DATE)
        .agg(F.sum(_value()).alias("TOTAL_ATTRIBUTE_VALUE"))
    )
    by_month = Window.orderBy(DATE)  # one row per month
    return (
        totals.withColumn("prev_month_value", F.lag("TOTAL_ATTRIBUTE_VALUE").over(by_month))
        .withColumn("perc_change", _change("TOTAL_ATTRIBUTE_VALUE"))
        .withColumn(
            "breach",
            (F.month(DATE) != 4) & F.coalesce(F.col("perc_change") <= 0, F.lit(False)),
        )
    )


def _organisation_trend(
    published: DataFrame, attribute: str, total: str, previous: str, change: str
) -> DataFrame:
    totals = (
        published.where(F.col(ATTRIBUTE) == attribute)
        .groupBy(ORG, DATE)
        .agg(F.sum(_value()).alias(total))
    )
    by_month = Window.partitionBy(ORG).orderBy(DATE)  # one row per organisation and month
    moved = totals.withColumn(previous, F.lag(total).over(by_month))
    step = percent_change(F.col(total), F.col(previous))
    return moved.withColumn(change, step).fillna(0, [total, previous, change])


def organisation_total(published: DataFrame, attribute: str) -> DataFrame:
    """Total per organisation and month; it must not fall."""
    return _organisation_trend(
        published, attribute, "TOTAL_ATTRIBUTE_VALUE", "prev_month_value", "perc_change"
    ).withColumn("breach", F.col("perc_change") < 0)


def organisation_total_with_population(
    published: DataFrame, numerator: str, denominator: str, minimum_rise: float = 5.0
) -> DataFrame:
    """As `organisation_total`, reported only where the population rose by the given %."""
    totals = organisation_total(published, numerator).drop("breach")
    population = _organisation_trend(
        published, denominator, "TOTAL_POPULATION", "prev_population", "pop_perc_change"
    )
    return totals.join(population, [ORG, DATE]).withColumn(
        "breach", (F.col("perc_change") < 0) & (F.col("pop_perc_change") >= minimum_rise)
    )
