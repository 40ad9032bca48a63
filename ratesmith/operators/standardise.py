"""Direct standardisation of event counts to a standard population."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ratesmith.functions.bands import (
    AGE_TOP,
    SEXES,
    age_text,
    band,
    band_names,
    band_of_age_text,
)
from ratesmith.operators.mapping import network_names

CASE_COLUMNS = [
    "PRACTICE_CODE", "EPIKEY", "AGE", "SEX", "FAE_EMERGENCY", "EXTRACT_DATE", "RPSD",
]


def _cases(cohort: DataFrame) -> DataFrame:
    return cohort.select(
        F.col("GPPRAC").alias("PRACTICE_CODE"),
        "EPIKEY",
        F.col("STARTAGE").alias("AGE"),
        "SEX",
        "FAE_EMERGENCY",
        F.col("RP_month_start").alias("EXTRACT_DATE"),
        "RPSD",
    )


def cases_by_network(cohort: DataFrame, mapping: DataFrame) -> DataFrame:
    """Distinct cases with their network, and one empty row per practice without any.

    An outer join from the mapping could not be split where one practice holds most of the
    cases, nor could the mapping be broadcast to it, so the matched and the unmatched part are built
    separately. The second one reads a single column of the cohort, which shrinks to its practices
    in the map tasks. The mapping, read on both sides, should be a written table.
    """
    cases = _cases(cohort)
    members = mapping.select("PRACTICE_CODE", "PCN_CODE", "PCN_NAME")
    matched = cases.distinct().join(members, "PRACTICE_CODE")
    seen = cases.select("PRACTICE_CODE").distinct()
    unmatched = members.join(seen, "PRACTICE_CODE", "left_anti").select("PCN_CODE", "PCN_NAME")
    return matched.unionByName(unmatched.distinct(), allowMissingColumns=True)


def practice_totals(cohort: DataFrame) -> DataFrame:
    """Emergency admissions per practice, sex and age: at most 192 rows per practice.

    De-duplication and this total are the only steps that see single episodes; all joins come
    after them. Emptied keys cannot match a practice, so they are left out.
    """
    return (
        _cases(cohort)
        .where(F.col("PRACTICE_CODE").isNotNull())
        .distinct()
        .groupBy("PRACTICE_CODE", "SEX", "AGE")
        .agg(F.sum("FAE_EMERGENCY").alias("admissions"))
    )


def admission_cells(cohort: DataFrame, mapping: DataFrame) -> DataFrame:
    """Admissions per network and 5-year band; cases outside the age reference have no band."""
    members = mapping.select("PRACTICE_CODE", "PCN_CODE")
    return (
        practice_totals(cohort)
        .join(members, "PRACTICE_CODE")
        .withColumn("AGE_FIVE_YEAR", band_of_age_text(F.col("SEX"), F.col("AGE")))
        .groupBy("PCN_CODE", "AGE_FIVE_YEAR")
        .agg(F.sum("admissions").alias("admissions"))
    )


def dense_grid(mapping: DataFrame) -> DataFrame:
    """Every practice with every sex and top-coded age of the reference (192 rows each)."""
    years = F.col("years")
    return (
        mapping.select("PRACTICE_CODE", "PCN_CODE", "PCN_NAME")
        .distinct()
        .withColumn("SEX", F.explode(F.array(*map(F.lit, SEXES))))
        .withColumn("years", F.explode(F.sequence(F.lit(0), F.lit(AGE_TOP))))
        .select(
            "PRACTICE_CODE", "PCN_CODE", "PCN_NAME", "SEX",
            age_text(years).alias("AGE"),
            band(F.col("SEX"), years).alias("AGE_FIVE_YEAR"),
        )
    )


def _network_totals(cohort: DataFrame, mapping: DataFrame) -> DataFrame:
    """Totals per practice, sex and age with the network; one empty row for a practice without any."""
    members = mapping.select("PRACTICE_CODE", "PCN_CODE")
    return members.join(practice_totals(cohort), "PRACTICE_CODE", "left")


def admissions_by_band(cohort: DataFrame, mapping: DataFrame) -> DataFrame:
    """Admissions of every network in every band, zero where there are none.

    A network's bands are one map, and become rows from the list of all bands last, so the mapping
    is read once and no grid is joined.
    """
    by_band = (
        _network_totals(cohort, mapping)
        .withColumn("AGE_FIVE_YEAR", band_of_age_text(F.col("SEX"), F.col("AGE")))
        .groupBy("PCN_CODE", "AGE_FIVE_YEAR")
        .agg(F.sum("admissions").alias("admissions"))
    )
    counted = F.when(F.col("AGE_FIVE_YEAR").isNotNull(), F.struct("AGE_FIVE_YEAR", "admissions"))
    bands = F.array(*map(F.lit, band_names()))
    return (
        by_band.groupBy("PCN_CODE")
        .agg(F.map_from_entries(F.collect_list(counted)).alias("counts"))
        .select("PCN_CODE", "counts", F.explode(bands).alias("AGE_FIVE_YEAR"))
        .select("PCN_CODE", "AGE_FIVE_YEAR",
                F.coalesce(F.element_at("counts", F.col("AGE_FIVE_YEAR")), F.lit(0)).alias("admissions"))
    )


def admissions_by_network(cohort: DataFrame, mapping: DataFrame) -> DataFrame:
    """Admissions of every network, zero where there are none."""
    return _network_totals(cohort, mapping).groupBy("PCN_CODE").agg(
        F.coalesce(F.sum("admissions"), F.lit(0)).alias("admissions"))


def standardise_counts(
    units: DataFrame,
    events: DataFrame,
    population: DataFrame,
    standard: DataFrame,
    unit: str,
    stratum: str,
) -> DataFrame:
    """Directly standardised rate of each listed unit.

    `units` lists the units, `events` holds `events` and `population` holds `population` per unit
    and stratum, `standard` holds `standard` per stratum. The three unit tables are stacked and
    added up once per cell and once per unit, so no join sees more than the cells. A stratum
    contributes nothing if its unit population or its standard population is missing or zero;
    `strata_skipped` counts those that hold population.
    """
    blank = F.lit(None).cast("bigint")
    stacked = reduce(DataFrame.unionByName, [
        units.select(unit, F.lit(None).cast("string").alias(stratum),
                     F.lit(0).cast("bigint").alias("events"), blank.alias("population"),
                     F.lit(False).alias("peopled"), F.lit(True).alias("wanted")),
        events.select(unit, stratum, F.col("events").cast("bigint"), blank.alias("population"),
                      F.lit(False).alias("peopled"), F.lit(False).alias("wanted")),
        population.select(unit, stratum, blank.alias("events"),
                          F.col("population").cast("bigint"),
                          F.lit(True).alias("peopled"), F.lit(False).alias("wanted")),
    ])
    cells = stacked.groupBy(unit, stratum).agg(
        F.coalesce(F.sum("events"), F.lit(0)).alias("events"),
        F.sum("population").alias("population"),
        F.max("peopled").alias("peopled"),
        F.max("wanted").alias("wanted"),
    )
    weights = standard.select(stratum, "standard")
    share = F.when(
        F.col("peopled"),
        F.try_divide(F.col("events").cast("double") * F.col("standard"), F.col("population")),
    )
    total = standard.agg(F.sum("standard").alias("standard_total")).scalar()
    return (
        cells.join(weights, stratum, "left")
        .withColumn("share", share)
        .groupBy(unit)
        .agg(
            F.sum("events").alias("events"),
            F.sum("share").alias("expected"),
            F.sum("population").alias("population"),
            F.count_if(F.col("peopled") & F.col("share").isNull()).alias("strata_skipped"),
            F.max("peopled").alias("peopled"),
            F.max("wanted").alias("wanted"),
        )
        .where("wanted")
        .withColumn("standard_total", F.when(F.col("peopled"), total))
        .withColumn("rate", F.col("expected") * F.try_divide(F.lit(1.0), F.col("standard_total")))
        .drop("peopled", "wanted")
    )


def standardised_numerator(
    cohort: DataFrame,
    mapping: DataFrame,
    list_size: DataFrame,
    standard: DataFrame,
    attribute_id: str,
) -> DataFrame:
    """Crude and standardised admissions of every network for one period.

    `list_size` holds the population of one snapshot date.
    """
    rates = standardise_counts(
        units=mapping.select("PCN_CODE").distinct(),
        events=admission_cells(cohort, mapping).withColumnRenamed("admissions", "events"),
        population=list_size.withColumnRenamed("COUNT", "population"),
        standard=standard.withColumnRenamed("Count", "standard"),
        unit="PCN_CODE",
        stratum="AGE_FIVE_YEAR",
    )
    standardised = F.round(F.col("population") * F.col("rate"))
    return rates.select(
        "PCN_CODE",
        F.col("events").alias("admissions"),
        F.col("standard_total").alias("eng_population"),
        F.col("expected").alias("stan_sum"),
        F.col("rate").alias("DSR"),
        F.col("population").alias("pcn_pop"),
        standardised.alias("standardised_admissions"),
        F.try_divide(100 * (standardised - F.col("events")), F.col("events")).alias(
            "percentage_change"
        ),
        F.lit(attribute_id).alias("ATTRIBUTE_ID"),
        F.col("strata_skipped"),
    )


def with_network_names(numerator: DataFrame, mapping: DataFrame) -> DataFrame:
    return numerator.join(network_names(mapping), "PCN_CODE", "left")
