"""Single years of age and the bands built from them.

Population tables carry one column per sex and year of age, named `SEX_n_n+1`. The band of a
column follows from its name, so bands are computed by rule and need no lookup table.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed values of the age reference.
SEXES = ("FEMALE", "MALE")
YEARS_OF_AGE = 120
AGE_TOP = 95
TOP_BY_WIDTH = {1: 95, 5: 95, 10: 90}

_AGE_KEY = re.compile(r"(FEMALE|MALE)_(\d+)_(\d+)", re.IGNORECASE)


def age_key_names() -> list[str]:
    return [f"{sex}_{age}_{age + 1}" for sex in SEXES for age in range(YEARS_OF_AGE)]


def parse_age_key(name: str) -> tuple[str, int] | None:
    """Sex and age of a population column, or None where the name is not an age key."""
    match = _AGE_KEY.fullmatch(name)
    if match is None:
        return None
    sex, age, end = match[1].upper(), int(match[2]), int(match[3])
    return (sex, age) if end == age + 1 and age < YEARS_OF_AGE else None


def band_name(sex: str, age: int, width: int = 5) -> str:
    top = TOP_BY_WIDTH[width]
    if age >= top:
        return f"{sex}_{top}+"
    low = age - age % width
    return f"{sex}_{low}_{low + max(width - 1, 1)}"


def band_names(width: int = 5) -> list[str]:
    ages = range(0, TOP_BY_WIDTH[width] + 1, width)
    return [band_name(sex, age, width) for sex in SEXES for age in ages]


def age_text(age: Column) -> Column:
    """Age as text with the oldest ages in one open class."""
    return F.when(age >= AGE_TOP, F.lit(f"{AGE_TOP}+")).otherwise(age.cast("string"))


def band(sex: Column, age: Column, width: int = 5) -> Column:
    """Band of a sex and a whole number of years; NULL outside the age reference."""
    top = TOP_BY_WIDTH[width]
    low = age - age % width
    closed = F.concat_ws("_", sex, low.cast("string"), (low + max(width - 1, 1)).cast("string"))
    label = F.when(age >= top, F.concat(sex, F.lit(f"_{top}+"))).otherwise(closed)
    return F.when(sex.isin(*SEXES) & age.between(0, YEARS_OF_AGE - 1), label)


def band_of_age_text(sex: Column, text: Column, width: int = 5) -> Column:
    """Band of a sex and a top-coded age text such as '7' or '95+'."""
    years = F.when(text == f"{AGE_TOP}+", F.lit(AGE_TOP)).otherwise(text.try_cast("int"))
    # Only the exact texts of the age reference count, so '07' or '96' has no band.
    known = (text == f"{AGE_TOP}+") | ((years < AGE_TOP) & (text == years.cast("string")))
    return F.when(known, band(sex, years, width))


def age_reference(spark: SparkSession) -> DataFrame:
    """One row per sex and year of age with its 1-, 5- and 10-year band (240 rows, all text)."""
    age = F.col("id").cast("int")
    grid = spark.range(YEARS_OF_AGE).select(
        F.explode(F.array(*map(F.lit, SEXES))).alias("SEX"), age.alias("years")
    )
    sex, years = F.col("SEX"), F.col("years")
    return grid.select(
        F.concat_ws("_", sex, years.cast("string"), (years + 1).cast("string")).alias("ORIGINAL"),
        sex,
        age_text(years).alias("AGE"),
        band(sex, years, 1).alias("AGE_ONE_YEAR"),
        band(sex, years, 5).alias("AGE_FIVE_YEAR"),
        band(sex, years, 10).alias("AGE_TEN_YEAR"),
    )
