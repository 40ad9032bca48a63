"""Scalar expressions on coded, dated and published values."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F

# Fixed values of disclosure control.
SMALL_COUNT_MAX = 7
ROUNDING_BASE = 5
SUPPRESSED = "*"


def code_set(codes: Column) -> Column:
    """Distinct entries of a comma-separated list; blanks inside entries are kept."""
    return F.array_distinct(F.split(codes, ","))


def sex_name(code: Column) -> Column:
    return F.when(code == "1", "MALE").when(code == "2", "FEMALE").otherwise("UNKNOWN")


def relabel(value: Column, labels: Mapping[str, str]) -> Column:
    """Replace listed values; all others pass through."""
    changed = {old: new for old, new in labels.items() if old != new}
    if not changed:
        return value
    chain = F
    for old, new in changed.items():
        chain = chain.when(value == old, F.lit(new))
    return chain.otherwise(value)


def parse_date(text: Column) -> Column:
    """Date of `2022-01-31` or `20220131`; NULL for anything else."""
    return F.coalesce(F.try_to_date(text, "yyyy-MM-dd"), F.try_to_date(text, "yyyyMMdd"))


def whole_number_text(value: Column) -> Column:
    return F.round(value).cast("bigint").cast("string")


def suppress_small_count(text: Column) -> Column:
    """Disclosure control: zero stays, small counts are starred, others go to the nearest 5."""
    count = F.coalesce(text.cast("bigint"), F.lit(0))
    rounded = F.round(count / ROUNDING_BASE).cast("bigint") * ROUNDING_BASE
    return (
        F.when(count == 0, F.lit("0"))
        .when(F.abs(count) <= SMALL_COUNT_MAX, F.lit(SUPPRESSED))
        .otherwise(rounded.cast("string"))
    )


def percent_change(current: Column, previous: Column) -> Column:
    """Change in % of the previous value; NULL where that is zero or missing."""
    return F.try_divide((current - previous) * 100.0, previous.cast("double"))


def expand_codes(letter: str, prefixes: Iterable[int], count: int) -> list[str]:
    """Letter + prefix + 0..count-1 for every prefix, as a code list for a rule."""
    return [f"{letter}{prefix}{last}" for prefix in prefixes for last in range(count)]
