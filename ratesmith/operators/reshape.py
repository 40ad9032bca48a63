"""Wide-to-long reshaping of population tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from ratesmith.functions.bands import band_name, parse_age_key

NO_BAND = "(no band)"


def value_columns(wide: DataFrame, ids: Sequence[str]) -> list[str]:
    """All columns but the ids; they must share one type."""
    known = {name.lower() for name in ids}
    rest = [(name, dtype) for name, dtype in wide.dtypes if name.lower() not in known]
    kinds = {dtype for _, dtype in rest}
    if len(kinds) != 1:
        raise ValueError(f"value columns must have one type, found {sorted(kinds)}")
    return [name for name, _ in rest]


def unpivot_counts(wide: DataFrame, ids: Sequence[str]) -> DataFrame:
    """One (key, val) row per value column."""
    return wide.unpivot(list(ids), value_columns(wide, ids), "key", "val")


def five_year_band(name: str) -> str | None:
    parsed = parse_age_key(name)
    return None if parsed is None else band_name(*parsed)


def _null_safe_total(columns: Sequence[str]) -> str:
    """Sum that ignores NULLs and is NULL only if every part is."""
    quoted = [f"`{name}`" for name in columns]
    total = " + ".join(f"coalesce({name}, 0)" for name in quoted)
    return f"CASE WHEN coalesce({', '.join(quoted)}) IS NOT NULL THEN {total} END"


def totals_by_band(
    wide: DataFrame,
    ids: Sequence[str],
    groups: Sequence[str],
    band_column: str,
    value_column: str,
    band_of: Callable[[str], str | None] = five_year_band,
) -> DataFrame:
    """Totals per group and band, as one row per band.

    The columns of a band are added up inside the wide row, then over the rows of a group, and
    only the group totals are turned into rows. A wide row therefore costs at most one shuffled
    row instead of one per column. Columns without a band share the NULL band.
    """
    members: dict[str, list[str]] = {}
    for name in value_columns(wide, ids):
        members.setdefault(band_of(name) or NO_BAND, []).append(name)
    bands = list(members)
    folded = wide.select(
        *groups, *[F.expr(_null_safe_total(members[band])).alias(band) for band in bands]
    )
    totals = folded.groupBy(*groups).agg(
        *[F.expr(f"sum(`{band}`) AS `{band}`") for band in bands]
    )
    return totals.unpivot(list(groups), bands, band_column, value_column).withColumn(
        band_column, F.nullif(band_column, F.lit(NO_BAND))
    )
