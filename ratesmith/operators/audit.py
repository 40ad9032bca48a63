"""All month-on-month checks of a published table in one pass.

`cells` reads the table once: totals per organisation, month and attribute, each beside the month
before it, then one row per organisation and month with the figures of every attribute as columns.
Checks are data; whatever their number, their offending rows come from these cells, those that
look at a month's total from one row per month. The single checks in `quality` give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ratesmith.functions.values import percent_change
from ratesmith.operators.quality import ATTRIBUTE, DATE, ORG, _change, _value
from ratesmith.sources.reference import inline_table

#: Columns of offending rows, whatever the check.
OFFENDER = "check string, ORG_ID string, ACHIEVEMENT_DATE date, value double, compared double, change double"
_NAMES = [field.split()[0] for field in OFFENDER.split(", ")]


@dataclass(frozen=True)
class Check:
    """One check; `attribute` and `other` name attributes, `limit` is the number it compares with."""

    name: str
    kind: str
    attribute: str | None = None
    other: str | None = None
    limit: float = 0.0


def attributes(name: str, expected: int) -> Check:
    """Every organisation has so many attributes in a month."""
    return Check(name, "attributes", limit=expected)


def share(name: str, numerator: str, denominator: str) -> Check:
    """The numerator does not exceed the denominator."""
    return Check(name, "share", numerator, denominator)


def organisations(name: str, tolerance: float = 1.0) -> Check:
    """The number of organisations in the latest month stays within so many %."""
    return Check(name, "organisations", limit=tolerance)


def month_total(name: str, attribute: str) -> Check:
    """The cumulative total of a month rises except in April."""
    return Check(name, "month_total", attribute)


def organisation_total(name: str, attribute: str) -> Check:
    """The total of an organisation does not fall."""
    return Check(name, "organisation_total", attribute)


def organisation_total_with_population(
    name: str, numerator: str, denominator: str, minimum_rise: float = 5.0
) -> Check:
    """As `organisation_total`, where the denominator rose by at least so many %."""
    return Check(name, "organisation_total_with_population", numerator, denominator, minimum_rise)


def _used(checks: Sequence[Check]) -> list[str]:
    named = [name for check in checks for name in (check.attribute, check.other) if name]
    return list(dict.fromkeys(named))


def cells(published: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per organisation and month: `rows`, and `here_i`, `total_i`, `before_i` per attribute.

    The windows run over totals: one row per organisation, attribute and month.
    """
    totals = published.groupBy(ORG, DATE, ATTRIBUTE).agg(
        F.count(ATTRIBUTE).alias("rows"), F.sum(_value()).alias("total"))
    by_month = Window.partitionBy(ORG, ATTRIBUTE).orderBy(DATE)
    moved = totals.withColumn("before", F.lag("total").over(by_month))
    figures = [F.sum("rows").alias("rows")]
    for i, name in enumerate(_used(checks)):
        own = F.col(ATTRIBUTE) == name
        figures += [F.count_if(own).alias(f"here_{i}"), F.max(F.when(own, F.col("total"))).alias(f"total_{i}"),
                    F.max(F.when(own, F.col("before"))).alias(f"before_{i}")]
    return moved.groupBy(ORG, DATE).agg(*figures)


def _row(check: Check, org: Column, value: Column, compared: Column, change: Column) -> Column:
    values = (F.lit(check.name), org, F.col(DATE), value, compared, change)
    return F.struct(*(column.cast(field.split()[1]).alias(name)
                      for column, field, name in zip(values, OFFENDER.split(", "), _NAMES)))


def _organisation_rows(found: DataFrame, checks: Sequence[Check], place: dict[str, int]) -> DataFrame:
    """Offending rows of the checks that look at one organisation in one month."""

    def figure(kind: str, name: str) -> Column:
        return F.col(f"{kind}_{place[name]}")

    def fall(name: str) -> tuple[Column, Column, Column]:
        total, before = figure("total", name), figure("before", name)
        zero = F.lit(0)
        return (F.coalesce(total, zero), F.coalesce(before, zero),
                F.coalesce(percent_change(total, before), F.lit(0.0)))

    rows = []
    org = F.col(ORG)
    for check in checks:
        if check.kind == "attributes":
            value, compared, change = F.col("rows"), F.lit(check.limit), F.lit(None)
            breach = F.col("rows") != check.limit
        elif check.kind == "share":
            value, compared = figure("total", check.attribute), figure("total", check.other)
            change, breach = F.try_divide(value, compared) * 100, value > compared
        elif check.kind in ("organisation_total", "organisation_total_with_population"):
            value, compared, change = fall(check.attribute)
            breach = (figure("here", check.attribute) > 0) & (change < 0)
            if check.other:
                breach &= (figure("here", check.other) > 0) & org.isNotNull() & F.col(DATE).isNotNull() & (
                    fall(check.other)[2] >= check.limit)
        else:
            continue
        rows.append(F.when(breach, _row(check, org, value, compared, change)))
    return _exploded(found, rows)


def _exploded(found: DataFrame, rows: list[Column]) -> DataFrame:
    if not rows:
        no_rows = (F.lit(None).cast(field.split()[1]).alias(field.split()[0]) for field in OFFENDER.split(", "))
        return found.where(F.lit(False)).select(*no_rows)
    return found.select(F.explode(F.array_compact(F.array(*rows))).alias("row")).select("row.*")


def _month_rows(found: DataFrame, checks: Sequence[Check], place: dict[str, int]) -> DataFrame:
    """Offending rows of the checks that look at a month's total."""
    figures = [F.count(ORG).alias("organisations")]
    for i in place.values():
        figures += [F.sum(f"here_{i}").alias(f"here_{i}"), F.sum(f"total_{i}").alias(f"total_{i}")]
    months = found.groupBy(DATE).agg(*figures)
    by_month = Window.orderBy(DATE)  # one row per month
    earlier = by_month.rowsBetween(Window.unboundedPreceding, -1)
    rows = []
    for number, check in enumerate(checks):
        no_one = F.lit(None)
        if check.kind == "organisations":
            months = months.withColumns({
                f"previous_{number}": F.lag("organisations").over(by_month),
                f"latest_{number}": F.lead(DATE).over(by_month).isNull()})
            total = "organisations"
        elif check.kind == "month_total":
            i = place[check.attribute]
            total = f"total_{i}"
            # the month before is the last one that has the attribute
            last = F.last(F.when(F.col(f"here_{i}") > 0, F.struct(total)), ignorenulls=True).over(earlier)
            months = months.withColumn(f"previous_{number}", last[total])
        else:
            continue
        change = _change(total, f"previous_{number}")
        if check.kind == "organisations":
            steady = F.coalesce(F.abs(change) < check.limit, F.lit(False))
            breach = F.col(f"latest_{number}") & ~steady
        else:
            breach = (F.month(DATE) != 4) & (F.col(f"here_{place[check.attribute]}") > 0) & F.coalesce(
                change <= 0, F.lit(False))
        rows.append(F.when(breach, _row(check, no_one, F.col(total), F.col(f"previous_{number}"), change)))
    return _exploded(months, rows)


def offenders(found: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Offending rows of all checks; `found` are the cells of the same checks, written or cached."""
    place = {name: i for i, name in enumerate(_used(checks))}
    return _organisation_rows(found, checks, place).unionByName(_month_rows(found, checks, place))


def summary(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per check, those without offending rows too."""
    counts = rows.groupBy("check").agg(F.count("*").alias("offenders"))
    listed = inline_table(rows.sparkSession, ["check"], [(name,) for name in names])
    return listed.join(counts, "check", "left").select(
        "check", F.coalesce("offenders", F.lit(0)).alias("offenders"), F.col("offenders").isNull().alias("passed"))


def as_offenders(name: str, rows: DataFrame, org: str, value: str, compared: str | None = None) -> DataFrame:
    """Offending rows of another check in the common columns; a month is taken over where there is one."""
    dated = rows if DATE in rows.columns else rows.withColumn(DATE, F.lit(None).cast("date"))
    other = F.col(compared) if compared else F.lit(None)
    return dated.select(
        _row(Check(name, "other"), F.col(org), F.col(value), other, F.lit(None)).alias("row")).select("row.*")


def all_offenders(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
