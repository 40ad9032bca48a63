"""Reporting calendar, as a value object for job parameters and as column expressions."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, functions as F

FIRST_MONTH = 4  # financial years start on 1 April


def _year_earlier(day: date) -> date:
    try:
        return day.replace(year=day.year - 1)
    except ValueError:  # 29 February
        return day.replace(year=day.year - 1, day=28)


@dataclass(frozen=True)
class ReportingPeriod:
    """Financial year to date, ending on the last day of a month."""

    end: date

    def __post_init__(self):
        if (self.end + timedelta(days=1)).day != 1:
            raise ValueError(f"{self.end} is not the last day of a month")

    @classmethod
    def parse(cls, text: str) -> ReportingPeriod:
        """Period ending on an ISO date given as text."""
        return cls(date.fromisoformat(text))

    @classmethod
    def before(cls, run_date: date) -> ReportingPeriod:
        """Period ending with the last complete month before a run date."""
        return cls(run_date.replace(day=1) - timedelta(days=1))

    @property
    def start(self) -> date:
        year = self.end.year if self.end.month >= FIRST_MONTH else self.end.year - 1
        return date(year, FIRST_MONTH, 1)

    @property
    def month_start(self) -> date:
        return self.end.replace(day=1)

    @property
    def baseline_end(self) -> date:
        """One calendar year earlier; after a leap year this need not be a month end."""
        return _year_earlier(self.end)

    @property
    def baseline_start(self) -> date:
        return _year_earlier(self.start)

    @property
    def baseline_month_start(self) -> date:
        return _year_earlier(self.month_start)

    @property
    def year_label(self) -> str:
        """Two-digit start years of the baseline and the current financial year, e.g. 2122."""
        return f"{self.baseline_start:%y}{self.start:%y}"


def financial_year_start(day: Column) -> Column:
    shifted = F.add_months(day, 1 - FIRST_MONTH)
    return F.make_date(F.year(shifted), F.lit(FIRST_MONTH), F.lit(1))


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def year_earlier(day: Column) -> Column:
    return F.add_months(day, -12)


def is_month_end(day: Column) -> Column:
    return day == F.last_day(day)


def year_label(day: Column) -> Column:
    start = financial_year_start(day)
    return F.concat(F.date_format(year_earlier(start), "yy"), F.date_format(start, "yy"))


def last_complete_month_end(run_date: Column) -> Column:
    return F.last_day(F.add_months(run_date, -1))


def calendar_columns(day: Column) -> dict[str, Column]:
    """Every field of `ReportingPeriod`, for a date column."""
    return {
        "is_month_end": is_month_end(day),
        "fy_start": financial_year_start(day),
        "month_start": month_start(day),
        "baseline_end": year_earlier(day),
        "baseline_fy_start": year_earlier(financial_year_start(day)),
        "baseline_month_start": year_earlier(month_start(day)),
        "year_label": year_label(day),
    }


def as_date(value: date | str) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)
