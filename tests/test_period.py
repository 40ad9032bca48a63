from datetime import date

import pytest
from pyspark.sql import functions as F

from ratesmith.functions import period
from ratesmith.functions.period import ReportingPeriod


@pytest.mark.parametrize(
    "end, start, baseline_start, baseline_end, month_start, label",
    [
        ("2022-01-31", "2021-04-01", "2020-04-01", "2021-01-31", "2022-01-01", "2021"),
        ("2022-03-31", "2021-04-01", "2020-04-01", "2021-03-31", "2022-03-01", "2021"),
        ("2022-04-30", "2022-04-01", "2021-04-01", "2021-04-30", "2022-04-01", "2122"),
        ("2020-02-29", "2019-04-01", "2018-04-01", "2019-02-28", "2020-02-01", "1819"),
        # a year before the end of February need not be a month end
        ("2025-02-28", "2024-04-01", "2023-04-01", "2024-02-28", "2025-02-01", "2324"),
    ],
)
def test_fields(spark, end, start, baseline_start, baseline_end, month_start, label):
    value = ReportingPeriod.parse(end)
    texts = [value.start, value.baseline_start, value.baseline_end, value.month_start]
    assert [str(day) for day in texts] == [start, baseline_start, baseline_end, month_start]
    assert value.year_label == label
    columns = period.calendar_columns(F.lit(value.end))
    row = spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()
    assert row.is_month_end
    assert (row.fy_start, row.baseline_fy_start) == (value.start, value.baseline_start)
    assert (row.baseline_end, row.month_start) == (value.baseline_end, value.month_start)
    assert row.baseline_month_start == value.baseline_month_start
    assert row.year_label == label


def test_end_must_close_a_month():
    with pytest.raises(ValueError):
        ReportingPeriod.parse("2022-01-30")
    with pytest.raises(ValueError):
        ReportingPeriod.parse("31/01/2022")


@pytest.mark.parametrize(
    "run, end, start",
    [
        (date(2022, 1, 15), date(2021, 12, 31), date(2021, 4, 1)),
        (date(2022, 4, 10), date(2022, 3, 31), date(2021, 4, 1)),
        (date(2022, 5, 1), date(2022, 4, 30), date(2022, 4, 1)),
    ],
)
def test_default_period(run, end, start):
    value = ReportingPeriod.before(run)
    assert (value.end, value.start) == (end, start)
