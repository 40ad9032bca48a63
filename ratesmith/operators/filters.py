"""Row predicates. SQL three-valued logic applies: a NULL never satisfies any of them."""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import date
from decimal import Decimal, InvalidOperation

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ratesmith.functions.period import as_date


def _number(value) -> Decimal | None:
    """Any spelling of a finite number, or None."""
    try:
        number = Decimal(str(value).strip())
    except InvalidOperation:
        return None
    return number if number.is_finite() else None


def _literals(values: Sequence, dtype: T.DataType) -> list:
    """Values as literals of the column's own type, so the filter reaches the scan uncast.

    A fraction or a code with letters equals no whole number and is left out for integer columns.
    """
    if isinstance(dtype, T.IntegralType):
        numbers = [_number(value) for value in values]
        return [int(n) for n in numbers if n is not None and n == int(n)]
    if isinstance(dtype, T.FractionalType):
        return [float(value) for value in values]
    return [str(value) for value in values]


def listed(df: DataFrame, column: str, values: Sequence) -> Column:
    return F.col(column).isin(_literals(values, df.schema[column].dataType))


def keep_listed(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(listed(df, column, values))


def drop_listed(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows whose value is known and not in the list."""
    return df.where(~listed(df, column, values) & F.col(column).isNotNull())


def keep_between(df: DataFrame, column: str, limits: Sequence) -> DataFrame:
    """Rows within inclusive limits; NaN counts as larger than every number."""
    if len(limits) != 2:
        raise ValueError("limits must be a lower and an upper bound")
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.IntegralType):
        numbers = [_number(limit) for limit in limits]
        if None in numbers:
            raise ValueError(f"limits of an integer column must be numbers: {limits!r}")
        low, high = math.ceil(numbers[0]), math.floor(numbers[1])
    else:
        low, high = _literals(limits, dtype)
    return df.where(F.col(column).between(low, high))


def keep_period(df: DataFrame, column: str, start: date | str, end: date | str) -> DataFrame:
    """Rows dated from start to end, both included."""
    return df.where(F.col(column).between(F.lit(as_date(start)), F.lit(as_date(end))))


def drop_prefixed(df: DataFrame, column: str, prefixes: Sequence[str]) -> DataFrame:
    """Rows whose value is known and starts with none of the prefixes."""
    kept = F.col(column).isNotNull()
    for prefix in prefixes:
        kept = kept & ~F.col(column).startswith(prefix)
    return df.where(kept)
