"""Row filters: field-count guard, required fields, cancelled flights, header rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import types as T

from contrail.functions.scalars import is_cancelled, present
from contrail.schemas import CLEAN_COLUMNS


def has_value(df: DataFrame, name: str) -> Column:
    """Presence test for a column of ``df``: strings must also be non-empty;
    other types only non-null (no per-row conversion to text)."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return present(name)
    return F.col(name).isNotNull()


def min_fields(df: DataFrame, n: int, layout: list[str] = CLEAN_COLUMNS) -> DataFrame:
    """Keep rows that would have at least ``n`` fields after trailing empty
    fields are cut from their delimited line: some field at position >= n-1
    of ``layout`` holds a value."""
    tail = layout[n - 1:]
    if not tail:
        return df
    return df.filter(reduce(lambda a, b: a | b, [has_value(df, c) for c in tail]))


def require(df: DataFrame, *cols: str) -> DataFrame:
    """Keep rows whose given fields are all non-null (and non-empty text)."""
    if not cols:
        return df
    return df.filter(reduce(lambda a, b: a & b, [has_value(df, c) for c in cols]))


def exclude_cancelled(df: DataFrame, flag_col: str = "cancelled") -> DataFrame:
    return df.filter(~is_cancelled(flag_col))


# The date every real row is after (header lines fail it), and the
# lookup files' header code.
DATE_FLOOR = "1900-01-01"
LOOKUP_HEADER = "Code"


def after_date(df: DataFrame, date_col: str = "flight_date", floor: str = DATE_FLOOR) -> DataFrame:
    """Keep rows dated after ``floor``; header lines and null dates drop out."""
    return df.filter(F.col(date_col) > F.lit(dt.date.fromisoformat(floor)))


def not_header(df: DataFrame, code_col: str = "code", header: str = LOOKUP_HEADER) -> DataFrame:
    return df.filter(F.col(code_col) != F.lit(header))
