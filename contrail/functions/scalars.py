"""Column-expression helpers. All are built-in Spark expressions (codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The cancelled flag as the on-time files write it.
CANCELLED_FLAG = "1.00"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: str | Column, digits: int = 2) -> Column:
    """Round halves toward +infinity: -0.125 -> -0.12, 0.125 -> 0.13.

    Spark's ``round`` rounds halves away from zero, which differs for negatives.
    """
    scale = 10 ** digits
    return F.floor(col(c) * F.lit(scale) + F.lit(0.5)) / F.lit(float(scale))


def present(c: str | Column) -> Column:
    """True when a field holds a value: not null, and not the empty string."""
    c = col(c)
    return c.isNotNull() & (F.length(c.cast("string")) > 0)


def unquote(c: str | Column) -> Column:
    """Remove every double quote from a string field."""
    return F.translate(col(c), '"', "")


def is_cancelled(c: str | Column = "cancelled") -> Column:
    return F.coalesce(col(c) == F.lit(CANCELLED_FLAG), F.lit(False))


def short_number(c: str | Column) -> Column:
    """Render a number with at most two decimals and no trailing zeros
    (2.50 -> '2.5', 3.00 -> '3', -0.12 -> '-0.12')."""
    two = F.format_string("%.2f", col(c))
    return F.regexp_replace(F.regexp_replace(two, r"0+$", ""), r"\.$", "")


def pair_text(first: str | Column, second: str | Column) -> Column:
    """Text of an ordered pair: ``(first, second)``."""
    return F.format_string("(%s, %s)", col(first), col(second))


def named_value(name: str | Column, value: str | Column) -> Column:
    """``name(value)`` with the value as :func:`short_number`."""
    return F.concat(col(name), F.lit("("), short_number(value), F.lit(")"))


def fields_after_trailing_cut(line: str | Column, sep: str = "|") -> Column:
    """Number of fields in a delimited line once trailing empty fields are cut
    (what a split that drops trailing empties returns: ``""`` gives 1 field,
    ``"|||"`` gives 0). Built from codegen'd string functions only."""
    trimmed = F.rtrim(col(line), F.lit(sep))
    return (
        F.when(trimmed != F.lit(""), F.size(F.split(trimmed, "\\" + sep)))
        .when(col(line) == F.lit(""), F.lit(1))
        .otherwise(F.lit(0))
        .cast("int")
    )


def delay_minutes(c: str | Column) -> Column:
    """Minutes late, early departures or arrivals counted as 0; null stays null."""
    return F.when(col(c).isNull(), F.lit(None).cast("double")).otherwise(F.greatest(col(c), F.lit(0.0)))


def delayed_15(c: str | Column) -> Column:
    """1.0 when at least 15 minutes late, else 0.0; null stays null."""
    return F.when(col(c).isNull(), F.lit(None).cast("double")).otherwise(
        F.when(col(c) >= 15, F.lit(1.0)).otherwise(F.lit(0.0))
    )
