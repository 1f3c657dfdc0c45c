"""Delimited text lines <-> typed columns, for lines that arrive as a string
column (a text stream, or a text file read with ``spark.read.text``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.functions.scalars import fields_after_trailing_cut, unquote


def to_lines(df: DataFrame, columns: list[str], sep: str = "|", alias: str = "value") -> DataFrame:
    """One delimited line per row; nulls become empty fields."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return df.select(F.concat_ws(sep, *parts).alias(alias))


def parse_lines(
    lines: DataFrame,
    schema: T.StructType,
    sep: str = "|",
    line_col: str = "value",
    strict: bool = True,
    count_alias: str | None = "n_fields",
) -> DataFrame:
    """Split each line at ``sep`` into the fields of ``schema`` by position.

    Quotes are removed and empty fields become null. A missing position is
    null. Bad numbers or dates fail the job when ``strict`` (ANSI cast) and
    become null otherwise (``try_cast``). With ``count_alias`` the number of
    fields left after trailing empty fields are cut is added.
    """
    parts = F.split(F.col(line_col), "\\" + sep)
    cols = []
    for i, field in enumerate(schema.fields):
        raw = F.nullif(unquote(F.try_element_at(parts, F.lit(i + 1))), F.lit(""))
        if isinstance(field.dataType, T.StringType):
            c = raw
        elif strict:
            c = raw.cast(field.dataType)
        else:
            c = raw.try_cast(field.dataType)
        cols.append(c.alias(field.name))
    if count_alias:
        cols.append(fields_after_trailing_cut(F.col(line_col), sep).alias(count_alias))
    return lines.select(*cols)
