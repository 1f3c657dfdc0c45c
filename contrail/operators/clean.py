"""ETL: raw rows to the clean layout, lookup cleaning and enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions.scalars import unquote
from contrail.operators.filters import after_date, not_header
from contrail.operators.joins import fits_broadcast, lookup_left_join, unique_by_key
from contrail.schemas import CLEAN_FLIGHTS, RAW_TO_CLEAN, RAW_TO_LEG


def project_clean(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Raw on-time rows (all strings) to the typed 10-column clean layout.

    Drops rows without a valid date (headers included); unparseable numbers
    fail the job when ``strict`` and become null otherwise.
    """
    return _project_raw(raw, RAW_TO_CLEAN, strict)


def project_legs(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Raw on-time rows to the 11 typed leg columns, the minutes late and the
    15-minute flags as the files have them; otherwise like :func:`project_clean`."""
    return _project_raw(raw, RAW_TO_LEG, strict)


def _project_raw(raw: DataFrame, columns: list[tuple[str, str]], strict: bool) -> DataFrame:
    cast = (lambda c, t: c.cast(t)) if strict else (lambda c, t: c.try_cast(t))
    types = {f.name: f.dataType for f in CLEAN_FLIGHTS.fields}
    cols = []
    for raw_name, name in columns:
        c = F.nullif(F.trim(unquote(F.col(raw_name))), F.lit(""))
        kind = types[name].simpleString() if name in types else "double"
        if name == "flight_date":
            c = c.try_cast("date")  # header text and junk dates drop below
        elif kind != "string":
            c = cast(c, kind)
        cols.append(c.alias(name))
    return after_date(raw.select(*cols), "flight_date")


def clean_lookup(raw: DataFrame, code: str = "code", description: str = "description") -> DataFrame:
    """Lookup ``(code, description)``: header row dropped, quotes stripped from
    the code, commas in the description replaced by spaces, one row per code."""
    rows = not_header(raw, code).select(
        unquote(F.col(code)).alias("code"),
        F.replace(F.col(description), F.lit(","), F.lit(" ")).alias("description"),
    )
    return unique_by_key(rows.filter(F.col("code").isNotNull() & (F.col("code") != "")))


def enrich(
    flights: DataFrame,
    airports: DataFrame,
    airlines: DataFrame,
    max_lookup_rows: int | None = None,
    lookups_unique: bool = False,
) -> DataFrame:
    """Left-join airport names for both ends and the airline name.

    Lookups are made unique by code first (skipped when ``lookups_unique``,
    e.g. for the output of :func:`clean_lookup`), so every flight keeps
    exactly one row; they are broadcast when their size is proven small, and
    joined with a salted shuffle otherwise (a hub airport stays spread).
    """
    unique = (lambda df: df) if lookups_unique else unique_by_key
    ap, al = unique(airports), unique(airlines)
    o = ap.select(F.col("code").alias("_o_code"), F.col("description").alias("origin_name"))
    d = ap.select(F.col("code").alias("_d_code"), F.col("description").alias("dest_name"))
    a = al.select(F.col("code").alias("_a_code"), F.col("description").alias("airline_name"))
    ap_fits = fits_broadcast(ap, max_lookup_rows)  # one check serves both airport roles
    out = after_date(flights, "flight_date")
    out = lookup_left_join(out, o, "origin", "_o_code", max_lookup_rows, fits=ap_fits)
    out = lookup_left_join(out, d, "dest", "_d_code", max_lookup_rows, fits=ap_fits)
    out = lookup_left_join(out, a, F.col("airline_id").cast("string"), "_a_code", max_lookup_rows)
    return out.drop("_o_code", "_d_code", "_a_code")
