"""Flights, lookups and itineraries derived from the driver's star-schema tables.

The driver tables hold no flights, so a fixed mapping turns every ``lineitem``
row into one flight (see FIXTURES.md section 9):

==============  ==================================================================
flight_date     ship date as a date
airline_id      number after ``Brand#`` of the part's brand
carrier         the part's brand
flight_num      line number as text
cancelled       ``1.00`` for returned-and-final lines, else ``0.00``
origin          supplier's nation name
dest            customer's nation name (through the order)
dep_delay       quantity - 25, missing on cancelled odd lines
arr_delay       quantity - 29 + line number, missing on cancelled lines
dep_time        ``HHMM`` from part and supplier keys, missing on cancelled odd lines
==============  ==================================================================

Only the dimension joins that the requested columns need are planned: every
lineitem row has exactly one order, customer, supplier and part, so a skipped
inner join never changes the rows, and each skipped join is one shuffle of the
fact table less on a cluster.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.functions.scalars import delay_minutes, delayed_15
from contrail.operators.legs import best_connections
from contrail.operators.runtime_filter import semi_join, within_range
from contrail.schemas import CLEAN_COLUMNS, ITINERARY

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


# Declared schemas (the columns used) of the driver tables: the scan needs no
# footer pass to infer them, and reads only these columns.
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "customer": "c_custkey bigint, c_nationkey int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "part": "p_partkey bigint, p_brand string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def literal_table(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small table of literal rows, planned as a local relation in the JVM
    (no Python-side data source)."""
    structs = [F.struct(*[F.lit(v).alias(n) for v, n in zip(r, names)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TABLE_SCHEMAS.get(name)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def _nation_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")


def flights_from_tables(
    spark: SparkSession,
    sf_dir: str,
    columns: list[str] | tuple[str, ...] | None = None,
    days: DataFrame | None = None,
    days_rows: int | None = None,
) -> DataFrame:
    """Flights in the clean layout (or the requested subset of its columns).

    ``days`` (a ``flight_date`` column; ``days_rows`` bounds the rows, if that is known)
    keeps only flights on those days. The restriction is applied to the fact scan, before
    any dimension join, so only those flights are shuffled: the span of the days as a
    runtime filter of the scan, then the days themselves. No job runs here.
    """
    cols = list(columns) if columns else list(CLEAN_COLUMNS)
    unknown = set(cols) - set(CLEAN_COLUMNS)
    if unknown:
        raise ValueError(f"unknown flight columns: {sorted(unknown)}")

    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_returnflag", "l_linestatus", "l_shipdate",
    )
    if days is not None:
        at = li.schema["l_shipdate"].dataType
        day = F.col("flight_date")
        li = within_range(li, F.col("l_shipdate"), days, day.cast(at), F.date_add(day, 1).cast(at))
        li = semi_join(li, days, {"flight_date": F.col("l_shipdate").cast("date")}, days_rows)
    base = li
    nations = _nation_names(spark, sf_dir) if {"origin", "dest"} & set(cols) else None
    if {"airline_id", "carrier"} & set(cols):
        part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
        base = base.join(part, base.l_partkey == part.p_partkey, "inner")
    if "origin" in cols:
        # fact -> supplier, then -> nation: the 25-row nation table is joined last so
        # it is the side that gets broadcast (a pre-joined supplier+nation would be
        # estimated as a product of both sizes and the fact table broadcast instead).
        supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        base = base.join(supplier, base.l_suppkey == supplier.s_suppkey, "inner")
        origin_nation = nations.select(
            F.col("n_nationkey").alias("_s_nation"), F.col("n_name").alias("origin_name")
        )
        base = base.join(origin_nation, base.s_nationkey == origin_nation._s_nation, "inner")
    if "dest" in cols:
        # orders -> customer -> nation first, so the fact table is shuffled once, on
        # order key; nation again joined last so that it is the broadcast side.
        customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        dest_nation = nations.select(
            F.col("n_nationkey").alias("_c_nation"), F.col("n_name").alias("dest_name")
        )
        order_dest = (
            orders.join(customer, orders.o_custkey == customer.c_custkey, "inner")
            .join(dest_nation, F.col("c_nationkey") == dest_nation._c_nation, "inner")
            .select("o_orderkey", "dest_name")
        )
        base = base.join(order_dest, base.l_orderkey == order_dest.o_orderkey, "inner")

    returned_final = lambda: (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    odd_returned = lambda: returned_final() & (F.col("l_linenumber") % 2 == 1)
    expr = {  # built only for the requested columns
        "flight_date": lambda: F.col("l_shipdate").cast("date"),
        "airline_id": lambda: F.substring("p_brand", 7, 100).cast("int"),
        "carrier": lambda: F.col("p_brand"),
        "flight_num": lambda: F.col("l_linenumber").cast("string"),
        "cancelled": lambda: F.when(returned_final(), F.lit("1.00")).otherwise(F.lit("0.00")),
        "origin": lambda: F.col("origin_name"),
        "dest": lambda: F.col("dest_name"),
        "dep_delay": lambda: F.when(odd_returned(), F.lit(None).cast("double")).otherwise(
            (F.col("l_quantity") - 25).cast("double")
        ),
        "arr_delay": lambda: F.when(returned_final(), F.lit(None).cast("double")).otherwise(
            (F.col("l_quantity") - 29 + F.col("l_linenumber")).cast("double")
        ),
        "dep_time": lambda: F.when(odd_returned(), F.lit(None).cast("string")).otherwise(
            F.lpad(((F.col("l_partkey") % 24) * 100 + F.col("l_suppkey") % 60).cast("string"), 4, "0")
        ),
    }
    return base.select(*[expr[c]().alias(c) for c in cols])


def airline_lookup_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airline lookup ``(code, description)``: the distinct (airline id, brand) pairs."""
    part = read_table(spark, sf_dir, "part").select("p_brand")
    return part.select(
        F.substring("p_brand", 7, 100).alias("code"), F.col("p_brand").alias("description")
    ).distinct()


def airport_lookup_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airport lookup ``(code, description)``: nation name, its region name."""
    nation = read_table(spark, sf_dir, "nation").select("n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
        F.col("n_name").alias("code"), F.col("r_name").alias("description")
    )


SECOND_LEG_DAYS = 2

# The two-leg itineraries asked for on the on-time data
# (x, y, z airport codes, first-leg date).
ON_TIME_ITINERARIES = [
    ("CMI", "ORD", "LAX", "2008-03-04"),
    ("JAX", "DFW", "CRP", "2008-09-09"),
    ("SLC", "BFL", "LAX", "2008-04-01"),
    ("DFW", "ORD", "DFW", "2008-06-10"),
    ("BOS", "ATL", "LAX", "2008-04-03"),
    ("PHX", "JFK", "MSP", "2008-09-07"),
    ("DFW", "STL", "ORD", "2008-01-24"),
    ("LAX", "MIA", "LAX", "2008-05-16"),
]


def itineraries_from_codes(spark: SparkSession, rows: list[tuple[str, str, str, str]] = ON_TIME_ITINERARIES) -> DataFrame:
    """Itineraries ``(x, y, z, first_date)`` given as airport codes."""
    if not rows:
        return spark.createDataFrame([], ITINERARY)
    return literal_table(spark, [(x, y, z, dt.date.fromisoformat(d)) for x, y, z, d in rows], ["x", "y", "z", "first_date"])


# Fixed value: how many requests are derived from the driver tables.
REQUESTS = 8


def itineraries_from_tables(spark: SparkSession, sf_dir: str, n: int | None = REQUESTS) -> DataFrame:
    """Itineraries ``(x, y, z, first_date)`` derived from the flights of the driver tables
    (:func:`contrail.operators.legs.best_connections`): the ``n`` best, or all of them. They stay a
    plan: no job runs here, and a query computes the ``n`` best once however often it uses them."""
    flights = flights_from_tables(spark, sf_dir, ["flight_date", "origin", "dest", "arr_delay", "dep_time"])
    return best_connections(flights, SECOND_LEG_DAYS, n)


def raw_rows_from_flights(flights: DataFrame) -> DataFrame:
    """Flights as rows of the raw on-time CSV layout (all strings; fields the
    mapping has no value for stay empty). City names carry a comma, as in the
    real files, so a reader must be quote-aware to keep the columns aligned."""
    from contrail.schemas import RAW_FLIGHT_COLUMNS

    d = F.col("flight_date")
    values = {
        "Year": F.year(d), "Quarter": F.quarter(d), "Month": F.month(d), "DayofMonth": F.dayofmonth(d),
        "DayOfWeek": F.dayofweek(d), "FlightDate": F.date_format(d, "yyyy-MM-dd"),
        "UniqueCarrier": F.col("carrier"), "AirlineID": F.col("airline_id"), "Carrier": F.col("carrier"),
        "FlightNum": F.col("flight_num"), "Origin": F.col("origin"),
        "OriginCityName": F.concat(F.col("origin"), F.lit(", XX")), "Dest": F.col("dest"),
        "DestCityName": F.concat(F.col("dest"), F.lit(", XX")), "DepTime": F.col("dep_time"),
        "DepDelay": F.col("dep_delay"), "DepDelayMinutes": delay_minutes("dep_delay"), "DepDel15": delayed_15("dep_delay"),
        "ArrDelay": F.col("arr_delay"), "ArrDelayMinutes": delay_minutes("arr_delay"), "ArrDel15": delayed_15("arr_delay"),
        "Cancelled": F.col("cancelled"),
        "Flights": F.lit("1.00"),
    }
    return flights.select(
        *[(values[c].cast("string") if c in values else F.lit(None).cast("string")).alias(c) for c in RAW_FLIGHT_COLUMNS]
    )
