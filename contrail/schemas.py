"""Schemas of every input and output layout.

Column positions follow the layouts the flight data arrives in: the raw
on-time CSV (quote-aware, so ``"City, ST"`` stays one field), the pipe-delimited
clean file, the older clean layout, lookups, leg pairs and itineraries.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Raw on-time CSV columns, in file order (quote-aware read, 55 fields).
RAW_FLIGHT_COLUMNS = [
    "Year", "Quarter", "Month", "DayofMonth", "DayOfWeek", "FlightDate", "UniqueCarrier",
    "AirlineID", "Carrier", "TailNum", "FlightNum", "Origin", "OriginCityName", "OriginState",
    "OriginStateFips", "OriginStateName", "OriginWac", "Dest", "DestCityName", "DestState",
    "DestStateFips", "DestStateName", "DestWac", "CRSDepTime", "DepTime", "DepDelay",
    "DepDelayMinutes", "DepDel15", "DepartureDelayGroups", "DepTimeBlk", "TaxiOut", "WheelsOff",
    "WheelsOn", "TaxiIn", "CRSArrTime", "ArrTime", "ArrDelay", "ArrDelayMinutes", "ArrDel15",
    "ArrivalDelayGroups", "ArrTimeBlk", "Cancelled", "CancellationCode", "Diverted",
    "CRSElapsedTime", "ActualElapsedTime", "AirTime", "Flights", "Distance", "DistanceGroup",
    "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay",
]

RAW_FLIGHTS = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_FLIGHT_COLUMNS])

# Raw column -> clean column, in the clean file's field order.
RAW_TO_CLEAN = [
    ("FlightDate", "flight_date"),
    ("AirlineID", "airline_id"),
    ("Carrier", "carrier"),
    ("FlightNum", "flight_num"),
    ("Cancelled", "cancelled"),
    ("Origin", "origin"),
    ("Dest", "dest"),
    ("DepDelay", "dep_delay"),
    ("ArrDelay", "arr_delay"),
    ("DepTime", "dep_time"),
]

CLEAN_FLIGHTS = T.StructType([
    T.StructField("flight_date", T.DateType(), True),
    T.StructField("airline_id", T.IntegerType(), True),
    T.StructField("carrier", T.StringType(), True),
    T.StructField("flight_num", T.StringType(), True),
    T.StructField("cancelled", T.StringType(), True),
    T.StructField("origin", T.StringType(), True),
    T.StructField("dest", T.StringType(), True),
    T.StructField("dep_delay", T.DoubleType(), True),
    T.StructField("arr_delay", T.DoubleType(), True),
    T.StructField("dep_time", T.StringType(), True),
])
CLEAN_COLUMNS = [f.name for f in CLEAN_FLIGHTS.fields]

# Older clean layout: positions 0, 1 and 5 are never read.
OLD_CLEAN_FLIGHTS = T.StructType([
    T.StructField("f0", T.StringType(), True),
    T.StructField("f1", T.StringType(), True),
    T.StructField("carrier", T.StringType(), True),
    T.StructField("origin", T.StringType(), True),
    T.StructField("dest", T.StringType(), True),
    T.StructField("f5", T.StringType(), True),
    T.StructField("dep_del15", T.StringType(), True),
    T.StructField("arr_delay", T.DoubleType(), True),
    T.StructField("arr_del15", T.StringType(), True),
    T.StructField("airline_id", T.IntegerType(), True),
    T.StructField("airline_name", T.StringType(), True),
])

# Columns the older layout keeps after reading, in field order.
OLD_KEPT_COLUMNS = ["carrier", "origin", "dest", "arr_delay", "airline_id", "airline_name"]

LOOKUP = T.StructType([
    T.StructField("code", T.StringType(), True),
    T.StructField("description", T.StringType(), True),
])

# One leg of a two-leg pair, as projected for the legs file.
LEG_COLUMNS = [
    "flight_date", "airline_id", "carrier", "origin", "dest", "dep_delay",
    "dep_delay_minutes", "dep_del15", "arr_delay", "arr_delay_minutes", "arr_del15",
]

# Raw column -> leg column, in the legs file's field order.
RAW_TO_LEG = list(zip(
    ["FlightDate", "AirlineID", "Carrier", "Origin", "Dest", "DepDelay", "DepDelayMinutes", "DepDel15",
     "ArrDelay", "ArrDelayMinutes", "ArrDel15"],
    LEG_COLUMNS,
))

ITINERARY = T.StructType([
    T.StructField("x", T.StringType(), False),
    T.StructField("y", T.StringType(), False),
    T.StructField("z", T.StringType(), False),
    T.StructField("first_date", T.DateType(), False),
])

KEY_VALUE = T.StructType([
    T.StructField("key", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
])
