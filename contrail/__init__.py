"""contrail: flight on-time-performance analytics as Spark DataFrame plans.

Sub-packages
------------
sources    readers for raw, clean, older and lookup files, and the driver-table flights adapter
functions  column-expression helpers (rounding, presence tests, field counts, number and pair text)
operators  DataFrame -> DataFrame building blocks (filters, aggregates, ranking, lists, joins,
           cleaning, legs, parsing, upsert)
plans      the questions (1-1 ... 3-2) composed from operators, the query catalog and its SQL
           oracle, the ETL (raw CSV -> clean table, stored once) and the command-line runner
sinks      file writers, checked collect, written intermediates and the versioned keyed table
streaming  Structured Streaming sources and sinks, and a directory-tail command
"""

__version__ = "0.1.0"
