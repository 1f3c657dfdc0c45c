"""Command-line runner: answer one or more questions by id.

    python -m contrail 1-1 2-1 --input /data/clean --output /data/answers
    python -m contrail 3-1 --tables /root/testdata/sf0.1 --show

``--input`` reads pipe-delimited clean flights (or ``--format parquet``);
``--tables`` uses the driver tables through the flights mapping. Each answer
is written to ``<output>/<id>`` (replacing what was there) as Parquet, CSV or
``key<TAB>value`` text. Several questions of counts and means share one scan, which writes the
rollup they are answered from; the others share a persisted input (not for Parquet, which is
scanned column by column), released at the end.
"""

from __future__ import annotations

import argparse

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.plans import questions as Q
from contrail.plans.etl import clean_from_raw, read_stored_flights, store_flights
from contrail.session import input_bytes, scratch_path, size_for_input
from contrail.operators.filters import min_fields
from contrail.operators.rollup import BY_ROUTE, ROLLUP_IDS, answer_from_rollup, rollup
from contrail.schemas import ITINERARY, OLD_KEPT_COLUMNS
from contrail.sinks.serving import SERVING_KEYS, publish
from contrail.sinks.files import materialize, write_delimited, write_key_value, write_table
from contrail.sources.files import read_clean_flights, read_lookup, read_old_clean_flights
from contrail.sources.tables import ON_TIME_ITINERARIES, REQUESTS, flights_from_tables, itineraries_from_codes, itineraries_from_tables


def answer(
    qid: str,
    flights: DataFrame,
    n: int | None,
    itineraries: DataFrame | None,
    airlines: DataFrame | None,
    itinerary_rows: int | None = None,
) -> DataFrame:
    if qid == "1-1":
        return Q.popular_airports(flights, n)
    if qid == "3-1":
        return Q.airports_by_popularity(flights)
    if qid == "1-2":
        return Q.ontime_carriers(flights, n)
    if qid == "1-2-named":
        if airlines is None:
            raise SystemExit("1-2-named needs --airlines")
        return Q.ontime_airlines_named(flights, airlines, n)
    if qid == "2-1":
        return Q.origin_carrier_best(flights, n or Q.TOP)
    if qid == "2-2":
        return Q.origin_dest_best(flights, n or Q.TOP)
    if qid == "2-2-worst":
        return Q.origin_dest_worst(flights, n or Q.TOP)
    if qid == "2-4":
        return Q.route_mean_arrival(flights)
    if qid in ("3-2", "3-2-trips"):
        if itineraries is None:
            raise SystemExit(f"{qid} needs itineraries (--tables)")
        fn = Q.leg_flight_min_delay if qid == "3-2" else Q.two_leg_trips
        return fn(flights, itineraries, itinerary_rows=itinerary_rows)
    raise SystemExit(f"unknown question {qid}")


OLD_IDS = ("1-1", "3-1", "1-2-named", "2-1", "2-2-worst", "2-4")


def answer_old_layout(spark: SparkSession, args) -> None:
    """Questions on the older layout: counts need a field at position 9 or 10
    (airline id or name), 1-2 takes the airline name from the row, and 2-4
    prints the unrounded mean. The layout has one delay field; ``--delay-field dep``
    says that it holds departure delays, which 2-1 and 2-2 (ranked by the
    unrounded mean) need."""
    flights = read_old_clean_flights(spark, args.input)
    with_airline = min_fields(flights, 5, OLD_KEPT_COLUMNS)  # field 9 or 10 present
    n = args.n or None
    for qid in args.questions:
        if qid not in OLD_IDS:
            raise SystemExit(f"{qid} cannot be answered from the older layout")
        if qid.startswith("2-") and qid != "2-4":
            if args.delay_field != "dep":
                raise SystemExit(f"{qid} needs departure delays: --delay-field dep")
            as_dep = with_airline.withColumnRenamed("arr_delay", "dep_delay").withColumn("cancelled", F.lit(None).cast("string"))
            fn = Q.origin_carrier_best_unrounded if qid == "2-1" else Q.origin_dest_worst
            _emit(args, qid, qid, fn(as_dep, n or Q.TOP, fields=0))
            continue
        if qid in ("1-1", "3-1"):
            out = Q.popular_airports(flights, n if qid == "1-1" else None, OLD_KEPT_COLUMNS, 5)
        elif qid == "1-2-named":
            out = Q.ontime_airlines_inline(flights, n)
        else:
            out = Q.route_mean_arrival(with_airline, digits=None, fields=0)
        _emit(args, qid.replace("-named", ""), qid, out)


def _emit(args, text_id: str, qid: str, out: DataFrame) -> None:
    if args.show:
        out.printSchema()
        out.show(20, truncate=False)
    if args.output:
        path = f"{args.output.rstrip('/')}/{qid}"
        if args.write_as == "parquet":
            write_table(out, path)
        elif args.write_as == "csv":
            write_delimited(out, path, sep="|")
        else:
            write_key_value(Q.key_value_lines(text_id, out), "key", "value", path)
    if args.serve and text_id in SERVING_KEYS:
        publish(out.sparkSession, text_id, out, args.serve)


IDS = ["1-1", "1-2", "1-2-named", "2-1", "2-2", "2-2-worst", "2-4", "3-1", "3-2", "3-2-trips"]


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="contrail")
    ap.add_argument("questions", nargs="*", choices=IDS)
    ap.add_argument("--store", help="write the clean flights table here (year directories) and exit")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--input", help="clean flights (pipe-delimited unless --format parquet)")
    src.add_argument("--tables", help="directory of the driver tables")
    src.add_argument("--raw", help="raw on-time CSV files (a directory or a glob); see --clean-out")
    ap.add_argument("--airports", help="airport lookup CSV (with --raw)")
    ap.add_argument("--lenient", action="store_true", help="with --raw: malformed numbers become null instead of failing the job")
    ap.add_argument("--rejects", help="with --raw: write bad lines here (file, reason, line) instead of failing or nulling them")
    ap.add_argument("--clean-out", help="with --raw: write the clean flights here, pipe-delimited")
    ap.add_argument("--legs-out", help="write the legs file here (each flight with its best connection), pipe-delimited")
    ap.add_argument("--format", default="pipe", choices=["pipe", "parquet", "old"],
                    help="old: the older pipe layout (1-1, 3-1, 1-2-named, 2-1, 2-2-worst, 2-4 only)")
    ap.add_argument("--delay-field", default="arr", choices=["arr", "dep"], help="what the delay field of the older layout holds")
    ap.add_argument("--serve", help="upsert the answers of 1-1, 1-2, 2-1, 2-2, 2-4 and 3-2 into the serving tables in this directory")
    ap.add_argument("--airlines", help="airline lookup CSV (for 1-2-named, and --raw)")
    ap.add_argument("--itineraries", help="CSV x,y,z,first_date with header for 3-2 (default: the fixed on-time list)")
    ap.add_argument("--n", type=int, default=Q.TOP, help="list length (0 = no limit for 1-1 and 1-2)")
    ap.add_argument("--output", help="directory for the answers")
    ap.add_argument("--write-as", default="parquet", choices=["parquet", "csv", "text"])
    ap.add_argument("--show", action="store_true", help="print the schema and first rows of each answer")
    args = ap.parse_args(argv)
    if args.n < 0 or (args.n == 0 and any(q.startswith("2-") and q != "2-4" for q in args.questions)):
        raise SystemExit("--n 0 (no limit) holds for 1-1 and 1-2 only")

    spark = SparkSession.builder.appName("contrail").getOrCreate()
    if args.input or args.raw:
        source = [args.input or args.raw]
    else:
        source = [f"{args.tables.rstrip('/')}/{t}.parquet" for t in ("lineitem", "orders")]
    n_shuffle = size_for_input(spark, input_bytes(spark, *source))
    itineraries, asked = None, None  # ``asked``: how many itineraries, where that is known without reading them
    if args.raw:
        flights = clean_from_raw(spark, args.raw, args.airports, args.airlines, strict=not args.lenient, rejects=args.rejects)
        if args.clean_out:
            write_delimited(flights, args.clean_out, sep="|")
            flights = read_clean_flights(spark, args.clean_out)
    elif args.tables:
        flights = flights_from_tables(spark, args.tables)
        if any(q.startswith("3-2") for q in args.questions):
            itineraries, asked = itineraries_from_tables(spark, args.tables), REQUESTS
    elif args.format == "parquet":
        flights = read_stored_flights(spark, args.input)
    elif args.format == "old":
        if args.store or args.legs_out:
            raise SystemExit("the older layout has no dates: --store and --legs-out need the clean layout")
        return answer_old_layout(spark, args)
    else:
        flights = read_clean_flights(spark, args.input)
    if itineraries is None:
        if args.itineraries:
            itineraries = spark.read.schema(ITINERARY).option("header", True).csv(args.itineraries)
        else:
            itineraries, asked = itineraries_from_codes(spark), len(ON_TIME_ITINERARIES)
    if args.store:
        store_flights(flights, args.store, n_shuffle)
        return
    if args.legs_out:
        write_delimited(Q.leg_pairs(flights), args.legs_out, sep="|")
    if not args.questions:
        if args.clean_out or args.legs_out:
            return
        raise SystemExit("no question given")
    airlines = None
    if args.airlines:
        from contrail.operators.clean import clean_lookup

        airlines = clean_lookup(read_lookup(spark, args.airlines))
    # Several questions of counts and means: one scan makes the rollup that answers them all.
    n = args.n or None
    rolled = [q for q in args.questions if q in ROLLUP_IDS]
    if len(rolled) > 1:
        by_route = materialize(rollup(flights, BY_ROUTE), scratch_path(spark, "rollup"))
        for qid in rolled:
            _emit(args, qid, qid, answer_from_rollup(qid, by_route, n))
    others = [q for q in args.questions if len(rolled) < 2 or q not in rolled]
    # A Parquet scan is pruned per question, which is cheaper than keeping all columns.
    shared = len(others) > 1 and args.format != "parquet"
    if shared:
        flights = flights.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for qid in others:
            source = flights
            if args.format == "parquet" and args.input and qid.startswith("3-2"):
                source = read_stored_flights(spark, args.input, days=Q.requested_days(itineraries))
            out = answer(qid, source, n, itineraries, airlines, asked)
            _emit(args, qid, qid, out)
    finally:
        if shared:
            flights.unpersist()
