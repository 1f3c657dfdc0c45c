"""The query catalog: one function ``(spark, sf_dir) -> DataFrame`` per query.

Every query reads the driver tables under ``sf_dir`` (whole tables) through
the flights mapping of :mod:`contrail.sources.tables`, asking only for the
columns it reads.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.functions.scalars import round_half_up, short_number
from contrail.operators.clean import clean_lookup, enrich, project_clean, project_legs
from contrail.operators.filters import min_fields
from contrail.operators.joins import lookup_left_join
from contrail.operators.legs import hub_pair_stats as hub_statistics
from contrail.operators.legs import itinerary_legs
from contrail.operators.numbering import with_position
from contrail.operators.parse import parse_lines, to_lines
from contrail.operators.rollup import BY_DAY, BY_ROUTE, answer_from_rollup, merge, rollup
from contrail.operators.upsert import first_per_key
from contrail.plans import questions as Q
from contrail.schemas import CLEAN_COLUMNS, CLEAN_FLIGHTS, OLD_KEPT_COLUMNS
from contrail.session import scratch_path
from contrail.sinks.files import bounded_files, materialize, write_delimited, write_key_value
from contrail.sinks.keyed import KeyedTable
from contrail.sinks.serving import publish
from contrail.sources.files import (
    bad_lines,
    good_lines,
    read_clean_flights,
    read_key_value,
    read_lookup,
    read_old_clean_flights,
    read_raw_flights,
    read_raw_marked,
)
from contrail.sources.tables import (
    REQUESTS,
    airline_lookup_from_tables,
    airport_lookup_from_tables,
    flights_from_tables,
    itineraries_from_tables,
    raw_rows_from_flights,
    read_table,
)
from contrail.streaming.files import keep_airport_counts, keep_route_means, table_stream, text_stream, upsert_batches, write_files

# Airports picked for the subset report, and the date that
# splits the flights into two loads for the serving-table upsert.
REPORT_AIRPORTS = ["NATION_3", "NATION_7", "NATION_12", "NATION_21"]
UPSERT_SPLIT_DATE = "1998-01-01"


TRAFFIC_COLS = ["origin", "dest", "arr_delay", "dep_time"]
# 2-1 reads no destination (no order/customer join); 2-2 reads no carrier (no part join).
CARRIER_DEP_COLS = ["origin", "carrier", "cancelled", "dep_delay", "arr_delay", "dep_time"]
ROUTE_DEP_COLS = ["origin", "dest", "dep_delay", "arr_delay", "dep_time"]
LEG_COLS = ["flight_date", "carrier", "flight_num", "origin", "dest", "arr_delay", "dep_time"]


def _flights(spark: SparkSession, sf_dir: str, cols: list[str] | None = None, **kw) -> DataFrame:
    return flights_from_tables(spark, sf_dir, cols, **kw)


def _lookups(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return (
        clean_lookup(airport_lookup_from_tables(spark, sf_dir)),
        clean_lookup(airline_lookup_from_tables(spark, sf_dir)),
    )


def flights_clean(spark, sf_dir):
    airports, airlines = _lookups(spark, sf_dir)
    return enrich(_flights(spark, sf_dir), airports, airlines, lookups_unique=True)


def flights_parsed(spark, sf_dir):
    lines = to_lines(_flights(spark, sf_dir), CLEAN_COLUMNS)
    return parse_lines(lines, CLEAN_FLIGHTS)


def lookup_clean(spark, sf_dir):
    airports, airlines = _lookups(spark, sf_dir)
    return airports.select(F.lit("airport").alias("kind"), "code", "description").unionByName(
        airlines.select(F.lit("airline").alias("kind"), "code", "description")
    )


def airports_top10(spark, sf_dir):
    return Q.popular_airports(_flights(spark, sf_dir, TRAFFIC_COLS))


def airports_ranked(spark, sf_dir):
    return Q.airports_by_popularity(_flights(spark, sf_dir, TRAFFIC_COLS))


def carriers_ontime_top10(spark, sf_dir):
    return Q.ontime_carriers(_flights(spark, sf_dir, ["carrier", "arr_delay", "dep_time"]))


def airlines_named_ontime_top10(spark, sf_dir):
    _, airlines = _lookups(spark, sf_dir)
    return Q.ontime_airlines_named(_flights(spark, sf_dir, ["airline_id", "arr_delay"]), airlines, airlines_unique=True)


def origin_carrier_best10(spark, sf_dir):
    return Q.origin_carrier_best(_flights(spark, sf_dir, CARRIER_DEP_COLS))


def origin_dest_best10(spark, sf_dir):
    return Q.origin_dest_best(_flights(spark, sf_dir, ROUTE_DEP_COLS))


def origin_dest_worst10(spark, sf_dir):
    return Q.origin_dest_worst(_flights(spark, sf_dir, ROUTE_DEP_COLS))


def route_mean_arrival(spark, sf_dir):
    return Q.route_mean_arrival(_flights(spark, sf_dir, TRAFFIC_COLS))


def _requested(spark, sf_dir, n: int | None = REQUESTS) -> tuple[DataFrame, DataFrame]:
    """Flights on the days of the requested legs, and the requests (``n`` of them, or all)."""
    itin = itineraries_from_tables(spark, sf_dir, n)
    legs = itinerary_legs(itin)
    return _flights(spark, sf_dir, LEG_COLS, days=legs, days_rows=2 * n if n else None), itin


def leg_flight_min_delay(spark, sf_dir):
    flights, itin = _requested(spark, sf_dir)
    return Q.leg_flight_min_delay(flights, itin, itinerary_rows=REQUESTS)


def two_leg_itineraries(spark, sf_dir):
    flights, itin = _requested(spark, sf_dir)
    return Q.two_leg_trips(flights, itin, itinerary_rows=REQUESTS)


def leg_requests_all(spark, sf_dir):
    """3-2 with a request table of any size: every connection that the flights hold is
    requested; the flights pass runtime filters made from the requests."""
    flights, itin = _requested(spark, sf_dir, None)
    return Q.leg_flight_min_delay(flights, itin)


def two_leg_trips_all(spark, sf_dir):
    """3-2 trips for a request table of any size."""
    flights, itin = _requested(spark, sf_dir, None)
    return Q.two_leg_trips(flights, itin)


def leg_pairs(spark, sf_dir):
    cols = ["flight_date", "airline_id", "carrier", "origin", "dest", "dep_delay", "arr_delay"]
    return Q.leg_pairs(_flights(spark, sf_dir, cols))


def leg_pairs_raw(spark, sf_dir):
    """The legs file straight from raw quoted CSV: leg columns (with the files' own
    minutes and 15-minute flags) projected from the raw rows, no clean table between."""
    path = scratch_path(spark, "raw-legs")
    bounded_files(raw_rows_from_flights(_flights(spark, sf_dir))).option("header", True).option("quoteAll", True).csv(path)
    return Q.leg_pairs(project_legs(read_raw_flights(spark, path)))


def origin_carrier_report(spark, sf_dir):
    return Q.origin_carrier_report(_flights(spark, sf_dir, CARRIER_DEP_COLS))


def origin_carrier_pairs(spark, sf_dir):
    return Q.origin_carrier_pairs(_flights(spark, sf_dir, CARRIER_DEP_COLS))


def airport_subset_report(spark, sf_dir):
    return Q.airport_subset_report(_flights(spark, sf_dir, ROUTE_DEP_COLS), REPORT_AIRPORTS)


def serving_upsert(spark, sf_dir):
    """Both loads' route means come from one pass over the flights, written to
    the shared folder (routes x 2 rows); the upsert then reads that table."""
    means = Q.route_means_by_load(_flights(spark, sf_dir, ["flight_date"] + TRAFFIC_COLS), UPSERT_SPLIT_DATE)
    return Q.serving_after_loads(materialize(means, scratch_path(spark, "route-means-by-load")))


def etl_roundtrip(spark, sf_dir):
    """The whole ETL path on the whole table. Flights (raw quoted CSV) and lookups (a
    ``Code,Description`` row, quotes inside the codes, commas in the names) are
    written side by side; the flights are read back by their name prefix,
    cleaned, stored pipe-delimited, read again and joined with the names."""
    base = scratch_path(spark, "etl")
    raw = raw_rows_from_flights(_flights(spark, sf_dir))
    bounded_files(raw).option("header", True).option("quoteAll", True).csv(f"{base}/On_Time_1")
    for name, lk in (("L_AIRPORT", airport_lookup_from_tables(spark, sf_dir)), ("L_AIRLINE_ID", airline_lookup_from_tables(spark, sf_dir))):
        quoted = lk.select(
            F.concat(F.lit('"'), "code", F.lit('"')).alias("Code"), F.concat("description", F.lit(", "), "code").alias("Description")
        )
        quoted.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(f"{base}/{name}")
    # The lookups have two columns: a strict read that took them in would fail.
    write_delimited(project_clean(read_raw_flights(spark, f"{base}/On_Time_*")), f"{base}/clean", compressed=True)
    return enrich(
        read_clean_flights(spark, f"{base}/clean"),
        clean_lookup(read_lookup(spark, f"{base}/L_AIRPORT")),
        clean_lookup(read_lookup(spark, f"{base}/L_AIRLINE_ID")),
        lookups_unique=True,
    )


# Which flights (by line number) get which fault in ``raw_set_aside``.
FAULTY = {"5": "fields", "6": "date", "7": "number"}


def raw_set_aside(spark, sf_dir):
    """Raw quoted lines, some with a planted fault, read into good flights and bad lines with
    their reason; then counted by reason and airport of departure (of a bad line: its text)."""
    path = scratch_path(spark, "raw-faulty")
    raw = raw_rows_from_flights(_flights(spark, sf_dir))
    fault = lambda n: F.col("FlightNum") == n
    raw = raw.withColumns({
        "FlightDate": F.when(fault("6"), "1996-13-45").otherwise(F.col("FlightDate")),
        "ArrDelay": F.when(fault("7"), "4x").otherwise(F.col("ArrDelay")),
    })
    cells = F.concat_ws('","', *[F.coalesce(F.col(c), F.lit("")) for c in raw.columns])
    line = F.concat(F.lit('"'), cells, F.when(fault("5"), '","more"').otherwise('"'))
    bounded_files(raw.select(line.alias("value"))).text(f"{path}/flights")
    spark.range(1).select(F.lit(",".join(f'"{c}"' for c in raw.columns)).alias("value")).write.mode("append").text(f"{path}/flights")
    marked = materialize(read_raw_marked(spark, f"{path}/flights"), f"{path}/marked", "zstd")
    good = project_clean(good_lines(marked)).select(F.lit("good").alias("kind"), "origin")
    bad = bad_lines(marked).select(F.col("reason").alias("kind"), F.regexp_extract("line", '"(NATION_[0-9]+)"', 1).alias("origin"))
    return good.unionByName(bad).groupBy("kind", "origin").agg(F.count(F.lit(1)).alias("lines"))


def old_layout_airlines(spark, sf_dir):
    """1-2 named, from flights written in the older pipe layout (airline id and
    name on each row, taken from the airline lookup) and read back with its
    reader."""
    _, airlines = _lookups(spark, sf_dir)
    names = airlines.select(F.col("code").alias("_code"), F.col("description").alias("airline_name"))
    flights = _flights(spark, sf_dir, ["carrier", "origin", "dest", "arr_delay", "airline_id"])
    flights = lookup_left_join(flights, names, F.col("airline_id").cast("string"), "_code")
    empty = F.lit(None).cast("string")
    old = flights.select(
        empty.alias("f0"), empty.alias("f1"), "carrier", "origin", "dest", empty.alias("f5"),
        empty.alias("dep_del15"), "arr_delay", empty.alias("arr_del15"), "airline_id", "airline_name",
    )
    path = scratch_path(spark, "old-layout")
    write_delimited(old, path, sep="|")
    back = read_old_clean_flights(spark, path)
    return Q.ontime_airlines_inline(min_fields(back, 5, OLD_KEPT_COLUMNS))


def route_key_value(spark, sf_dir):
    """2-4 handed on as key/value text: ``origin-dest<TAB>delay`` written, then read back."""
    routes = Q.route_mean_arrival(_flights(spark, sf_dir, TRAFFIC_COLS))
    lines = routes.select(F.concat_ws("-", "origin", "dest").alias("key"), short_number("delay").alias("value"))
    path = scratch_path(spark, "route-kv")
    write_key_value(lines, "key", "value", path)
    return read_key_value(spark, path)


def route_key_value_unrounded(spark, sf_dir):
    """2-4 as the older jobs hand it on: ``origin-dest<TAB>mean``, the mean not rounded;
    read back as a number (the text of a double differs between engines)."""
    routes = Q.route_mean_arrival(_flights(spark, sf_dir, TRAFFIC_COLS), digits=None)
    path = scratch_path(spark, "route-kv-plain")
    write_key_value(routes.select(F.concat_ws("-", "origin", "dest").alias("key"), F.col("delay").alias("value")), "key", "value", path)
    return read_key_value(spark, path).select("key", F.col("value").cast("double").alias("value"))


def origin_carrier_best10_mr(spark, sf_dir):
    return Q.origin_carrier_best_unrounded(_flights(spark, sf_dir, CARRIER_DEP_COLS))


def origin_dest_worst_report(spark, sf_dir):
    return Q.origin_dest_worst_report(_flights(spark, sf_dir, ROUTE_DEP_COLS))


def serving_stream_upsert(spark, sf_dir):
    """The 2-4 serving table kept in the sink: load 0 by an upsert, load 1 as a stream
    of several micro-batches on the loaded table, read back from the sink."""
    base = scratch_path(spark, "serving-stream")
    means = Q.route_means_by_load(_flights(spark, sf_dir, ["flight_date"] + TRAFFIC_COLS), UPSERT_SPLIT_DATE)
    loads = materialize(means, f"{base}/means")
    table = KeyedTable(spark, f"{base}/table", ["origin", "dest"])
    table.upsert(loads.filter("load = 0").drop("load"))
    second = loads.filter("load = 1").drop("load")
    second.repartition(3, "origin").write.mode("overwrite").parquet(f"{base}/arriving")
    stream = table_stream(spark, f"{base}/arriving", second.schema, max_files=1)
    upsert_batches(stream, table, f"{base}/checkpoint", available_now=True).awaitTermination()
    return table.current()


def serving_two_streams(spark, sf_dir):
    """The 2-4 serving table fed by two streams, a load each, in several micro-batches; then the
    first stream is replayed from its start, which must not bring its older items back."""
    base = scratch_path(spark, "serving-two-streams")
    means = Q.route_means_by_load(_flights(spark, sf_dir, ["flight_date"] + TRAFFIC_COLS), UPSERT_SPLIT_DATE)
    loads = materialize(means, f"{base}/means")
    table = KeyedTable(spark, f"{base}/table", ["origin", "dest"])
    for load in (0, 1):
        rows = loads.filter(F.col("load") == load).drop("load")
        rows.repartition(3, "origin").write.mode("overwrite").parquet(f"{base}/arriving-{load}")
    for run, load in enumerate((0, 1, 0)):  # the third run has lost its checkpoint: it replays every batch
        stream = table_stream(spark, f"{base}/arriving-{load}", loads.drop("load").schema, max_files=1)
        upsert_batches(stream, table, f"{base}/checkpoint-{run}", available_now=True, stream=f"load-{load}").awaitTermination()
    return table.current()


ROLLUP_COLS = ["origin", "dest", "carrier", "flight_date", "cancelled", "dep_delay", "arr_delay", "dep_time"]


def rollup_answers(spark, sf_dir):
    """1-1, 1-2, 2-1, 2-2, 2-4 and 3-1 from one scan: two rollups (of the flights before and
    from a date) are written by one pass, merged, and every question is answered from them."""
    loads = _flights(spark, sf_dir, ROLLUP_COLS).withColumn("load", F.col("flight_date") < F.lit(UPSERT_SPLIT_DATE).cast("date"))
    written = materialize(rollup(loads, (*BY_DAY, "load")), scratch_path(spark, "rollup"))
    parts = [written.filter(c).drop("load") for c in ("load", "not load or load is null")]
    rolled = materialize(merge(*parts, by=BY_ROUTE), scratch_path(spark, "rollup-routes"))

    def rows(qid: str, key: Column, name: Column, value: str, rank: Column) -> DataFrame:
        own = answer_from_rollup(qid, rolled)
        return own.select(F.lit(qid).alias("question"), key.alias("key"), name.alias("name"), F.col(value).cast("double").alias("value"), rank.alias("rank"))

    none, no_rank = F.lit(None).cast("string"), F.lit(None).cast("int")
    return reduce(DataFrame.unionByName, [
        rows("1-1", F.col("airport"), none, "flights", no_rank),
        rows("1-2", F.col("airline"), none, "delay", no_rank),
        rows("2-1", F.col("origin"), F.col("carrier"), "delay", F.col("rank")),
        rows("2-2", F.col("origin"), F.col("dest"), "delay", F.col("rank")),
        rows("2-4", F.col("origin"), F.col("dest"), "delay", no_rank),
        rows("3-1", F.col("airport"), none, "flights", no_rank),
    ])


def airports_positions(spark, sf_dir):
    """3-1 with every airport's position in the whole order."""
    counts = Q.airport_traffic(_flights(spark, sf_dir, TRAFFIC_COLS))
    return with_position(counts, [("flights", False), ("airport", False)])


def hub_pair_stats(spark, sf_dir):
    """The legs self-join without a date condition, as statistics by hub; no pair is listed."""
    stats = hub_statistics(_flights(spark, sf_dir, ["origin", "dest", "arr_delay"]))
    counts, means = ("pairs", "both_late"), ("first_delay", "second_delay", "total_delay")
    return stats.withColumns({**{c: F.col(c).cast("double") for c in counts}, **{c: round_half_up(c) for c in means}})


def _stream_in_two_runs(spark, sf_dir, cols, keys, keep):
    """A stream over the flights in six files: three files a run and one a batch; the second run
    is a restart from the first one's checkpoint."""
    base = scratch_path(spark, "stream-state")
    flights = materialize(_flights(spark, sf_dir, cols).repartition(6, *cols), f"{base}/flights")
    table = KeyedTable(spark, f"{base}/table", keys)
    part = F.pmod(F.xxhash64(*cols), F.lit(6))
    for run in (0, 1):
        chosen = flights.filter(part < 3) if run == 0 else flights.filter(part >= 3)
        chosen.repartition(3, *cols).write.mode("append").parquet(f"{base}/arriving")
        stream = table_stream(spark, f"{base}/arriving", flights.schema, max_files=1)
        keep(stream, table, f"{base}/checkpoint", available_now=True).awaitTermination()
    return table.current()


def stream_route_means(spark, sf_dir):
    """2-4 kept as state of a stream while files arrive, over a restart."""
    return _stream_in_two_runs(spark, sf_dir, TRAFFIC_COLS, ["origin", "dest"], keep_route_means)


def stream_airport_counts(spark, sf_dir):
    """3-1's counts kept as state of a stream while files arrive, over a restart."""
    return _stream_in_two_runs(spark, sf_dir, TRAFFIC_COLS, ["airport"], keep_airport_counts)


def _published(spark, sf_dir, qid: str, answer: DataFrame) -> DataFrame:
    """An answer as the serving table of its question, read back from the sink."""
    return publish(spark, qid, answer, scratch_path(spark, "serving"))


def serving_airports(spark, sf_dir):
    return _published(spark, sf_dir, "1-1", airports_top10(spark, sf_dir))


def serving_airlines(spark, sf_dir):
    return _published(spark, sf_dir, "1-2", carriers_ontime_top10(spark, sf_dir))


def serving_carriers(spark, sf_dir):
    return _published(spark, sf_dir, "2-1", origin_carrier_best10(spark, sf_dir))


def serving_destinations(spark, sf_dir):
    return _published(spark, sf_dir, "2-2", origin_dest_best10(spark, sf_dir))


def stream_lines(spark, sf_dir):
    """Clean flights as pipe lines in several files, streamed a file at a time,
    parsed, written batch by batch and read back."""
    base = scratch_path(spark, "stream-lines")
    lines = to_lines(_flights(spark, sf_dir), CLEAN_COLUMNS)
    n = max(3, int(spark.conf.get("spark.sql.shuffle.partitions")))
    lines.repartition(n, "value").write.text(f"{base}/arriving")
    parsed = parse_lines(text_stream(spark, f"{base}/arriving", max_files=-(-n // 3)), CLEAN_FLIGHTS)
    write_files(parsed, f"{base}/data", f"{base}/checkpoint", available_now=True).awaitTermination()
    return spark.read.schema(parsed.schema).parquet(f"{base}/data")


def leg_serving(spark, sf_dir):
    """3-2 as serving items: one per (origin, dest, date, time), the lowest
    (delay, airline) when two flights leave at the same minute."""
    return first_per_key(
        leg_flight_min_delay(spark, sf_dir), ["origin", "dest", "flight_date", "dep_time"], ["delay", "airline"]
    )


def stream_tail(spark, sf_dir):
    """The events table read as a file stream, written batch by batch to a
    file table in the shared checkpoint folder, and read back."""
    schema = read_table(spark, sf_dir, "events").schema
    base = scratch_path(spark, "stream_tail")
    stream = table_stream(spark, sf_dir, schema, file_glob="events.parquet", max_files=1000)
    q = write_files(stream, f"{base}/data", f"{base}/checkpoint", available_now=True)
    q.awaitTermination()  # until the available files are done; a failure is raised here
    return spark.read.schema(schema).parquet(f"{base}/data")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "flights_clean": flights_clean,
    "flights_parsed": flights_parsed,
    "lookup_clean": lookup_clean,
    "airports_top10": airports_top10,
    "airports_ranked": airports_ranked,
    "carriers_ontime_top10": carriers_ontime_top10,
    "airlines_named_ontime_top10": airlines_named_ontime_top10,
    "origin_carrier_best10": origin_carrier_best10,
    "origin_dest_best10": origin_dest_best10,
    "origin_dest_worst10": origin_dest_worst10,
    "route_mean_arrival": route_mean_arrival,
    "leg_flight_min_delay": leg_flight_min_delay,
    "two_leg_itineraries": two_leg_itineraries,
    "leg_requests_all": leg_requests_all,
    "two_leg_trips_all": two_leg_trips_all,
    "leg_pairs": leg_pairs,
    "leg_pairs_raw": leg_pairs_raw,
    "origin_carrier_report": origin_carrier_report,
    "airport_subset_report": airport_subset_report,
    "serving_upsert": serving_upsert,
    "stream_tail": stream_tail,
    "etl_roundtrip": etl_roundtrip,
    "leg_serving": leg_serving,
    "raw_set_aside": raw_set_aside,
    "old_layout_airlines": old_layout_airlines,
    "route_key_value": route_key_value,
    "route_key_value_unrounded": route_key_value_unrounded,
    "origin_carrier_pairs": origin_carrier_pairs,
    "origin_carrier_best10_mr": origin_carrier_best10_mr,
    "origin_dest_worst_report": origin_dest_worst_report,
    "serving_stream_upsert": serving_stream_upsert,
    "serving_two_streams": serving_two_streams,
    "rollup_answers": rollup_answers,
    "airports_positions": airports_positions,
    "hub_pair_stats": hub_pair_stats,
    "stream_route_means": stream_route_means,
    "stream_airport_counts": stream_airport_counts,
    "serving_airports": serving_airports,
    "serving_airlines": serving_airlines,
    "serving_carriers": serving_carriers,
    "serving_destinations": serving_destinations,
    "stream_lines": stream_lines,
}
