"""The questions, each a DataFrame plan over clean-layout flights.

==========  ============================================================  =========================
id          question                                                      function
==========  ============================================================  =========================
1-1         10 most popular airports (flights in + out)                   :func:`popular_airports`
3-1         every airport by popularity                                   :func:`airports_by_popularity`
1-2         10 carriers with the lowest mean arrival delay                :func:`ontime_carriers`
1-2 named   same, keyed ``airline name(id)``, unrounded inputs            :func:`ontime_airlines_named`
2-1         per origin, 10 carriers with the lowest mean departure delay  :func:`origin_carrier_best`
2-2 best    per origin, 10 destinations with the lowest mean dep. delay   :func:`origin_dest_best`
2-2 worst   per origin, 10 destinations with the highest mean dep. delay  :func:`origin_dest_worst`
2-4         per route, mean arrival delay                                 :func:`route_mean_arrival`
3-2         per requested leg, each flight's smallest arrival delay       :func:`leg_flight_min_delay`
3-2 trips   best flight per leg, joined into requested x -> y -> z trips  :func:`two_leg_trips`
legs        every flight with its best onward flight two days later       :func:`leg_pairs`
1-2 old     1-2 named on the older layout (name carried by each row)      :func:`ontime_airlines_inline`
==========  ============================================================  =========================

Report forms: :func:`origin_carrier_report`, :func:`origin_dest_worst_report`,
:func:`origin_carrier_pairs`, :func:`origin_dest_pairs`,
:func:`airport_subset_report`, :func:`key_value_lines`; serving table after two
loads: :func:`serving_after_loads`.

Shared rules: means are rounded half-up to two places where the question
shows them rounded; ties in a ranking are broken by the name (ascending for
"best", descending for "most"/"worst"); a row counts only when the fields the
question reads are present.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions.scalars import named_value, round_half_up
from contrail.operators.aggregates import endpoint_counts, mean_by
from contrail.operators.filters import exclude_cancelled, min_fields, require
from contrail.operators.joins import broadcast_rows, lookup_left_join, unique_by_key
from contrail.operators.legs import (
    as_legs,
    best_second_legs,
    best_two_leg_trips,
    connect_legs,
    flight_min_delay,
    itinerary_legs,
    least_delays,
)
from contrail.operators.lists import list_text, pairs_text, ranked_list, ranked_text
from contrail.operators.rank import best_k, top_n, worst_k
from contrail.operators.upsert import upsert
from contrail.schemas import CLEAN_COLUMNS
from contrail.session import scratch_path
from contrail.sinks.files import materialize

# The length of every top list.
TOP = 10


def airport_traffic(flights: DataFrame, layout: list[str] = CLEAN_COLUMNS, fields: int = 9) -> DataFrame:
    """(airport, flights): flights in plus out, over rows with ``fields``+
    fields in ``layout`` (9 in the clean layout) and both ends."""
    f = require(min_fields(flights, fields, layout), "origin", "dest")
    return endpoint_counts(f, ("origin", "dest"), key="airport", count="flights")


def popular_airports(
    flights: DataFrame, n: int | None = TOP, layout: list[str] = CLEAN_COLUMNS, fields: int = 9
) -> DataFrame:
    """1-1: the ``n`` busiest airports, by (flights, airport) descending."""
    return top_n(airport_traffic(flights, layout, fields), [("flights", False), ("airport", False)], n)


def airports_by_popularity(flights: DataFrame, layout: list[str] = CLEAN_COLUMNS, fields: int = 9) -> DataFrame:
    """3-1: every airport, busiest first."""
    return popular_airports(flights, None, layout, fields)


def ontime_carriers(flights: DataFrame, n: int | None = TOP) -> DataFrame:
    """1-2: carriers by mean arrival delay (each delay rounded to 2 places
    first, the mean unrounded), the ``n`` lowest by (delay, airline)."""
    f = require(min_fields(flights, 9), "carrier", "arr_delay")
    means = mean_by(f.withColumnRenamed("carrier", "airline"), ["airline"], round_half_up("arr_delay"))
    return top_n(means, [("delay", True), ("airline", True)], n)


def ontime_airlines_named(
    flights: DataFrame, airlines: DataFrame, n: int | None = TOP, airlines_unique: bool = False
) -> DataFrame:
    """1-2, named form: key ``name(id)`` from the airline lookup, unrounded mean."""
    lookup = airlines if airlines_unique else unique_by_key(airlines)
    names = lookup.select(F.col("code").alias("_code"), F.col("description").alias("_name"))
    f = require(flights.filter(F.col("airline_id").isNotNull()), "arr_delay")
    # The id is part of the key, so the mean per id is the mean per key: the name
    # meets a row per airline, not a row per flight.
    means = mean_by(f, ["airline_id"], "arr_delay")
    named = lookup_left_join(means, names, F.col("airline_id").cast("string"), "_code")
    key = F.concat(F.coalesce(F.col("_name"), F.lit("")), F.lit("("), F.col("airline_id").cast("string"), F.lit(")"))
    return top_n(named.select(key.alias("airline"), "delay"), [("delay", True), ("airline", True)], n)


def origin_carrier_means(flights: DataFrame, digits: int | None = 2, fields: int = 8) -> DataFrame:
    """(origin, carrier, delay): mean departure delay, cancelled flights left out."""
    f = exclude_cancelled(require(min_fields(flights, fields) if fields else flights, "origin", "carrier", "dep_delay"))
    return mean_by(f, ["origin", "carrier"], "dep_delay", digits=digits)


def origin_carrier_best_unrounded(flights: DataFrame, k: int = TOP, fields: int = 8) -> DataFrame:
    """2-1 as the older job has it: ranked by the unrounded mean, shown rounded."""
    ranked = best_k(origin_carrier_means(flights, None, fields), ["origin"], "delay", "carrier", k)
    return ranked.withColumn("delay", round_half_up("delay"))


def origin_carrier_best(flights: DataFrame, k: int = TOP) -> DataFrame:
    """2-1: per origin, the ``k`` carriers with the lowest mean departure delay."""
    return best_k(origin_carrier_means(flights), ["origin"], "delay", "carrier", k)


def origin_dest_means(flights: DataFrame, digits: int | None = 2, fields: int = 8) -> DataFrame:
    """(origin, dest, delay): mean departure delay per route (cancelled kept)."""
    f = require(min_fields(flights, fields) if fields else flights, "origin", "dest", "dep_delay")
    return mean_by(f, ["origin", "dest"], "dep_delay", digits=digits)


def origin_dest_best(flights: DataFrame, k: int = TOP) -> DataFrame:
    """2-2: per origin, the ``k`` destinations with the lowest mean departure delay."""
    return best_k(origin_dest_means(flights), ["origin"], "delay", "dest", k)


def origin_dest_worst(flights: DataFrame, k: int = TOP, fields: int = 8) -> DataFrame:
    """2-2, other direction: per origin, the ``k`` destinations with the
    highest mean departure delay; rank 1 is the worst. Ranked by the unrounded
    mean, shown rounded."""
    ranked = worst_k(origin_dest_means(flights, None, fields), ["origin"], "delay", "dest", k)
    return ranked.withColumn("delay", round_half_up("delay"))


def origin_dest_worst_report(flights: DataFrame, k: int = TOP) -> DataFrame:
    """2-2 worst as text: (origin, destinations) with ``dest(delay) ...``, the worst last."""
    rising = origin_dest_worst(flights, k).withColumn("rank", -F.col("rank"))
    return ranked_text(rising, ["origin"], "rank", "dest", "delay", alias="destinations")


def route_mean_arrival(flights: DataFrame, digits: int | None = 2, fields: int = 9) -> DataFrame:
    """2-4: (origin, dest, delay) mean arrival delay per route, rounded to
    ``digits`` (``None``: unrounded, as the older jobs print it)."""
    f = require(min_fields(flights, fields) if fields else flights, "origin", "dest", "arr_delay")
    return mean_by(f, ["origin", "dest"], "arr_delay", digits=digits)


def ontime_airlines_inline(flights: DataFrame, n: int | None = TOP) -> DataFrame:
    """1-2, named form, on the older layout where each row carries the airline
    name: key ``name(id)``, unrounded mean, the ``n`` lowest."""
    f = require(min_fields(flights, len(flights.columns) - 1, flights.columns), "arr_delay")
    key = F.concat(
        F.coalesce(F.col("airline_name"), F.lit("")), F.lit("("),
        F.coalesce(F.col("airline_id").cast("string"), F.lit("")), F.lit(")"),
    )
    means = mean_by(f.withColumn("airline", key), ["airline"], "arr_delay")
    return top_n(means, [("delay", True), ("airline", True)], n)


def leg_flight_min_delay(flights: DataFrame, itineraries: DataFrame, days: int = 2, itinerary_rows: int | None = None) -> DataFrame:
    """3-2: for each flight on a requested leg, its smallest arrival delay."""
    return flight_min_delay(flights, itineraries, days, itinerary_rows)


def two_leg_trips(flights: DataFrame, itineraries: DataFrame, days: int = 2, itinerary_rows: int | None = None) -> DataFrame:
    """3-2 as trips: best flight per leg joined into ``x -> y -> z``."""
    return best_two_leg_trips(flights, itineraries, days, itinerary_rows)


def requested_days(itineraries: DataFrame, days: int = 2) -> DataFrame:
    """The days (``flight_date``) of the requested legs."""
    return itinerary_legs(itineraries, days).select("flight_date").distinct()


def leg_pairs(flights: DataFrame, days: int = 2) -> DataFrame:
    """Legs file: each flight with its best onward flight ``days`` later.

    The legs are written once to the shared folder and both sides read that table.
    The second side (one flight per airport and day) is written and counted from
    its metadata: within the broadcast bound the flights are not shuffled, beyond
    it the join is salted. The smallest delays of the airports and days are found first, so
    that within that bound few flights are sorted for the best of them."""
    spark = flights.sparkSession
    legs = materialize(as_legs(flights), scratch_path(spark, "legs"))
    least = materialize(least_delays(legs), scratch_path(spark, "least-delays"))
    fits = least.count() <= broadcast_rows(least)
    second = materialize(best_second_legs(legs, least if fits else None), scratch_path(spark, "best-second-legs"))
    return connect_legs(legs, second, days, broadcast_second=second.count() <= broadcast_rows(second))


def origin_carrier_report(flights: DataFrame, k: int = TOP) -> DataFrame:
    """2-1 as text: (origin, carriers) with ``carrier(delay) ...`` best first."""
    return ranked_text(origin_carrier_best(flights, k), ["origin"], "rank", "carrier", "delay", alias="carriers")


def origin_carrier_pairs(flights: DataFrame, k: int = TOP) -> DataFrame:
    """2-1 as the ordered set of pairs: (origin, pairs) with
    ``[(delay, carrier), (delay, carrier), ...]`` best first."""
    return pairs_by_origin(origin_carrier_best(flights, k), "carrier")


def origin_dest_pairs(flights: DataFrame, k: int = TOP) -> DataFrame:
    """2-2 as the ordered set of pairs: (origin, pairs) with ``[(delay, dest), ...]`` best first."""
    return pairs_by_origin(origin_dest_best(flights, k), "dest")


def pairs_by_origin(ranked: DataFrame, name: str) -> DataFrame:
    """A per-origin ranking as ``[(delay, name), (delay, name), ...]``, best first."""
    listed = ranked_list(ranked, ["origin"], "rank", ["delay", name], alias="entries")
    return listed.select("origin", pairs_text("entries", "delay", name).alias("pairs"))


def airport_subset_report(flights: DataFrame, airports: list[str], k: int = TOP) -> DataFrame:
    """2-2 report lines that name one of ``airports``, as origin or among its
    ``k`` best destinations: (origin, destinations)."""
    listed = ranked_list(origin_dest_best(flights, k), ["origin"], "rank", ["dest", "delay"], alias="entries")
    wanted = F.col("origin").isin(airports) | F.exists("entries", lambda e: e["dest"].isin(airports))
    return listed.filter(wanted).select("origin", list_text("entries", "dest", "delay").alias("destinations"))


def route_means_by_load(flights: DataFrame, split_date: str) -> DataFrame:
    """2-4 for two loads in one pass: (load, origin, dest, delay), load 0 for
    flights before ``split_date`` and 1 for the rest."""
    cut = F.lit(split_date).cast("date")
    loads = flights.withColumn("load", F.when(F.col("flight_date") < cut, 0).otherwise(1))
    f = require(min_fields(loads, 9), "origin", "dest", "arr_delay")
    return mean_by(f, ["load", "origin", "dest"], "arr_delay", digits=2)


def serving_after_loads(means_by_load: DataFrame) -> DataFrame:
    """The 2-4 serving table after load 0, upserted with load 1 (a route's whole
    item is replaced)."""
    first = means_by_load.filter(F.col("load") == 0).drop("load")
    second = means_by_load.filter(F.col("load") == 1).drop("load")
    return upsert(first, second, ["origin", "dest"])


def key_value_lines(qid: str, answer: DataFrame) -> DataFrame:
    """An answer as ``(key, value)`` text, the layout of the stored outputs:
    ``airport -> flights``, ``airline -> delay``, ``origin -> name(delay) ...``,
    ``origin-dest -> delay``, ``origin/dest/date/time -> airline(delay)``."""
    s = lambda c: F.col(c).cast("string")
    if qid in ("1-1", "3-1"):
        return answer.select(s("airport").alias("key"), s("flights").alias("value"))
    if qid.startswith("1-2"):
        return answer.select(s("airline").alias("key"), s("delay").alias("value"))
    if qid in ("2-1", "2-2", "2-2-worst"):
        name = "carrier" if qid == "2-1" else "dest"
        return ranked_text(answer, ["origin"], "rank", name, "delay", alias="value").withColumnRenamed("origin", "key")
    if qid == "2-4":
        return answer.select(F.concat_ws("-", "origin", "dest").alias("key"), s("delay").alias("value"))
    if qid == "3-2":
        key = F.concat_ws("/", "origin", "dest", F.date_format("flight_date", "yyyy-MM-dd"), "dep_time")
        return answer.select(key.alias("key"), named_value("airline", "delay").alias("value"))
    raise ValueError(f"no text layout for {qid}")

