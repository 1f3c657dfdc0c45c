"""Flights as legs of two-leg trips.

None of these operators pairs all flights of a hub with each other: every
side that is joined is first reduced to one row per (airport, date) or per
requested leg with a partial-aggregated ``min`` over a struct, so the output
grows with the number of flights or of requests, not with their square.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions.scalars import delay_minutes, delayed_15, round_half_up, unquote
from contrail.operators.aggregates import mean_of_parts, sum_parts
from contrail.operators.filters import min_fields, require
from contrail.operators.joins import salted_join
from contrail.operators.runtime_filter import computed_once, semi_join
from contrail.schemas import LEG_COLUMNS

REQUEST_SALTS = 8  # parts of the trips that ask for one leg, where their number is not known


def flight_label(carrier: str = "carrier", flight_num: str = "flight_num") -> F.Column:
    """``carrier-flight`` without quotes."""
    return unquote(F.concat_ws("-", F.col(carrier), F.col(flight_num)))


def leg_candidates(flights: DataFrame) -> DataFrame:
    """Flights usable as a leg: origin, destination, arrival delay, date and
    departure time all present."""
    f = min_fields(flights, 9)
    return require(f, "origin", "dest", "arr_delay", "flight_date", "dep_time")


def itinerary_legs(itineraries: DataFrame, days: int = 2) -> DataFrame:
    """The requested legs ``(origin, dest, flight_date)`` of ``(x, y, z, first_date)``, one
    for each time that a leg is asked for."""
    leg = lambda a, b, day: F.struct(F.col(a).alias("origin"), F.col(b).alias("dest"), day.alias("flight_date"))
    day = F.col("first_date")
    return itineraries.select(F.inline(F.array(leg("x", "y", day), leg("y", "z", F.date_add(day, days)))))


def best_connections(flights: DataFrame, days: int = 2, n: int | None = 8) -> DataFrame:
    """A request list ``(x, y, z, first_date)`` made from the flights themselves: the
    best flight into each airport and day (smallest arrival delay, then origin)
    continued by the best one out of it ``days`` later (then destination), of
    which the ``n`` of the smallest total delay stay (then date, then airport; ``None``: all).

    Both roles of a flight go through one partial aggregate by (airport, day), so
    the flights are read once and not joined. The ``n`` best need only the delays for that
    (numbers, aggregated in a hash map); who flies them is then looked up among the flights
    of their few days.
    """
    cand = leg_candidates(flights)
    end = lambda place, day, other, role: F.struct(
        F.col(place).alias("y"), day.alias("first_date"), F.col("arr_delay").alias("delay"), F.col(other).alias("other"), F.lit(role).alias("role")
    )
    ends = F.inline(
        F.array(end("dest", F.col("flight_date"), "origin", 1), end("origin", F.date_sub("flight_date", days), "dest", 2))
    )
    if n is None:
        leg = F.struct("delay", "other")
        best = lambda role: F.min(F.when(F.col("role") == role, leg))
        met = cand.select(ends).groupBy("y", "first_date").agg(best(1).alias("a"), best(2).alias("b"))
        met = met.filter(F.col("a").isNotNull() & F.col("b").isNotNull())
        return met.select(F.col("a.other").alias("x"), "y", F.col("b.other").alias("z"), "first_date")
    least = lambda role: F.min(F.when(F.col("role") == role, F.col("delay")))
    met = cand.select(ends).groupBy("y", "first_date").agg(least(1).alias("d1"), least(2).alias("d2"))
    met = met.filter(F.col("d1").isNotNull() & F.col("d2").isNotNull())
    top = computed_once(met.orderBy(F.col("d1") + F.col("d2"), "first_date", "y").limit(n))
    on_days = top.select(F.explode(F.array(F.col("first_date"), F.date_add("first_date", days))).alias("flight_date"))
    near = cand.join(F.broadcast(on_days), "flight_date", "left_semi").select(ends)
    wanted = top.select("y", "first_date", F.inline(F.array(
        F.struct(F.col("d1").alias("delay"), F.lit(1).alias("role")), F.struct(F.col("d2").alias("delay"), F.lit(2).alias("role"))
    )))
    other = lambda role: F.min(F.when(F.col("role") == role, F.col("other")))
    found = near.join(F.broadcast(wanted), ["y", "first_date", "delay", "role"])
    named = found.groupBy("y", "first_date").agg(other(1).alias("x"), other(2).alias("z"))
    return computed_once(named.select("x", "y", "z", "first_date"))


def requested_leg_flights(flights: DataFrame, itineraries: DataFrame, days: int = 2, itinerary_rows: int | None = None) -> DataFrame:
    """Leg candidates on one of the requested legs. The requests may be a DataFrame of any
    size and no job runs here: a known number of them (``itinerary_rows``) is broadcast
    into a left semi join, otherwise the flights pass a Bloom filter of the requested legs
    first (:func:`contrail.operators.runtime_filter.semi_join`)."""
    legs = itinerary_legs(itineraries, days)
    known = 2 * itinerary_rows if itinerary_rows is not None else None
    return semi_join(leg_candidates(flights), legs, ["origin", "dest", "flight_date"], known_rows=known)


def flight_min_delay(flights: DataFrame, itineraries: DataFrame, days: int = 2, itinerary_rows: int | None = None) -> DataFrame:
    """For each flight on a requested leg, its smallest arrival delay over
    duplicate rows, rounded half-up: (origin, dest, flight_date, dep_time,
    airline, delay)."""
    cand = requested_leg_flights(flights, itineraries, days, itinerary_rows)
    return (
        cand.withColumn("airline", flight_label())
        .groupBy("origin", "dest", "flight_date", "dep_time", "airline")
        .agg(round_half_up(F.min("arr_delay")).alias("delay"))
    )


def best_flight_per_leg(cand: DataFrame) -> DataFrame:
    """One flight per (origin, dest, flight_date): smallest arrival delay,
    then earliest departure time, then smallest ``carrier-flight``.

    ``min`` of a struct is a partial aggregate (sort-based, as struct minima
    are not hash-aggregable, so it spills rather than failing): even a leg
    holding a third of all rows reaches the shuffle as one row per task, and
    no task ever holds a whole hot group.
    """
    best = F.min(F.struct(F.col("arr_delay"), F.col("dep_time"), flight_label().alias("airline")))
    return cand.groupBy("origin", "dest", "flight_date").agg(best.alias("best")).select(
        "origin",
        "dest",
        "flight_date",
        F.col("best.airline").alias("airline"),
        F.col("best.dep_time").alias("dep_time"),
        F.col("best.arr_delay").alias("delay"),
    )


def best_two_leg_trips(flights: DataFrame, itineraries: DataFrame, days: int = 2, itinerary_rows: int | None = None) -> DataFrame:
    """For each requested ``x -> y -> z`` trip, the best flight on each leg
    (second leg ``days`` after the first) and the total arrival delay.

    Each trip becomes two tagged leg rows that meet the per-leg best flights
    in one join (the best flights are computed once), and are folded back
    into one row per trip; trips missing a leg drop out.
    """
    cand = requested_leg_flights(flights, itineraries, days, itinerary_rows)
    best = best_flight_per_leg(cand)
    trip = ["x", "y", "z", "first_date"]
    end = lambda i, a, b, day: F.struct(
        F.lit(i).alias("_leg"), F.col(a).alias("origin"), F.col(b).alias("dest"), day.alias("flight_date")
    )
    ends = F.array(end(1, "x", "y", F.col("first_date")), end(2, "y", "z", F.date_add("first_date", days)))
    tagged = itineraries.select(*trip, F.inline(ends))
    leg_key = ["origin", "dest", "flight_date"]
    if itinerary_rows is not None:
        met = best.join(F.broadcast(tagged), leg_key, "inner")
    else:  # one leg may be asked for by a large share of the trips; there is one best flight per leg
        keyed = best.withColumnsRenamed({c: f"_{c}" for c in leg_key})
        met = salted_join(tagged, keyed, leg_key, [f"_{c}" for c in leg_key], "inner", REQUEST_SALTS)
    leg = lambda i: F.max(F.when(F.col("_leg") == i, F.struct("airline", "dep_time", "delay")))
    folded = met.groupBy(*trip).agg(leg(1).alias("l1"), leg(2).alias("l2"))
    folded = folded.filter(F.col("l1").isNotNull() & F.col("l2").isNotNull())
    return folded.select(
        *trip,
        F.col("l1.airline").alias("first_airline"), F.col("l1.dep_time").alias("first_dep_time"),
        round_half_up("l1.delay").alias("first_delay"),
        F.date_add(F.col("first_date"), days).alias("second_date"),
        F.col("l2.airline").alias("second_airline"), F.col("l2.dep_time").alias("second_dep_time"),
        round_half_up("l2.delay").alias("second_delay"),
        round_half_up(F.col("l1.delay") + F.col("l2.delay")).alias("total_delay"),
    )


LEG_DERIVED = {
    "dep_delay_minutes": lambda: delay_minutes("dep_delay"),
    "dep_del15": lambda: delayed_15("dep_delay"),
    "arr_delay_minutes": lambda: delay_minutes("arr_delay"),
    "arr_del15": lambda: delayed_15("arr_delay"),
}


def as_legs(flights: DataFrame) -> DataFrame:
    """The 11 leg columns. Minutes (early = 0) and 15-minute flags are taken as they
    are where ``flights`` holds them (:func:`contrail.operators.clean.project_legs`),
    and computed from the delays otherwise (the clean layout)."""
    held = set(flights.columns)
    return flights.select(
        *[F.col(c) if c in held or c not in LEG_DERIVED else LEG_DERIVED[c]().alias(c) for c in LEG_COLUMNS]
    )


def least_delays(flights: DataFrame) -> DataFrame:
    """The smallest arrival delay leaving each airport on each day: (origin, flight_date,
    arr_delay). A number, so it is aggregated in a hash map, without a sort."""
    return flights.groupBy("origin", "flight_date").agg(F.min("arr_delay").alias("arr_delay")).filter(F.col("arr_delay").isNotNull())


def best_second_legs(flights: DataFrame, least: DataFrame | None = None) -> DataFrame:
    """The best flight (smallest arrival delay, then departure delay, dest,
    carrier, airline id) leaving each airport on each day, as leg columns:
    one row per (origin, flight_date).

    The minimum of a struct sorts its input. With ``least`` (:func:`least_delays` of the same
    flights, which the caller has proven small) only flights of that delay reach it: the
    others leave where they are read, by a broadcast join."""
    legs = as_legs(flights)
    if least is not None:
        small = least.select(*[F.col(c).alias(f"_{c}") for c in least.columns])
        first = F.col("origin").eqNullSafe(F.col("_origin")) & F.col("flight_date").eqNullSafe(F.col("_flight_date"))
        legs = legs.join(F.broadcast(small), first & (F.col("arr_delay") == F.col("_arr_delay")), "left_semi")
    order = ["arr_delay", "dep_delay", "dest", "carrier", "airline_id", *LEG_DERIVED]
    # Flights without an arrival delay give a null candidate, which min skips.
    candidate = F.when(F.col("arr_delay").isNotNull(), F.struct(*[F.col(c) for c in order]))
    best = legs.groupBy("origin", "flight_date").agg(F.min(candidate).alias("b")).filter(F.col("b").isNotNull())
    return best.select(*[F.col(f"b.{c}" if c in order else c).alias(c) for c in LEG_COLUMNS])


def connect_legs(
    flights: DataFrame, second_legs: DataFrame, days: int = 2, salt_buckets: int | None = None, broadcast_second: bool = False
) -> DataFrame:
    """Left-join every flight (first leg) to the one second leg leaving its
    destination ``days`` later, with ``first_``/``second_`` column prefixes.

    ``broadcast_second`` (the caller has proven the second side small) makes
    it a broadcast join: the flights are not shuffled at all. Otherwise the
    join is salted over ``salt_buckets`` (1 = plain join, left to AQE; default: the
    shuffle partitions)."""
    first = as_legs(flights).select(*[F.col(c).alias(f"first_{c}") for c in LEG_COLUMNS])
    second = second_legs.select(*[F.col(c).alias(f"second_{c}") for c in LEG_COLUMNS])
    if broadcast_second or salt_buckets == 1:
        cond = (F.col("first_dest") == F.col("second_origin")) & (
            F.col("second_flight_date") == F.date_add(F.col("first_flight_date"), days)
        )
        return first.join(F.broadcast(second) if broadcast_second else second, cond, "left")
    # a hub's day may hold a large share of all first legs: salt that side
    return salted_join(
        first, second,
        ["first_dest", F.date_add(F.col("first_flight_date"), days)],
        ["second_origin", "second_flight_date"],
        "left", salt_buckets,
    )


def with_best_connection(flights: DataFrame, days: int = 2, salt_buckets: int | None = None) -> DataFrame:
    """Every flight (first leg) with the best onward flight (second leg) that
    leaves its destination ``days`` later, or nulls when there is none; see
    :func:`connect_legs`, which this calls with the second legs of ``flights``.
    """
    return connect_legs(flights, best_second_legs(flights), days, salt_buckets)


def hub_pair_stats(flights: DataFrame) -> DataFrame:
    """Statistics of all two-leg pairs by hub (a flight into it with any flight out of it, no
    date condition) without listing a pair: (hub, pairs, first_delay, second_delay, total_delay,
    both_late).

    A pair is a row of each side, so every statistic comes from one aggregate row per side and
    hub: counts multiply, and the mean over pairs of one side's value is that side's mean. The pairs of a
    hub grow with the square of its flights, this with the hubs. ``first_delay`` and
    ``second_delay`` are mean arrival delays over pairs where they are known, ``total_delay`` the mean of their
    sum, ``both_late`` the pairs of which each leg is 15 minutes late or more.
    """
    def side(place: str, name: str) -> DataFrame:
        known = require(flights, place)
        return known.groupBy(F.col(place).alias("hub")).agg(
            F.count(F.lit(1)).cast("decimal(18,0)").alias(f"{name}_rows"),
            F.sum(delayed_15("arr_delay")).cast("decimal(18,0)").alias(f"{name}_late"),
            *sum_parts(F.col("arr_delay"), name),
        )

    both = side("dest", "a").join(side("origin", "b"), "hub")  # one row per hub on either side
    zero = F.lit(0).cast("decimal(18,0)")
    return both.select(
        "hub",
        (F.col("a_rows") * F.col("b_rows")).cast("decimal(38,0)").alias("pairs"),
        mean_of_parts("a").alias("first_delay"),
        mean_of_parts("b").alias("second_delay"),
        (mean_of_parts("a") + mean_of_parts("b")).alias("total_delay"),
        (F.coalesce("a_late", zero) * F.coalesce("b_late", zero)).cast("decimal(38,0)").alias("both_late"),
    )
