"""Two-leg operators on hand-made flights."""

import datetime as dt

from pyspark.sql import functions as F

from contrail.operators.legs import best_two_leg_trips, flight_min_delay, with_best_connection
from contrail.operators.upsert import first_per_key
from contrail.sources.tables import literal_table

D1 = dt.date(2008, 3, 4)
D3 = dt.date(2008, 3, 6)
COLS = "flight_date date, airline_id int, carrier string, flight_num string, cancelled string, origin string, " \
       "dest string, dep_delay double, arr_delay double, dep_time string"


def flights(spark):
    rows = [
        (D1, 1, "AA", "10", "0.00", "CMI", "ORD", 1.0, 5.0, "0700"),
        (D1, 1, "AA", "10", "0.00", "CMI", "ORD", 1.0, 3.0, "0700"),   # duplicate of one flight: min 3 (R18)
        (D1, 2, "UA", "20", "0.00", "CMI", "ORD", 0.0, -2.0, "0900"),  # best first leg
        (D3, 2, "UA", "30", "0.00", "ORD", "LAX", 0.0, 4.0, "1000"),
        (D3, 3, "DL", "40", "0.00", "ORD", "LAX", 0.0, 4.0, "1000"),   # same minute as UA 30 (R19)
        (D3, 3, "DL", "41", "0.00", "ORD", "LAX", 0.0, 1.0, "1500"),   # best second leg
        (D3, 3, "DL", "42", "0.00", "ORD", "SFO", 0.0, -9.0, "1600"),  # best from ORD that day, other dest
        (D1, 3, "DL", "50", "0.00", "CMI", "ORD", 0.0, None, "1100"),  # no arrival delay: not a leg
        (dt.date(2008, 3, 5), 3, "DL", "60", "0.00", "ORD", "LAX", 0.0, -20.0, "0800"),  # wrong day
    ]
    return spark.createDataFrame(rows, COLS)


def itineraries(spark):
    return literal_table(spark, [("CMI", "ORD", "LAX", D1)], ["x", "y", "z", "first_date"])


def test_flight_min_delay_per_flight(spark):
    got = sorted(tuple(r) for r in flight_min_delay(flights(spark), itineraries(spark)).select(
        "origin", "dest", "flight_date", "dep_time", "airline", "delay").collect())
    assert got == [
        ("CMI", "ORD", D1, "0700", "AA-10", 3.0),
        ("CMI", "ORD", D1, "0900", "UA-20", -2.0),
        ("ORD", "LAX", D3, "1000", "DL-40", 4.0),
        ("ORD", "LAX", D3, "1000", "UA-30", 4.0),
        ("ORD", "LAX", D3, "1500", "DL-41", 1.0),
    ]


def test_serving_items_keep_lowest_at_same_minute(spark):
    items = first_per_key(flight_min_delay(flights(spark), itineraries(spark)),
                           ["origin", "dest", "flight_date", "dep_time"], ["delay", "airline"])
    got = {(r.origin, r.dep_time): r.airline for r in items.collect()}
    assert got[("ORD", "1000")] == "DL-40" and len(got) == 4


def test_best_two_leg_trip(spark):
    trips = best_two_leg_trips(flights(spark), itineraries(spark)).collect()
    assert len(trips) == 1
    t = trips[0]
    assert (t.first_airline, t.first_delay, t.second_airline, t.second_delay, t.total_delay) == ("UA-20", -2.0, "DL-41", 1.0, -1.0)
    assert t.second_date == D3


def test_best_connection_left_outer(spark):
    out = with_best_connection(flights(spark)).filter(F.col("first_origin") == "CMI").collect()
    assert len(out) == 4  # every first leg kept, one partner at most
    for r in out:
        if r.first_flight_date == D1:
            assert r.second_origin == "ORD" and r.second_dest == "SFO" and r.second_arr_delay == -9.0
            assert r.second_arr_delay_minutes == 0.0 and r.second_arr_del15 == 0.0
    lax = with_best_connection(flights(spark)).filter(F.col("first_dest") == "LAX").collect()
    assert all(r.second_origin is None for r in lax)


def test_legs_take_raw_minutes_and_flags(spark):
    from contrail.operators.clean import project_legs
    from contrail.schemas import LEG_COLUMNS, RAW_FLIGHTS

    def raw(**kv):
        return tuple(kv.get(f.name) for f in RAW_FLIGHTS.fields)

    one = raw(FlightDate="2008-03-04", AirlineID="1", Carrier='"AA"', Origin='"CMI"', Dest='"ORD"', DepDelay="20.00",
              DepDelayMinutes="7.00", DepDel15="0.00", ArrDelay="-3.00", ArrDelayMinutes="2.00", ArrDel15="1.00")
    two = raw(FlightDate="2008-03-06", AirlineID="2", Carrier="UA", Origin="ORD", Dest="LAX", DepDelay="1.00",
              DepDelayMinutes="9.00", DepDel15="1.00", ArrDelay="4.00", ArrDelayMinutes="8.00", ArrDel15="1.00")
    header = tuple(f.name for f in RAW_FLIGHTS.fields)
    legs = project_legs(spark.createDataFrame([one, two, raw(FlightDate=None, Origin="X")], RAW_FLIGHTS))
    assert legs.columns == LEG_COLUMNS
    r = with_best_connection(legs).filter("first_origin = 'CMI'").first()
    # values that could not come from the delays
    assert (r.first_dep_delay_minutes, r.first_dep_del15, r.first_arr_delay_minutes, r.first_arr_del15) == (7.0, 0.0, 2.0, 1.0)
    assert (r.second_dest, r.second_dep_delay_minutes, r.second_dep_del15, r.second_arr_delay_minutes) == ("LAX", 9.0, 1.0, 8.0)
    assert project_legs(spark.createDataFrame([header, one], RAW_FLIGHTS), strict=False).count() == 1


def test_on_time_itineraries(spark):
    from contrail.sources.tables import itineraries_from_codes

    rows = itineraries_from_codes(spark).collect()
    assert len(rows) == 8 and (rows[0].x, rows[0].y, rows[0].z, rows[0].first_date) == ("CMI", "ORD", "LAX", D1)
    legs = flight_min_delay(flights(spark), itineraries_from_codes(spark)).count()
    assert legs == 5  # the CMI -> ORD -> LAX trip of 2008-03-04 is in the list


def test_salted_join_equals_plain_join(spark):
    plain = with_best_connection(flights(spark), salt_buckets=1)
    salted = with_best_connection(flights(spark), salt_buckets=8)
    assert salted.columns == plain.columns
    assert sorted(map(tuple, salted.collect())) == sorted(map(tuple, plain.collect()))


def test_salted_join_spreads_a_hot_key(spark):
    from contrail.operators.joins import salted_join

    left = spark.range(4000).selectExpr("'HUB' AS k", "id")
    right = spark.createDataFrame([("HUB", 1)], "k2 string, v int")
    out = salted_join(left, right, ["k"], ["k2"], "left", buckets=8)
    assert out.count() == 4000 and out.filter("v IS NULL").count() == 0
    per_salt = left.selectExpr("pmod(xxhash64(k, id), 8) AS s").groupBy("s").count().collect()
    assert len(per_salt) == 8 and max(r["count"] for r in per_salt) < 4000 / 4


def test_best_connections_make_the_request_list(spark):
    from contrail.operators.legs import best_connections

    rows = [tuple(r) for r in best_connections(flights(spark)).collect()]
    # into ORD on D1: -2 (CMI); out of ORD on D3: -9 (SFO, DL 42)
    assert rows == [("CMI", "ORD", "SFO", D1)]
    assert best_connections(flights(spark).limit(0)).count() == 0


def test_no_itineraries_give_no_legs(spark):
    from contrail.sources.tables import itineraries_from_codes

    empty = itineraries_from_codes(spark, [])
    assert flight_min_delay(flights(spark), empty).count() == 0


def test_best_second_legs_from_the_least_delays(spark):
    from contrail.operators.legs import best_second_legs, least_delays

    cols = ["flight_date", "airline_id", "carrier", "origin", "dest", "dep_delay", "arr_delay"]
    nan = float("nan")
    rows = [
        (D1, 1, "AA", "ORD", "LAX", 1.0, -5.0),
        (D1, 1, "AA", "ORD", "LAX", 1.0, -5.0),  # twice
        (D1, 2, "UA", "ORD", "JFK", None, -5.0),  # a tie: the unknown departure delay comes first
        (D1, 3, "UA", "ORD", "BOS", -9.0, 4.0),
        (D3, 1, "AA", "ORD", "LAX", 1.0, None),  # no arrival delay: no second leg
        (D1, 1, "AA", "LAX", "ORD", 2.0, 0.0),
        (D1, 1, "AA", "LAX", "BOS", 1.0, -0.0),
        (D3, 1, "AA", "LAX", "ORD", 3.0, nan),
        (D1, 1, "AA", None, "ORD", 0.0, 3.0),
        (None, 1, "AA", "JFK", "ORD", 0.0, 3.0),
        (None, 1, "AA", "JFK", "BOS", 0.0, 7.0),
    ]
    df = literal_table(spark, rows, cols).select(
        F.col("flight_date").cast("date"), "airline_id", "carrier", "origin", "dest", F.col("dep_delay").cast("double"), F.col("arr_delay").cast("double")
    )
    text = lambda out: sorted(map(repr, out.collect()))
    least = least_delays(df)
    assert least.count() == 5
    assert text(best_second_legs(df, least)) == text(best_second_legs(df)) and best_second_legs(df).count() == 5
    tie = best_second_legs(df, least).filter("origin = 'ORD'").first()
    assert (tie.dest, tie.dep_delay, tie.arr_delay) == ("JFK", None, -5.0)
