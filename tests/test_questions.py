"""Hand-made clean rows for the behaviour decisions."""

import pytest
from pyspark.sql import functions as F

from contrail.operators.clean import clean_lookup
from contrail.plans import questions as Q
from contrail.sources.files import read_clean_flights
from tests.conftest import write_lines

EDGE = [
    # cancelled, trailing empties: not counted in 1-1 (R1)
    "2008-01-01|1|AA|10|1.00|ORD|LAX|||",
    # diverted: counted in 1-1, no arrival delay (R1)
    "2008-01-01|1|AA|11|0.00|ORD|LAX|5.00||0900",
    # cancelled with a departure delay: out of 2-1, kept in 2-2 (R6)
    "2008-01-01|1|AA|12|1.00|ORD|LAX|7.00||0910",
    # empty origin dropped (P14)
    "2008-01-01|1|AA|13|0.00||LAX|5.00|5.00|0900",
    # mean -0.125 on one route shows as -0.12 (R3)
    '2008-01-02|2|"UA"|1|0.00|"SFO"|"DEN"|-1.00|-1.00|0700',
    "2008-01-02|2|UA|2|0.00|SFO|DEN|0.75|0.75|0705",
    "2008-01-02|2|UA|3|0.00|SFO|DEN|1.00|0.50|0710",
    "2008-01-02|2|UA|4|0.00|SFO|DEN|-2.25|-0.75|0715",
]


@pytest.fixture
def edge(spark, scratch):
    write_lines(scratch, "part-0", EDGE)
    return read_clean_flights(spark, scratch)


def test_clean_read_unquotes_and_types(edge):
    r = edge.filter(F.col("flight_num") == "1").first()
    assert r.carrier == "UA" and r.origin == "SFO" and r.dep_delay == -1.0
    assert str(r.flight_date) == "2008-01-02"
    r = edge.filter(F.col("flight_num") == "10").first()
    assert r.dep_delay is None and r.arr_delay is None and r.dep_time is None


def test_popular_airports_r1(edge):
    got = {r.airport: r.flights for r in Q.airports_by_popularity(edge).collect()}
    # row 10 (nothing after dest) is out; rows 11, 12 count; row 13 has no origin
    assert got == {"ORD": 2, "LAX": 2, "SFO": 4, "DEN": 4}


def test_popular_airports_tie_order(edge):
    rows = Q.airports_by_popularity(edge).collect()
    assert [r.airport for r in rows] == ["SFO", "DEN", "ORD", "LAX"]  # ties by name descending


def test_route_mean_half_up_negative(edge):
    rows = {(r.origin, r.dest): r.delay for r in Q.route_mean_arrival(edge).collect()}
    # (-1 + 0.75 + 0.5 - 0.75) / 4 = -0.125 -> -0.12
    assert rows[("SFO", "DEN")] == -0.12
    assert ("ORD", "LAX") not in rows  # no arrival delay there


def test_cancelled_only_out_of_carrier_question(edge):
    carriers = {(r.origin, r.carrier): r.delay for r in Q.origin_carrier_means(edge).collect()}
    dests = {(r.origin, r.dest): r.delay for r in Q.origin_dest_means(edge).collect()}
    assert carriers[("ORD", "AA")] == 5.0  # only the diverted row
    assert dests[("ORD", "LAX")] == 6.0  # 5 and 7: the cancelled row is kept


def test_best_and_worst_differ(spark):
    rows = [("ORD", f"D{i:02d}", float(i)) for i in range(12)]
    flights = spark.createDataFrame(
        [("2008-01-01", 1, "AA", str(i), "0.00", o, d, v, v, "0900") for i, (o, d, v) in enumerate(rows)],
        "flight_date string, airline_id int, carrier string, flight_num string, cancelled string, "
        "origin string, dest string, dep_delay double, arr_delay double, dep_time string",
    ).withColumn("flight_date", F.col("flight_date").cast("date"))
    best = Q.origin_dest_best(flights).orderBy("rank").collect()
    worst = Q.origin_dest_worst(flights).orderBy("rank").collect()
    assert [r.dest for r in best] == [f"D{i:02d}" for i in range(10)]
    assert [r.dest for r in worst] == [f"D{i:02d}" for i in range(11, 1, -1)]
    assert [r.rank for r in best] == list(range(1, 11))


def test_ties_broken_by_name(spark):
    flights = spark.createDataFrame(
        [("O", "B", 1.0), ("O", "A", 1.0), ("O", "C", 0.5)], "origin string, carrier string, dep_delay double"
    )
    flights = flights.select(
        "origin", "carrier", "dep_delay", F.lit("0.00").alias("cancelled"), F.lit(None).cast("double").alias("arr_delay"),
        F.lit(None).cast("string").alias("dep_time"), F.lit("X").alias("dest"),
    )
    best = Q.origin_carrier_best(flights, k=2).orderBy("rank").collect()
    assert [r.carrier for r in best] == ["C", "A"]


def test_strict_and_lenient_numbers(spark, scratch):
    write_lines(scratch, "bad", ["2008-01-01|1|AA|14|0.00|ORD|LAX|x|y|0900"])
    lenient = read_clean_flights(spark, scratch, strict=False).first()
    assert lenient.dep_delay is None and lenient.arr_delay is None
    with pytest.raises(Exception):
        read_clean_flights(spark, scratch, strict=True).collect()


def test_lookup_repeat_and_comma(spark):
    raw = spark.createDataFrame(
        [("Code", "Description"), ('"ORD"', "Chicago, IL: O'Hare"), ('"ORD"', "Chicago, IL: O'Hare"), ("19690", "Hawaiian")],
        "code string, description string",
    )
    lk = {r.code: r.description for r in clean_lookup(raw).collect()}
    assert lk == {"ORD": "Chicago  IL: O'Hare", "19690": "Hawaiian"}


def test_named_airlines_unrounded(spark):
    flights = spark.createDataFrame(
        [(19690, 1.0), (19690, 2.0), (19690, 2.0), (20000, 0.5), (None, -9.0)], "airline_id int, arr_delay double"
    )
    airlines = spark.createDataFrame([("19690", "Hawaiian"), ("20000", "Other")], "code string, description string")
    rows = Q.ontime_airlines_named(flights, airlines).collect()
    assert [(r.airline, round(r.delay, 6)) for r in rows] == [("Other(20000)", 0.5), ("Hawaiian(19690)", 1.666667)]


def test_carriers_rounds_each_value_first(spark):
    flights = spark.createDataFrame(
        [("AA", 0.005, None), ("AA", 0.005, None), ("BB", 0.0, "0900")], "carrier string, arr_delay double, dep_time string"
    )
    rows = {r.airline: r.delay for r in Q.ontime_carriers(flights).collect()}
    assert rows == {"AA": 0.01, "BB": 0.0}


def test_reports_text(edge):
    rep = {r.origin: r.carriers for r in Q.origin_carrier_report(edge).collect()}
    assert rep["ORD"] == "AA(5)"
    assert rep["SFO"] == "UA(-0.37)"  # (-1 + 0.75 + 1 - 2.25) / 4 = -0.375
    sub = {r.origin: r.destinations for r in Q.airport_subset_report(edge, ["DEN"]).collect()}
    assert list(sub) == ["SFO"]


def test_key_value_lines(edge):
    kv = {r.key: r.value for r in Q.key_value_lines("2-4", Q.route_mean_arrival(edge)).collect()}
    assert kv == {"SFO-DEN": "-0.12"}
    kv = {r.key: r.value for r in Q.key_value_lines("2-1", Q.origin_carrier_best(edge)).collect()}
    assert kv["SFO"] == "UA(-0.37)"
    kv = {r.key: r.value for r in Q.key_value_lines("1-1", Q.popular_airports(edge)).collect()}
    assert kv["SFO"] == "4"


def test_named_airline_without_name_keeps_its_id(spark):
    flights = spark.createDataFrame([(19690, 1.0), (77777, 2.0)], "airline_id int, arr_delay double")
    airlines = spark.createDataFrame([("19690", "Hawaiian")], "code string, description string")
    rows = [tuple(r) for r in Q.ontime_airlines_named(flights, airlines).collect()]
    assert rows == [("Hawaiian(19690)", 1.0), ("(77777)", 2.0)]
