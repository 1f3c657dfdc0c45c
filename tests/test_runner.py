"""The command-line runner, driven through its argument list."""

import os

from contrail.plans.runner import main
from contrail.sinks.keyed import KeyedTable
from contrail.sinks.serving import SERVING_KEYS
from tests.conftest import SF_SMALL


def read_text(path):
    return "".join(open(os.path.join(path, f)).read() for f in sorted(os.listdir(path)) if f.startswith("part-"))


def test_runner_questions_to_text(spark, scratch):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        out = os.path.join(scratch, "answers")
        main(["1-1", "2-4", "--tables", SF_SMALL, "--output", out, "--write-as", "text"])
        top = read_text(os.path.join(out, "1-1")).splitlines()
        assert len(top) == 10 and all("\t" in line for line in top)
        routes = read_text(os.path.join(out, "2-4")).splitlines()
        assert routes and all("-" in line.split("\t")[0] for line in routes)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_runner_store_then_questions(spark, scratch):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        stored = os.path.join(scratch, "flights")
        main(["--tables", SF_SMALL, "--store", stored])
        out = os.path.join(scratch, "answers")
        main(["3-1", "1-2", "--input", stored, "--format", "parquet", "--output", out])
        assert spark.read.parquet(os.path.join(out, "3-1")).count() == 25  # every nation, as origin or destination
        assert spark.read.parquet(os.path.join(out, "1-2")).count() == 10
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_runner_old_layout(spark, scratch):
    from tests.conftest import write_lines

    src = os.path.join(scratch, "old")
    write_lines(src, "part-0", [
        "x|y|HA|HNL|OGG|z|0|-3.5|0|19690|Hawaiian",
        "x|y|HA|HNL|OGG|z|0|-2.5|0|19690|Hawaiian",
        "x|y|AA|ORD|HNL|z|0|4.0|0|19805|American",
        "x|y|AA|ORD|HNL|z|0|9.0|0||",  # neither airline id nor name: not counted
    ])
    out = os.path.join(scratch, "answers")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        main(["1-1", "1-2-named", "2-4", "--input", src, "--format", "old", "--output", out, "--write-as", "text"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert dict(line.split("\t") for line in read_text(os.path.join(out, "1-1")).splitlines()) == {
        "HNL": "3", "OGG": "2", "ORD": "1"}
    assert read_text(os.path.join(out, "1-2-named")).splitlines()[0] == "Hawaiian(19690)\t-3.0"
    routes = dict(line.split("\t") for line in read_text(os.path.join(out, "2-4")).splitlines())
    assert routes == {"HNL-OGG": "-3.0", "ORD-HNL": "4.0"}


def test_runner_raw_etl_then_question(spark, scratch):
    from contrail.schemas import RAW_FLIGHT_COLUMNS
    from contrail.sources.files import read_clean_flights
    from tests.conftest import write_lines
    from tests.test_sources_sinks import raw_line

    raw = os.path.join(scratch, "raw")
    header = ",".join(f'"{c}"' for c in RAW_FLIGHT_COLUMNS)
    write_lines(raw, "On_Time_2008_1.csv", [
        header,
        raw_line(FlightDate="2008-01-03", AirlineID="19393", Carrier="WN", FlightNum="1", Origin="IAD",
                 OriginCityName="Washington, DC", Dest="TPA", DepTime="0800", DepDelay="8.00", ArrDelay="-4.00",
                 Cancelled="0.00"),
        raw_line(FlightDate="2008-01-04", AirlineID="19393", Carrier="WN", FlightNum="2", Origin="TPA",
                 Dest="IAD", Cancelled="1.00"),
    ])
    lk = os.path.join(scratch, "lk")
    write_lines(lk, "L_AIRPORT.csv", ['"Code","Description"', '"IAD","Washington, DC: Dulles"'])
    write_lines(lk, "L_AIRLINE_ID.csv", ['"Code","Description"', '"19393","Southwest Airlines Co.: WN"'])
    clean = os.path.join(scratch, "clean")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        main(["--raw", os.path.join(raw, "On_Time_2008_*"), "--airports", os.path.join(lk, "L_AIRPORT.csv"),
              "--airlines", os.path.join(lk, "L_AIRLINE_ID.csv"), "--clean-out", clean])
        out = os.path.join(scratch, "answers")
        main(["3-1", "--input", clean, "--output", out, "--write-as", "text", "--legs-out", os.path.join(scratch, "legs")])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    rows = {r.flight_num: r for r in read_clean_flights(spark, clean).collect()}
    assert rows["1"].origin == "IAD" and rows["1"].arr_delay == -4.0 and rows["2"].cancelled == "1.00"
    assert sorted(read_text(os.path.join(out, "3-1")).splitlines()) == ["IAD\t1", "TPA\t1"]
    legs = read_text(os.path.join(scratch, "legs")).splitlines()
    assert len(legs) == 2 and all(line.count("|") == 21 for line in legs)  # 22 leg columns


def test_runner_publishes_serving_tables(spark, scratch):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        serve = os.path.join(scratch, "serving")
        main(["1-1", "2-2", "2-4", "3-2", "--tables", SF_SMALL, "--serve", serve])
        main(["1-1", "--tables", SF_SMALL, "--serve", serve])  # a second load replaces the items
        read = lambda qid, v: KeyedTable(spark, os.path.join(serve, qid), SERVING_KEYS[qid]).read(v)
        assert read("1-1", 1).count() == 10
        assert read("2-2", 0).columns == ["origin", "pairs"]
        assert read("2-2", 0).first()["pairs"].startswith("[(")
        routes = read("2-4", 0)
        assert routes.count() == routes.select("route").distinct().count() > 0
        assert read("3-2", 0).count() > 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_runner_old_layout_departure_delays(spark, scratch):
    from tests.conftest import write_lines

    src = os.path.join(scratch, "old")
    write_lines(src, "part-0", [
        "x|y|HA|HNL|OGG|z|0|2.004|0|19690|Hawaiian",
        "x|y|AA|HNL|ORD|z|0|2.001|0|19805|American",  # lower unrounded, though both show 2.0
    ])
    out = os.path.join(scratch, "answers")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        main(["2-1", "2-2-worst", "--input", src, "--format", "old", "--delay-field", "dep", "--output", out])
        best = spark.read.parquet(os.path.join(out, "2-1")).orderBy("rank").collect()
        assert [(r["carrier"], r["delay"]) for r in best] == [("AA", 2.0), ("HA", 2.0)]
        worst = spark.read.parquet(os.path.join(out, "2-2-worst")).orderBy("rank").collect()
        assert [r["dest"] for r in worst] == ["OGG", "ORD"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
