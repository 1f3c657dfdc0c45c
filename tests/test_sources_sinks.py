"""File sources and sinks, written to a scratch folder and read back."""

import os

from pyspark.sql import functions as F

from contrail.operators.clean import clean_lookup, enrich, project_clean
from contrail.operators.upsert import upsert
from contrail.schemas import CLEAN_COLUMNS, RAW_FLIGHT_COLUMNS
from contrail.sinks.files import write_delimited, write_key_value, write_table
from contrail.sinks.keyed import KeyedTable
from contrail.sources.files import (
    read_clean_flights,
    read_key_value,
    read_lookup,
    read_old_clean_flights,
    read_raw_flights,
)
from tests.conftest import write_lines


def raw_line(**kv):
    vals = {c: "" for c in RAW_FLIGHT_COLUMNS}
    vals.update(kv)
    out = []
    for c in RAW_FLIGHT_COLUMNS:
        v = vals[c]
        out.append(f'"{v}"' if ("," in v or c in ("Origin", "Dest", "Carrier", "UniqueCarrier")) and v else v)
    return ",".join(out)


def test_raw_csv_quote_aware_and_clean(spark, scratch):
    header = ",".join(f'"{c}"' for c in RAW_FLIGHT_COLUMNS)
    lines = [
        header,
        raw_line(FlightDate="2008-01-03", AirlineID="19393", Carrier="WN", FlightNum="335", Origin="IAD",
                 OriginCityName="Washington, DC", Dest="TPA", DestCityName="Tampa, FL", DepTime="2003",
                 DepDelay="8.00", ArrDelay="-14.00", Cancelled="0.00"),
        raw_line(FlightDate="2008-01-03", AirlineID="19393", Carrier="WN", FlightNum="336", Origin="IAD",
                 Dest="TPA", Cancelled="1.00"),
    ]
    write_lines(scratch, "On_Time_2008_1.csv", lines)
    write_lines(scratch, "On_Time_2008_2.csv", [header, raw_line(FlightDate="2008-02-01", Origin="X", Dest="Y")])
    raw = read_raw_flights(spark, scratch, file_glob="On_Time_2008_1*")
    assert raw.count() == 2
    r = raw.first()
    assert r.OriginCityName == "Washington, DC" and r.Origin == "IAD"
    clean = project_clean(raw)
    assert clean.columns == CLEAN_COLUMNS
    rows = {r.flight_num: r for r in clean.collect()}
    assert rows["335"].dep_delay == 8.0 and rows["335"].arr_delay == -14.0 and rows["335"].dep_time == "2003"
    assert rows["336"].cancelled == "1.00" and rows["336"].arr_delay is None


def test_lookup_file_and_enrich(spark, scratch):
    write_lines(scratch, "L_AIRPORT.csv", ['"Code","Description"', '"IAD","Washington, DC: Dulles"', '"TPA","Tampa, FL"'])
    ap = clean_lookup(read_lookup(spark, os.path.join(scratch, "L_AIRPORT.csv")))
    assert {r.code: r.description for r in ap.collect()} == {"IAD": "Washington  DC: Dulles", "TPA": "Tampa  FL"}
    al = spark.createDataFrame([("19393", "Southwest"), ("19393", "Southwest dup")], "code string, description string")
    flights = spark.createDataFrame(
        [("2008-01-03", 19393, "IAD", "TPA"), ("2008-01-03", 1, "IAD", "ZZZ")],
        "flight_date string, airline_id int, origin string, dest string",
    ).withColumn("flight_date", F.col("flight_date").cast("date"))
    out = {r.dest: r for r in enrich(flights, ap, al).collect()}
    assert len(out) == 2
    assert out["TPA"].origin_name == "Washington  DC: Dulles" and out["TPA"].airline_name == "Southwest"
    assert out["ZZZ"].dest_name is None and out["ZZZ"].airline_name is None


def test_pipe_round_trip(spark, scratch):
    rows = [("2008-01-01", 1, "AA", "10", "1.00", "ORD", "LAX", None, None, None),
            ("2008-01-01", 1, "AA", "11", "0.00", "ORD", "LAX", 5.0, None, "0900")]
    df = spark.createDataFrame(rows, ",".join(f"{c} {t}" for c, t in zip(CLEAN_COLUMNS, [
        "string", "int", "string", "string", "string", "string", "string", "double", "double", "string"])))
    df = df.withColumn("flight_date", F.col("flight_date").cast("date"))
    out = os.path.join(scratch, "clean")
    write_delimited(df, out)
    text = "".join(open(os.path.join(out, f)).read() for f in sorted(os.listdir(out)) if f.startswith("part"))
    assert "2008-01-01|1|AA|10|1.00|ORD|LAX|||" in text
    back = read_clean_flights(spark, out)
    assert sorted(back.collect()) == sorted(df.collect())


def test_old_layout(spark, scratch):
    write_lines(scratch, "old", ["x|y|HA|\"HNL\"|OGG|z|0|-3.5|0|19690|Hawaiian Airlines Inc.: HA"])
    r = read_old_clean_flights(spark, scratch).first()
    assert (r.carrier, r.origin, r.dest, r.arr_delay, r.airline_id) == ("HA", "HNL", "OGG", -3.5, 19690)


def test_key_value_round_trip(spark, scratch):
    df = spark.createDataFrame([('"PHX"', 2266969)], "k string, v bigint")
    out = os.path.join(scratch, "kv")
    write_key_value(df, "k", "v", out)
    r = read_key_value(spark, out).first()
    assert (r.key, r.value) == ('"PHX"', "2266969")


def test_write_table_partitioned(spark, scratch):
    df = spark.createDataFrame([(2008, "a"), (2009, "b")], "year int, v string")
    out = os.path.join(scratch, "t")
    write_table(df, out, partition_by=["year"])
    assert {"_SUCCESS", "year=2008", "year=2009"} <= set(os.listdir(out))
    assert spark.read.parquet(out).filter("year = 2009").first().v == "b"


def test_upsert_replaces_whole_item_and_keeps_lowest(spark):
    cur = spark.createDataFrame([("A", 1.0, "x"), ("B", 2.0, "y")], "k string, delay double, airline string")
    upd = spark.createDataFrame([("B", 5.0, "q"), ("B", 3.0, "p"), ("C", 4.0, "z")], "k string, delay double, airline string")
    got = sorted(tuple(r) for r in upsert(cur, upd, ["k"], order=["delay", "airline"]).collect())
    assert got == [("A", 1.0, "x"), ("B", 3.0, "p"), ("C", 4.0, "z")]


def test_keyed_table_versions(spark, scratch):
    t = KeyedTable(spark, os.path.join(scratch, "serving"), ["k"])
    assert t.current() is None
    t.upsert(spark.createDataFrame([("A", 1), ("B", 2)], "k string, v int"))
    t.upsert(spark.createDataFrame([("B", 3)], "k string, v int"))
    assert t.versions() == [0, 1]
    assert sorted(tuple(r) for r in t.current().collect()) == [("A", 1), ("B", 3)]
    # the first batch of a stream on a loaded table is a version of its own, a replay of it isn't
    batch = spark.createDataFrame([("B", 9)], "k string, v int")
    assert t.upsert(batch, batch=("s", 0)) == 2
    assert t.upsert(batch, batch=("s", 0)) == 2 and t.versions() == [0, 1, 2]
    assert t.upsert(batch, batch=("another", 0)) == 3
    assert sorted(tuple(r) for r in t.current().collect()) == [("A", 1), ("B", 9)]


def test_keyed_table_holds_one_row_per_key(spark, scratch):
    t = KeyedTable(spark, os.path.join(scratch, "serving"), ["k"])
    for _ in range(2):
        t.upsert(spark.createDataFrame([("A", None, "x"), ("A", 1.0, "y"), ("B", 2.0, "z")], "k string, d double, n string"))
        assert sorted(tuple(r) for r in t.current().collect()) == [("A", 1.0, "y"), ("B", 2.0, "z")]


def test_delimited_text_keeps_values(spark, scratch):
    from contrail.sources.files import read_key_value

    rows = [("a|b", " x "), ('say "hi"', "tab\tin"), ("plain", "|")]
    df = spark.createDataFrame(rows, "key string, value string")
    write_key_value(df, "key", "value", f"{scratch}/kv")
    assert sorted(tuple(r) for r in read_key_value(spark, f"{scratch}/kv").collect()) == sorted(rows)
    write_delimited(df, f"{scratch}/pipe")
    back = spark.read.schema("key string, value string").option("sep", "|").option("escape", '"').csv(f"{scratch}/pipe")
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows)


def test_glob_input_is_sized(spark, scratch):
    from contrail.session import input_bytes

    for name in ("a_1.csv", "a_2.csv", "b_1.csv"):
        write_lines(scratch, name, ["x" * 99])
    assert input_bytes(spark, f"{scratch}/a_*.csv") == 200


def test_corrupt_lines_kept_aside(spark, scratch):
    write_lines(scratch, "mixed", ["2008-01-01|1|AA|11|0.00|ORD|LAX|5.00||0900", "2008-01-01|1|AA|14|0.00|ORD|LAX|x|y|0900"])
    df = read_clean_flights(spark, scratch, corrupt_col="_corrupt").cache()
    bad = df.filter(F.col("_corrupt").isNotNull()).collect()
    assert len(bad) == 1 and bad[0]._corrupt.startswith("2008-01-01|1|AA|14")
    assert df.filter(F.col("_corrupt").isNull()).count() == 1


def test_size_for_input(spark):
    from contrail.session import PARTITION_BYTES, input_bytes, size_for_input

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert input_bytes(spark, "/root/testdata/sf0.001/lineitem.parquet") > 0
        assert size_for_input(spark, 1000 * PARTITION_BYTES) == 1000
        assert spark.conf.get("spark.sql.shuffle.partitions") == "1000"
        assert size_for_input(spark, 10) == spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_store_flights_round_trip(spark, scratch):
    from contrail.plans.etl import read_stored_flights, store_flights
    from contrail.sources.tables import flights_from_tables

    flights = flights_from_tables(spark, "/root/testdata/sf0.001")
    path = os.path.join(scratch, "stored")
    store_flights(flights, path, 4)
    assert any(d.startswith("year=") for d in os.listdir(path))
    back = read_stored_flights(spark, path)
    assert back.columns == flights.columns
    assert back.exceptAll(flights).count() == 0 and flights.exceptAll(back).count() == 0


def test_prefix_glob_matches_months_1_and_10_to_12(spark, scratch):
    header = ",".join(RAW_FLIGHT_COLUMNS)
    for m in (1, 2, 10, 11, 12):
        write_lines(scratch, f"On_Time_On_Time_Performance_2008_{m}.csv",
                    [header, raw_line(FlightDate=f"2008-{m:02d}-01", Origin="A", Dest="B", FlightNum=str(m))])
    got = sorted(int(r.FlightNum) for r in read_raw_flights(spark, os.path.join(scratch, "On_Time_On_Time_Performance_2008_1*")).collect())
    assert got == [1, 10, 11, 12]


def test_quoted_empty_field_is_missing(spark, scratch):
    write_lines(scratch, "q", ['2008-01-01|1|AA|1|0.00|""|LAX|5.00|5.00|0900'])
    r = read_clean_flights(spark, scratch).first()
    from contrail.plans import questions as Q

    assert not r.origin  # empty or null after the quote-aware read
    df = read_clean_flights(spark, scratch)
    assert Q.airport_traffic(df).count() == 0 and Q.route_mean_arrival(df).count() == 0


def test_keyed_table_ignores_incomplete_version(spark, scratch):
    base = os.path.join(scratch, "serving")
    t = KeyedTable(spark, base, ["k"])
    t.upsert(spark.createDataFrame([("A", 1)], "k string, v int"))
    # a job lost half-way: data files in place, no _SUCCESS marker
    import shutil

    side = os.path.join(scratch, "side")
    spark.createDataFrame([("A", 99)], "k string, v int").write.parquet(side)
    os.makedirs(os.path.join(base, "v=1"))
    for f in os.listdir(side):
        if f.startswith("part-"):
            shutil.copy(os.path.join(side, f), os.path.join(base, "v=1", f))
    assert t.versions() == [0]
    assert [tuple(r) for r in t.current().collect()] == [("A", 1)]
    # the rerun writes a fresh version on top of the last complete one
    assert t.upsert(spark.createDataFrame([("B", 2)], "k string, v int")) == 1
    assert sorted(tuple(r) for r in t.current().collect()) == [("A", 1), ("B", 2)]


def test_enrich_salted_fallback_equals_broadcast(spark):
    from contrail.operators.clean import clean_lookup
    from contrail.sources.tables import airline_lookup_from_tables, airport_lookup_from_tables, flights_from_tables

    flights = flights_from_tables(spark, "/root/testdata/sf0.001")
    ap = clean_lookup(airport_lookup_from_tables(spark, "/root/testdata/sf0.001"))
    al = clean_lookup(airline_lookup_from_tables(spark, "/root/testdata/sf0.001"))
    broadcast = enrich(flights, ap, al, lookups_unique=True)
    salted = enrich(flights, ap, al, max_lookup_rows=0, lookups_unique=True)  # every lookup "too large"
    from tests.test_plans import simple_tree

    outer = [line for line in simple_tree(salted) if "LeftOuter" in line and "_code" in line]
    assert len(outer) == 3 and all("_salt" in line for line in outer)  # the three lookup joins are salted
    assert salted.exceptAll(broadcast).count() == 0 and broadcast.exceptAll(salted).count() == 0
    assert salted.count() == flights.count()


def test_bad_raw_lines_are_set_aside_with_file_and_reason(spark, scratch):
    from pyspark.sql import Observation

    from contrail.plans.etl import clean_from_raw
    from contrail.schemas import RAW_FLIGHT_COLUMNS
    from contrail.sources.files import bad_lines, good_lines, observed, read_raw_marked

    def line(**values):
        return ",".join('"' + values.get(c, "") + '"' for c in RAW_FLIGHT_COLUMNS)

    head = ",".join(f'"{c}"' for c in RAW_FLIGHT_COLUMNS)
    fine = line(FlightDate="2008-01-01", Origin="ORD", OriginCityName="Chicago, IL", ArrDelay="4.00", AirlineID="19805")
    bare = line(FlightDate="2008-01-02", Origin="LAX")
    bad = {
        "short": ("fields", "2008-01-01,AA"),
        "long": ("fields", fine + ',"x"'),
        "date": ("date", line(FlightDate="2008-02-30", Origin="ORD")),
        "undated": ("date", line(Origin="ORD")),
        "number": ("number", line(FlightDate="2008-01-01", ArrDelay="late")),
    }
    write_lines(scratch, "one.csv", [head, fine, *[x for _, x in bad.values()]])
    write_lines(scratch, "two.csv", [head, bare])
    seen = Observation("lines")
    marked = observed(read_raw_marked(spark, scratch), seen)
    aside = bad_lines(marked).collect()
    assert seen.get == {"lines": 7, "good": 2, "fields": 2, "date": 2, "number": 1}
    assert sorted((r["reason"], r["line"]) for r in aside) == sorted(bad.values()) and all(r["file"].endswith("one.csv") for r in aside)
    assert sorted(r["Origin"] for r in good_lines(marked).collect()) == ["LAX", "ORD"]
    out = scratch + "-rejects"
    kept = clean_from_raw(spark, scratch, rejects=out)
    assert sorted((r["origin"], r["arr_delay"]) for r in kept.collect()) == [("LAX", None), ("ORD", 4.0)]
    assert spark.read.parquet(out).count() == 5


def test_a_marked_line_is_parsed_once(spark, scratch):
    from contrail.sources.files import read_raw_marked

    write_lines(scratch, "one.csv", ["", "2008-01-01"])
    marked = read_raw_marked(spark, scratch)
    assert marked._jdf.queryExecution().optimizedPlan().toString().count("from_csv(") == 1
    assert sorted((r["_line"], r["_reason"]) for r in marked.collect()) == [("", "date"), ("2008-01-01", "fields")]


def test_the_marked_table_of_raw_set_aside_is_small(spark):
    import glob

    from contrail.plans.catalog import raw_set_aside
    from contrail.session import checkpoint_dir
    from tests.conftest import SF_SMALL

    folders = lambda: set(glob.glob(f"{checkpoint_dir(spark).removeprefix('file:')}/contrail/raw-faulty-*"))
    before = folders()
    raw_set_aside(spark, SF_SMALL)
    (path,) = folders() - before
    assert all(".zstd." in f for f in glob.glob(f"{path}/marked/part-*"))
    plain = glob.glob(f"{path}/flights/part-*.txt")
    assert glob.glob(f"{path}/flights/part-*.txt.lz4") and spark.read.text(plain).count() == 1  # the header alone


def test_compressed_text_files_are_bounded(spark, scratch, monkeypatch):
    import glob

    from contrail.sinks import files

    monkeypatch.setattr(files, "FILE_ROWS", 10)
    df = spark.range(0, 45, 1, 2).select(F.col("id").cast("string").alias("a"), F.lit('x|"y"').alias("b"))
    write_delimited(df, f"{scratch}/out", compressed=True)
    parts = glob.glob(f"{scratch}/out/part-*")
    assert len(parts) == 6 and all(p.endswith(".lz4") for p in parts)
    back = spark.read.option("sep", "|").option("escape", '"').csv(f"{scratch}/out")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_texts_between_steps_are_compressed(spark):
    import glob

    from contrail.plans.catalog import etl_roundtrip, leg_pairs_raw
    from contrail.session import checkpoint_dir
    from tests.conftest import SF_SMALL

    root = checkpoint_dir(spark).removeprefix("file:")
    texts = lambda: set(glob.glob(f"{root}/contrail/etl-*/On_Time_1/part-*") + glob.glob(f"{root}/contrail/etl-*/clean/part-*")
                        + glob.glob(f"{root}/contrail/raw-legs-*/part-*"))
    before = texts()
    etl_roundtrip(spark, SF_SMALL)
    leg_pairs_raw(spark, SF_SMALL)
    new = texts() - before
    assert len({os.path.dirname(p) for p in new}) == 3 and all(p.endswith(".csv.lz4") for p in new)
