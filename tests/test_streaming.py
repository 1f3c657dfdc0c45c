"""A stream gives the same answer as the batch plan on the same lines."""

import os

from contrail.operators.parse import parse_lines
from contrail.plans import questions as Q
from contrail.schemas import CLEAN_FLIGHTS
from contrail.sinks.keyed import KeyedTable
from contrail.sources.files import read_clean_flights
from contrail.streaming.files import print_batches, text_stream, upsert_batches, write_files
from tests.conftest import write_lines

LINES = [
    "2008-01-01|1|AA|10|1.00|ORD|LAX|||",
    "2008-01-01|1|AA|11|0.00|ORD|LAX|5.00||0900",
    "2008-01-02|2|UA|1|0.00|SFO|DEN|-1.00|-1.00|0700",
    "2008-01-02|2|UA|2|0.00|SFO|ORD|0.75|0.75|0705",
]


def test_text_stream_parse_equals_batch(spark, scratch):
    src = os.path.join(scratch, "in")
    write_lines(src, "a.txt", LINES[:2])
    write_lines(src, "b.txt", LINES[2:])
    parsed = parse_lines(text_stream(spark, src), CLEAN_FLIGHTS, count_alias=None)
    q = write_files(parsed, os.path.join(scratch, "out"), os.path.join(scratch, "ck"), available_now=True)
    q.awaitTermination()
    streamed = spark.read.schema(CLEAN_FLIGHTS).parquet(os.path.join(scratch, "out"))
    batch = read_clean_flights(spark, src)
    assert sorted(streamed.collect()) == sorted(batch.collect())
    assert sorted(Q.airports_by_popularity(streamed).collect()) == sorted(Q.airports_by_popularity(batch).collect())


def test_console_sink_runs(spark, scratch):
    src = os.path.join(scratch, "in")
    write_lines(src, "a.txt", LINES)
    q = print_batches(text_stream(spark, src), os.path.join(scratch, "ck"), available_now=True)
    q.awaitTermination()
    assert q.lastProgress is not None and q.lastProgress["numInputRows"] == len(LINES)


def test_stream_upsert_into_keyed_table(spark, scratch):
    src = os.path.join(scratch, "in")
    write_lines(src, "a.txt", LINES)
    routes = Q.route_mean_arrival(parse_lines(text_stream(spark, src), CLEAN_FLIGHTS, count_alias=None))
    # aggregate per micro-batch inside foreachBatch: the keyed table keeps the newest value per route
    table = KeyedTable(spark, os.path.join(scratch, "serving"), ["origin", "dest"])
    lines = parse_lines(text_stream(spark, src), CLEAN_FLIGHTS, count_alias=None)
    q = upsert_batches(lines.select("origin", "dest", "arr_delay").dropna(), table, os.path.join(scratch, "ck"),
                       available_now=True)
    q.awaitTermination()
    got = sorted(tuple(r) for r in table.current().collect())
    assert got == [("SFO", "DEN", -1.0), ("SFO", "ORD", 0.75)]
    assert routes.isStreaming


def test_tail_directory_blocks_until_timeout(spark, scratch):
    from contrail.streaming.files import tail_directory

    src = os.path.join(scratch, "in")
    write_lines(src, "a.txt", LINES)
    q = tail_directory(spark, src, os.path.join(scratch, "ck"), interval="1 second", timeout_s=6)
    try:
        assert q.isActive or q.lastProgress is not None
    finally:
        q.stop()


def test_stream_command_parses_and_prints(spark, scratch, capsys):
    from contrail.streaming.__main__ import main

    src = os.path.join(scratch, "in")
    write_lines(src, "a.txt", LINES)
    q = main([src, "--parse", "--interval", "1 second", "--timeout", "15"])
    assert not q.isActive
    assert q.recentProgress and sum(p["numInputRows"] for p in q.recentProgress) == len(LINES)
