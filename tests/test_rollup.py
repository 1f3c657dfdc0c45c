"""Exact sums, rollups, positions, hub statistics and streaming state against plain computations."""

import itertools
import os
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from contrail.operators.aggregates import mean_by
from contrail.operators.legs import hub_pair_stats
from contrail.operators.numbering import with_position
from contrail.operators.rollup import BY_DAY, BY_ROUTE, ROLLUP_IDS, answer_from_rollup, merge, rollup
from contrail.plans import questions as Q
from contrail.sinks.keyed import KeyedTable
from contrail.sources.tables import flights_from_tables
from contrail.streaming.files import keep_route_means, table_stream
from tests.conftest import SF_SMALL


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_means_are_bit_equal_for_any_partitioning(spark):
    r = np.random.default_rng(1)
    values = [(f"k{i % 3}", float(v)) for i, v in enumerate(np.round(r.normal(size=3000) * 1e4, 3))] + [("k0", 1e11), ("k0", 0.1), ("n", None)]
    df = spark.createDataFrame(values, "k string, v double")
    got = {tuple(map(tuple, rows(mean_by(df.repartition(n), ["k"], "v")))) for n in (1, 7, 211)}
    assert len(got) == 1
    means = dict(next(iter(got)))
    for k in ("k0", "k1", "k2"):
        own = [Fraction(str(v)) for j, v in values if j == k]
        assert means[k] == pytest.approx(float(sum(own) / len(own)), rel=1e-15)
    assert means["n"] is None


def test_means_of_odd_values(spark):
    df = spark.createDataFrame([("a", float("nan")), ("a", 1.0), ("b", float("inf")), ("c", 1e300), ("c", 1e300), ("d", -0.125), ("d", -0.125)], "k string, v double")
    got = dict(rows(mean_by(df, ["k"], "v")))
    assert np.isnan(got["a"]) and got["b"] == float("inf") and got["c"] == 1e300 and got["d"] == -0.125


def odd_flights(spark):
    flights = flights_from_tables(spark, SF_SMALL)
    extra = flights.limit(300)
    blank = extra.withColumns({"origin": F.lit(None).cast("string"), "arr_delay": F.col("arr_delay") / 7})
    return flights.unionByName(blank).unionByName(extra.withColumn("carrier", F.lit(""))).unionByName(extra.withColumn("dep_time", F.lit(None).cast("string")))


def test_rollup_answers_equal_the_separate_questions(spark):
    flights = odd_flights(spark).cache()
    rolled = rollup(flights, BY_DAY).cache()
    direct = {
        "1-1": Q.popular_airports(flights), "3-1": Q.airports_by_popularity(flights), "1-2": Q.ontime_carriers(flights),
        "2-1": Q.origin_carrier_best(flights), "2-2": Q.origin_dest_best(flights), "2-2-worst": Q.origin_dest_worst(flights),
        "2-4": Q.route_mean_arrival(flights),
    }
    assert set(direct) == set(ROLLUP_IDS)
    cut = F.col("flight_date") < "1996-01-01"
    merged = merge(rollup(flights.filter(cut)), rollup(flights.filter(~cut)), by=BY_ROUTE)
    for qid, df in direct.items():
        assert rows(answer_from_rollup(qid, rolled)) == rows(df) == rows(answer_from_rollup(qid, merged)), qid


def test_several_questions_scan_the_input_once(spark, scratch, monkeypatch):
    from contrail.plans import runner

    made = []
    monkeypatch.setattr(runner, "rollup", lambda *a: made.append(a) or rollup(*a))
    monkeypatch.setattr(runner, "answer", lambda *a: pytest.fail("answered from the flights"))
    out = os.path.join(scratch, "answers")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        runner.main(["1-1", "2-1", "2-2", "2-4", "1-2", "3-1", "--tables", SF_SMALL, "--output", out])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(made) == 1
    assert rows(spark.read.parquet(os.path.join(out, "2-4"))) == rows(Q.route_mean_arrival(flights_from_tables(spark, SF_SMALL)))


def test_positions_in_the_full_order(spark):
    df = spark.range(5_000).select((F.col("id") * 7919 % 5003).alias("v"), F.concat(F.lit("n"), F.col("id")).alias("name"))
    got = sorted((r["position"], r["v"], r["name"]) for r in with_position(df.repartition(9), [("v", False), ("name", True)]).collect())
    want = sorted(((r["v"], r["name"]) for r in df.collect()), key=lambda x: (-x[0], x[1]))
    assert got == [(i + 1, v, n) for i, (v, n) in enumerate(want)]
    assert with_position(df.limit(0), [("v", True)]).count() == 0
    with pytest.raises(ValueError):
        with_position(df, [("v", True)], name="v")


def test_hub_statistics_equal_listed_pairs(spark):
    data = [("A", "H", 1.5), ("B", "H", 20.0), ("C", "H", None), ("H", "X", 16.0), ("H", "Y", -3.0), ("X", "A", 1.0), (None, "H", 4.0), ("H", None, 30.0)]
    df = spark.createDataFrame(data, "origin string, dest string, arr_delay double")
    pairs = {}
    for a, b in itertools.product(data, data):
        if a[1] and a[1] == b[0]:
            pairs.setdefault(a[1], []).append((a[2], b[2]))
    mean = lambda xs: sum(xs) / len(xs) if xs else None
    want = {
        h: (len(p), mean([x for x, _ in p if x is not None]), mean([y for _, y in p if y is not None]),
            sum(x is not None and y is not None and x >= 15 and y >= 15 for x, y in p))
        for h, p in pairs.items()
    }
    got = {r["hub"]: (int(r["pairs"]), r["first_delay"], r["second_delay"], int(r["both_late"])) for r in hub_pair_stats(df).collect()}
    assert got == {h: pytest.approx(v) for h, v in want.items()}


def test_stream_state_survives_a_restart_and_a_replayed_batch(spark, scratch):
    schema = "origin string, dest string, arr_delay double, dep_time string"
    add = lambda *r: spark.createDataFrame(list(r), schema).coalesce(1).write.mode("append").parquet(os.path.join(scratch, "in"))
    table = KeyedTable(spark, os.path.join(scratch, "t"), ["origin", "dest"])

    def run():
        stream = table_stream(spark, os.path.join(scratch, "in"), spark.createDataFrame([], schema).schema, max_files=1)
        keep_route_means(stream, table, os.path.join(scratch, "ck"), available_now=True).awaitTermination()

    add(("A", "B", 1.0, "0900"), ("A", "C", 9.0, "0900"))
    add(("A", "B", 2.0, "0900"), ("A", "B", None, None))
    run()
    assert rows(table.current()) == [("A", "B", 1.5), ("A", "C", 9.0)]
    add(("A", "B", 6.0, "0900"), ("Z", "C", 0.125, None))
    run()
    assert rows(table.current()) == [("A", "B", 3.0), ("A", "C", 9.0), ("Z", "C", 0.13)]
    batch = table.last_batch(next(iter(table.manifest(table.versions()[-1])["ledger"])))
    assert batch == 2
