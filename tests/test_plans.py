"""The physical plans Spark picks for the operators."""

import contextlib
import io

from pyspark.sql import functions as F

from contrail.operators.aggregates import endpoint_counts
from contrail.operators.legs import best_flight_per_leg
from contrail.operators.rank import top_k_per_group, top_n
from contrail.plans import catalog
from tests.conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def sample(spark):
    return spark.createDataFrame(
        [("A", "B", 1.0, "0900", "X", "1"), ("A", "C", 2.0, "0910", "Y", "2"), ("B", "C", 3.0, "0920", "X", "3")],
        "origin string, dest string, arr_delay double, dep_time string, carrier string, flight_num string",
    ).withColumn("flight_date", F.current_date())


def test_top_n_is_take_ordered(spark):
    p = plan(top_n(sample(spark), [("arr_delay", False), ("origin", False)], 10))
    assert "TakeOrderedAndProject" in p


def test_top_k_per_group_has_group_limit(spark):
    p = plan(top_k_per_group(sample(spark), ["origin"], [("arr_delay", True)], 10))
    assert "WindowGroupLimit" in p


def test_counts_aggregate_before_shuffle(spark):
    p = plan(endpoint_counts(sample(spark)))
    tree = [line for line in p.splitlines() if "+- " in line]
    assert "partial_count" in p and sum("Generate" in line for line in tree) == 1


def test_best_leg_min_is_partial(spark):
    assert "partial_min" in plan(best_flight_per_leg(sample(spark)))


def test_only_needed_dimensions_are_joined(spark):
    p = plan(catalog.airports_top10(spark, SF_SMALL))
    assert "part.parquet" not in p and "lineitem.parquet" in p
    p = plan(catalog.carriers_ontime_top10(spark, SF_SMALL))
    assert "orders.parquet" not in p and "customer.parquet" not in p and "supplier.parquet" not in p


def test_scan_reads_only_needed_columns(spark):
    p = plan(catalog.route_mean_arrival(spark, SF_SMALL))
    line = [x for x in p.splitlines() if x.startswith("ReadSchema") and "l_orderkey" in x][0]
    assert "l_extendedprice" not in line and "l_tax" not in line and "l_discount" not in line


def test_request_table_is_broadcast_into_semi_join(spark):
    p = plan(catalog.leg_flight_min_delay(spark, SF_SMALL))
    assert "LeftSemi" in p and "BroadcastHashJoin" in p


def test_unused_unique_lookup_joins_are_removed(spark):
    from contrail.operators.clean import enrich
    from contrail.schemas import CLEAN_COLUMNS
    from contrail.sources.tables import airline_lookup_from_tables, airport_lookup_from_tables, flights_from_tables

    flights = flights_from_tables(spark, SF_SMALL)
    lookups = (airport_lookup_from_tables(spark, SF_SMALL), airline_lookup_from_tables(spark, SF_SMALL))
    with_names = plan(enrich(flights, *lookups))
    without = plan(enrich(flights, *lookups).select(*CLEAN_COLUMNS))
    assert "LeftOuter" in with_names
    assert "LeftOuter" not in without  # lookups unique by code: the joins add nothing and are dropped


def test_catalog_plans_stay_in_the_jvm_without_cross_joins(spark):
    from contrail.plans.catalog import QUERIES

    banned = ["BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas",
              "CartesianProduct", "BroadcastNestedLoopJoin"]
    for name, fn in QUERIES.items():
        p = plan(fn(spark, SF_SMALL))
        found = [b for b in banned if b in p]
        assert not found, (name, found)


def simple_tree(df) -> list[str]:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue().splitlines()


def test_requested_days_restrict_the_fact_scan_before_dimension_joins(spark):
    lines = simple_tree(catalog.leg_flight_min_delay(spark, SF_SMALL))
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    semi = [line for line in lines if "LeftSemi" in line and "l_shipdate" in line]
    order_join = [line for line in lines if "[l_orderkey" in line and "Join" in line]
    assert semi and order_join
    assert depth(semi[0]) > depth(order_join[0])  # the day filter sits below the order-key join


def test_leg_pairs_broadcasts_its_bounded_second_side(spark):
    p = plan(catalog.leg_pairs(spark, SF_SMALL))
    assert "LeftOuter" in p and "BroadcastHashJoin" in p
    assert not any("SortMergeJoin" in line and "LeftOuter" in line for line in p.splitlines())


def test_requested_days_reach_the_scan(spark):
    p = plan(catalog.leg_flight_min_delay(spark, SF_SMALL))
    assert "GreaterThanOrEqual(l_shipdate" in p and "LessThan(l_shipdate" in p
    assert "GreaterThanOrEqual(l_shipdate,ScalarSubquery" in p and "LessThan(l_shipdate,ScalarSubquery" in p


def test_building_the_3_2_queries_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    for name in ("leg_flight_min_delay", "two_leg_itineraries", "leg_serving", "leg_requests_all", "two_leg_trips_all"):
        spark.sparkContext.setJobGroup(f"plan-{name}", name)
        catalog.QUERIES[name](spark, SF_SMALL)
        assert len(tracker.getJobIdsForGroup(f"plan-{name}")) == 0, name
    spark.sparkContext.setJobGroup("other", "")


def test_unbounded_requests_filter_by_bloom_and_are_not_broadcast_by_hint(spark):
    df = catalog.leg_requests_all(spark, SF_SMALL)
    p = plan(df)
    assert "getbit" in p.lower() or "bit_get" in p.lower()
    assert "broadcast" not in df._jdf.queryExecution().analyzed().toString().lower()


def test_stored_flights_are_pruned_by_year_and_day(spark, scratch):
    from contrail.plans.etl import read_stored_flights, store_flights
    from contrail.sources.tables import flights_from_tables

    flights = flights_from_tables(spark, SF_SMALL)
    store_flights(flights, scratch, 4)
    days = ["1996-03-13", "1997-05-02"]
    some = read_stored_flights(spark, scratch, days)
    p = plan(some)
    assert "PartitionFilters: [" in p and "year" in p.split("PartitionFilters: [")[1].split("]")[0]
    assert "In(flight_date" in p
    assert some.columns == flights.columns
    assert some.count() == flights.filter(F.col("flight_date").cast("string").isin(days)).count()


def test_stored_flights_are_pruned_by_a_request_table(spark, scratch):
    from contrail.plans.etl import read_stored_flights, store_flights
    from contrail.sources.tables import flights_from_tables

    flights = flights_from_tables(spark, SF_SMALL)
    store_flights(flights, scratch, 4)
    days = spark.createDataFrame([("1996-03-13",), ("1996-05-02",), (None,)], "d string").select(F.col("d").cast("date").alias("flight_date"))
    some = read_stored_flights(spark, scratch, days)
    p = plan(some)
    years = next(line for line in p.splitlines() if line.startswith("PartitionFilters"))
    assert "year" in years and "ubquery" in years
    assert "GreaterThanOrEqual(flight_date,ScalarSubquery" in p
    want = flights.filter(F.col("flight_date").cast("string").isin("1996-03-13", "1996-05-02"))
    assert some.join(days, "flight_date", "left_semi").count() == want.count() <= some.count() < flights.count() / 50
    assert read_stored_flights(spark, scratch, days.limit(0)).count() == 0
