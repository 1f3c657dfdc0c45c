"""Operators against plain-Python brute force on random small inputs."""

import math
from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from contrail.operators.upsert import upsert
from contrail.plans import questions as Q

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
AIRPORTS = ["A", "B", "C", "D"]
CARRIERS = ["AA", "UA", "DL"]
SCHEMA = ("origin string, dest string, carrier string, cancelled string, dep_delay double, "
          "arr_delay double, dep_time string")

flight = st.tuples(
    st.sampled_from(AIRPORTS + [""]),
    st.sampled_from(AIRPORTS),
    st.sampled_from(CARRIERS),
    st.sampled_from(["0.00", "1.00"]),
    st.one_of(st.none(), st.integers(-30, 30).map(lambda v: v / 8)),
    st.one_of(st.none(), st.integers(-30, 30).map(lambda v: v / 8)),
    st.one_of(st.none(), st.just("0900")),
)


def half_up(x):
    return math.floor(x * 100 + 0.5) / 100


@SETTINGS
@given(st.lists(flight, min_size=1, max_size=40))
def test_traffic_matches_brute_force(spark, rows):
    got = {r.airport: r.flights for r in Q.airport_traffic(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = Counter()
    for o, d, _c, _x, _dd, ad, t in rows:
        if (ad is not None or t is not None) and o and d:
            want[o] += 1
            want[d] += 1
    assert got == dict(want)


@SETTINGS
@given(st.lists(flight, min_size=1, max_size=40), st.integers(1, 3))
def test_carrier_best_k_matches_brute_force(spark, rows, k):
    got = sorted((r.origin, r.rank, r.carrier, r.delay) for r in Q.origin_carrier_best(spark.createDataFrame(rows, SCHEMA), k).collect())
    groups = defaultdict(list)
    for o, _d, c, x, dd, _ad, _t in rows:
        if o and dd is not None and x != "1.00":
            groups[(o, c)].append(dd)
    per_origin = defaultdict(list)
    for (o, c), v in groups.items():
        per_origin[o].append((half_up(sum(v) / len(v)), c))
    want = []
    for o, lst in per_origin.items():
        for i, (delay, c) in enumerate(sorted(lst)[:k], start=1):
            want.append((o, i, c, delay))
    assert got == sorted(want)


@SETTINGS
@given(st.lists(flight, min_size=1, max_size=40))
def test_route_means_match_brute_force(spark, rows):
    got = {(r.origin, r.dest): r.delay for r in Q.route_mean_arrival(spark.createDataFrame(rows, SCHEMA)).collect()}
    groups = defaultdict(list)
    for o, d, _c, _x, _dd, ad, _t in rows:
        if o and d and ad is not None:
            groups[(o, d)].append(ad)
    assert got == {k: half_up(sum(v) / len(v)) for k, v in groups.items()}


@SETTINGS
@given(
    st.dictionaries(st.sampled_from("abcdef"), st.integers(0, 9), max_size=6),
    st.lists(st.tuples(st.sampled_from("abcdefg"), st.integers(0, 9)), max_size=10),
)
def test_upsert_matches_dict(spark, current, updates):
    cur = spark.createDataFrame(sorted(current.items()) or [("z", 0)], "k string, v int")
    if not current:
        cur = cur.limit(0)
    upd = spark.createDataFrame(updates or [("z", 0)], "k string, v int")
    if not updates:
        upd = upd.limit(0)
    want = dict(current)
    for key in {k for k, _ in updates}:
        want[key] = min(v for k, v in updates if k == key)
    got = dict(tuple(r) for r in upsert(cur, upd, ["k"], order=["v"]).collect())
    assert got == want
