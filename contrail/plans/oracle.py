"""Reference SQL for every catalog query, as plain SQL over the driver tables
(runs in DuckDB). Written from the question semantics, independently of the
DataFrame code, so the two can check each other."""

from __future__ import annotations

from contrail.plans.catalog import REPORT_AIRPORTS, UPSERT_SPLIT_DATE
from contrail.sources.tables import SECOND_LEG_DAYS

_RF = "(l.l_returnflag = 'R' AND l.l_linestatus = 'F')"
_ODD = f"({_RF} AND l.l_linenumber % 2 = 1)"

FLIGHTS = f"""flights AS (
  SELECT
    CAST(l.l_shipdate AS DATE) AS flight_date,
    CAST(substr(p.p_brand, 7) AS INTEGER) AS airline_id,
    p.p_brand AS carrier,
    CAST(l.l_linenumber AS VARCHAR) AS flight_num,
    CASE WHEN {_RF} THEN '1.00' ELSE '0.00' END AS cancelled,
    sn.n_name AS origin,
    cn.n_name AS dest,
    CASE WHEN {_ODD} THEN NULL ELSE CAST(l.l_quantity - 25 AS DOUBLE) END AS dep_delay,
    CASE WHEN {_RF} THEN NULL ELSE CAST(l.l_quantity - 29 + l.l_linenumber AS DOUBLE) END AS arr_delay,
    CASE WHEN {_ODD} THEN NULL
         ELSE lpad(CAST((l.l_partkey % 24) * 100 + l.l_suppkey % 60 AS VARCHAR), 4, '0') END AS dep_time
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation cn ON c.c_nationkey = cn.n_nationkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation sn ON s.s_nationkey = sn.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""

LOOKUPS = """airports AS (
  SELECT replace(n.n_name, '"', '') AS code, min(replace(r.r_name, ',', ' ')) AS description
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  GROUP BY 1
),
airlines AS (
  SELECT replace(substr(p_brand, 7), '"', '') AS code, min(replace(p_brand, ',', ' ')) AS description
  FROM part GROUP BY 1
)"""


def _p(c: str) -> str:
    """Field holds a value."""
    return f"({c} IS NOT NULL AND CAST({c} AS VARCHAR) <> '')"


def _r2(x: str) -> str:
    """Round half-up to 2 places."""
    return f"(floor(({x}) * 100 + 0.5) / 100)"


def _short(x: str) -> str:
    return f"regexp_replace(regexp_replace(printf('%.2f', {x}), '0+$', ''), '\\.$', '')"


# Rows with 9+ fields once trailing empties are cut: arrival delay or departure time present.
NINE = f"({_p('arr_delay')} OR {_p('dep_time')})"
EIGHT = f"({_p('dep_delay')} OR {NINE})"

def _itineraries(limit: str) -> str:
    return f"""usable AS (
  SELECT f.*, concat_ws('-', f.carrier, f.flight_num) AS airline
  FROM flights f
  WHERE {NINE} AND {_p('f.origin')} AND {_p('f.dest')} AND f.arr_delay IS NOT NULL
    AND f.flight_date IS NOT NULL AND {_p('f.dep_time')}
),
into_y AS (
  SELECT origin, dest, flight_date, arr_delay FROM usable
  QUALIFY row_number() OVER (PARTITION BY dest, flight_date ORDER BY arr_delay, origin) = 1
),
out_of_y AS (
  SELECT origin, dest, flight_date, arr_delay FROM usable
  QUALIFY row_number() OVER (PARTITION BY origin, flight_date ORDER BY arr_delay, dest) = 1
),
itin AS (
  SELECT a.origin AS x, a.dest AS y, b.dest AS z, a.flight_date AS first_date
  FROM into_y a JOIN out_of_y b ON b.origin = a.dest AND b.flight_date = a.flight_date + {SECOND_LEG_DAYS}
  {limit}
),
legs AS (
  SELECT x AS origin, y AS dest, first_date AS flight_date FROM itin
  UNION
  SELECT y, z, first_date + {SECOND_LEG_DAYS} FROM itin
),
cand AS (
  SELECT f.* FROM usable f
  WHERE EXISTS (SELECT 1 FROM legs g WHERE g.origin = f.origin AND g.dest = f.dest AND g.flight_date = f.flight_date)
)"""


ITINERARIES = _itineraries("ORDER BY a.arr_delay + b.arr_delay, a.flight_date, a.dest LIMIT 8")
ALL_ITINERARIES = _itineraries("")

TRAFFIC = f"""traffic AS (
  SELECT airport, count(*) AS flights FROM (
    SELECT origin AS airport FROM flights WHERE {NINE} AND {_p('origin')} AND {_p('dest')}
    UNION ALL
    SELECT dest FROM flights WHERE {NINE} AND {_p('origin')} AND {_p('dest')}
  ) GROUP BY airport
)"""

ORIGIN_CARRIER = f"""oc AS (
  SELECT origin, carrier, {_r2('avg(dep_delay)')} AS delay, avg(dep_delay) AS plain
  FROM flights
  WHERE {EIGHT} AND {_p('origin')} AND {_p('carrier')} AND dep_delay IS NOT NULL
    AND NOT coalesce(cancelled = '1.00', false)
  GROUP BY origin, carrier
),
oc_best AS (
  SELECT origin, carrier, delay,
         CAST(row_number() OVER (PARTITION BY origin ORDER BY delay, carrier) AS INTEGER) AS rank
  FROM oc
  QUALIFY rank <= 10
)"""

ORIGIN_DEST = f"""od AS (
  SELECT origin, dest, {_r2('avg(dep_delay)')} AS delay, avg(dep_delay) AS plain
  FROM flights
  WHERE {EIGHT} AND {_p('origin')} AND {_p('dest')} AND dep_delay IS NOT NULL
  GROUP BY origin, dest
),
od_best AS (
  SELECT origin, dest, delay,
         CAST(row_number() OVER (PARTITION BY origin ORDER BY delay, dest) AS INTEGER) AS rank
  FROM od
  QUALIFY rank <= 10
)"""


def _route_means(where: str = "TRUE") -> str:
    return f"""SELECT origin, dest, {_r2('avg(arr_delay)')} AS delay
  FROM flights
  WHERE {NINE} AND {_p('origin')} AND {_p('dest')} AND arr_delay IS NOT NULL AND {where}
  GROUP BY origin, dest"""


_LEG_COLS = [
    "flight_date", "airline_id", "carrier", "origin", "dest", "dep_delay",
    "dep_delay_minutes", "dep_del15", "arr_delay", "arr_delay_minutes", "arr_del15",
]


def _min15(c: str) -> str:
    return (
        f"CASE WHEN {c} IS NULL THEN NULL ELSE greatest({c}, CAST(0 AS DOUBLE)) END AS {c}_minutes, "
        f"CASE WHEN {c} IS NULL THEN NULL WHEN {c} >= 15 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS {c[:3]}_del15"
    )


LEGS = f"""leg AS (
  SELECT flight_date, airline_id, carrier, origin, dest, dep_delay, {_min15('dep_delay')},
         arr_delay, {_min15('arr_delay')}
  FROM flights
),
best_next AS (
  SELECT * FROM leg WHERE arr_delay IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY origin, flight_date
          ORDER BY arr_delay, dep_delay NULLS FIRST, dest, carrier, airline_id) = 1
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


_ARPT = ", ".join(f"'{a}'" for a in REPORT_AIRPORTS)

ORACLE_SQL: dict[str, str] = {
    "flights_clean": _with(FLIGHTS, LOOKUPS) + """SELECT f.*, ao.description AS origin_name,
       ad.description AS dest_name, al.description AS airline_name
FROM flights f
LEFT JOIN airports ao ON f.origin = ao.code
LEFT JOIN airports ad ON f.dest = ad.code
LEFT JOIN airlines al ON CAST(f.airline_id AS VARCHAR) = al.code
WHERE f.flight_date > DATE '1900-01-01'""",
    "flights_parsed": _with(FLIGHTS) + """SELECT *,
  CASE WHEN dep_time IS NOT NULL THEN 10 WHEN arr_delay IS NOT NULL THEN 9
       WHEN dep_delay IS NOT NULL THEN 8 ELSE 7 END AS n_fields
FROM flights""",
    "lookup_clean": _with(LOOKUPS) + """SELECT 'airport' AS kind, code, description FROM airports
UNION ALL
SELECT 'airline' AS kind, code, description FROM airlines""",
    "airports_top10": _with(FLIGHTS, TRAFFIC) + "SELECT airport, flights FROM traffic ORDER BY flights DESC, airport DESC LIMIT 10",
    "airports_ranked": _with(FLIGHTS, TRAFFIC) + "SELECT airport, flights FROM traffic ORDER BY flights DESC, airport DESC",
    "carriers_ontime_top10": _with(FLIGHTS) + f"""SELECT carrier AS airline, avg({_r2('arr_delay')}) AS delay
FROM flights
WHERE {NINE} AND {_p('carrier')} AND arr_delay IS NOT NULL
GROUP BY carrier
ORDER BY delay, airline
LIMIT 10""",
    "airlines_named_ontime_top10": _with(FLIGHTS, LOOKUPS) + """SELECT
  coalesce(a.description, '') || '(' || CAST(f.airline_id AS VARCHAR) || ')' AS airline,
  avg(f.arr_delay) AS delay
FROM flights f LEFT JOIN airlines a ON CAST(f.airline_id AS VARCHAR) = a.code
WHERE f.airline_id IS NOT NULL AND f.arr_delay IS NOT NULL
GROUP BY 1
ORDER BY delay, airline
LIMIT 10""",
    "origin_carrier_best10": _with(FLIGHTS, ORIGIN_CARRIER) + "SELECT origin, carrier, delay, rank FROM oc_best",
    "origin_dest_best10": _with(FLIGHTS, ORIGIN_DEST) + "SELECT origin, dest, delay, rank FROM od_best",
    "origin_dest_worst10": _with(FLIGHTS, ORIGIN_DEST) + """SELECT origin, dest, delay,
  CAST(row_number() OVER (PARTITION BY origin ORDER BY plain DESC, dest DESC) AS INTEGER) AS rank
FROM od
QUALIFY rank <= 10""",
    "route_mean_arrival": _with(FLIGHTS) + _route_means(),
    "leg_flight_min_delay": _with(FLIGHTS, ITINERARIES) + f"""SELECT origin, dest, flight_date, dep_time,
  replace(airline, '"', '') AS airline, {_r2('min(arr_delay)')} AS delay
FROM cand
GROUP BY origin, dest, flight_date, dep_time, replace(airline, '"', '')""",
    "two_leg_itineraries": _with(FLIGHTS, ITINERARIES) + f""", best AS (
  SELECT origin, dest, flight_date, replace(airline, '"', '') AS airline, dep_time, arr_delay AS delay
  FROM cand
  QUALIFY row_number() OVER (PARTITION BY origin, dest, flight_date
          ORDER BY arr_delay, dep_time, replace(airline, '"', '')) = 1
)
SELECT i.x, i.y, i.z, i.first_date,
  b1.airline AS first_airline, b1.dep_time AS first_dep_time, {_r2('b1.delay')} AS first_delay,
  i.first_date + {SECOND_LEG_DAYS} AS second_date,
  b2.airline AS second_airline, b2.dep_time AS second_dep_time, {_r2('b2.delay')} AS second_delay,
  {_r2('b1.delay + b2.delay')} AS total_delay
FROM itin i
JOIN best b1 ON b1.origin = i.x AND b1.dest = i.y AND b1.flight_date = i.first_date
JOIN best b2 ON b2.origin = i.y AND b2.dest = i.z AND b2.flight_date = i.first_date + {SECOND_LEG_DAYS}""".replace(
        "\n, best AS", ",\nbest AS"
    ),
    "leg_pairs": _with(FLIGHTS, LEGS) + "SELECT "
    + ", ".join(f"a.{c} AS first_{c}" for c in _LEG_COLS) + ",\n  "
    + ", ".join(f"b.{c} AS second_{c}" for c in _LEG_COLS)
    + f"""
FROM leg a
LEFT JOIN best_next b ON a.dest = b.origin AND b.flight_date = a.flight_date + {SECOND_LEG_DAYS}""",
    "origin_carrier_report": _with(FLIGHTS, ORIGIN_CARRIER) + f"""SELECT origin,
  string_agg(carrier || '(' || {_short('delay')} || ')', ' ' ORDER BY rank) AS carriers
FROM oc_best GROUP BY origin""",
    "origin_carrier_pairs": _with(FLIGHTS, ORIGIN_CARRIER) + """SELECT origin,
  '[' || string_agg('(' || CAST(delay AS VARCHAR) || ', ' || carrier || ')', ', ' ORDER BY rank) || ']' AS pairs
FROM oc_best GROUP BY origin""",
    "airport_subset_report": _with(FLIGHTS, ORIGIN_DEST) + f"""SELECT origin,
  string_agg(dest || '(' || {_short('delay')} || ')', ' ' ORDER BY rank) AS destinations
FROM od_best
WHERE origin IN (SELECT origin FROM od_best WHERE origin IN ({_ARPT}) OR dest IN ({_ARPT}))
GROUP BY origin""",
    "serving_upsert": _with(FLIGHTS, f"""r1 AS ({_route_means(f"flight_date < DATE '{UPSERT_SPLIT_DATE}'")}),
r2 AS ({_route_means(f"flight_date >= DATE '{UPSERT_SPLIT_DATE}'")})""") + """SELECT * FROM r1
WHERE NOT EXISTS (SELECT 1 FROM r2 WHERE r2.origin = r1.origin AND r2.dest = r1.dest)
UNION ALL
SELECT * FROM r2""",
    "serving_stream_upsert": _with(FLIGHTS, f"""r1 AS ({_route_means(f"flight_date < DATE '{UPSERT_SPLIT_DATE}'")}),
r2 AS ({_route_means(f"flight_date >= DATE '{UPSERT_SPLIT_DATE}'")})""") + """SELECT * FROM r1
WHERE NOT EXISTS (SELECT 1 FROM r2 WHERE r2.origin = r1.origin AND r2.dest = r1.dest)
UNION ALL
SELECT * FROM r2""",
    "origin_carrier_best10_mr": _with(FLIGHTS, ORIGIN_CARRIER) + """SELECT origin, carrier, delay,
  CAST(row_number() OVER (PARTITION BY origin ORDER BY plain, carrier) AS INTEGER) AS rank
FROM oc
QUALIFY rank <= 10""",
    "origin_dest_worst_report": _with(FLIGHTS, ORIGIN_DEST) + f""", worst AS (
  SELECT origin, dest, delay, row_number() OVER (PARTITION BY origin ORDER BY plain DESC, dest DESC) AS place FROM od QUALIFY place <= 10
)
SELECT origin, string_agg(dest || '(' || {_short('delay')} || ')', ' ' ORDER BY place DESC) AS destinations
FROM worst GROUP BY origin""",
    "stream_tail": "SELECT * FROM events",
    "old_layout_airlines": _with(FLIGHTS, LOOKUPS) + """SELECT
  coalesce(a.description, '') || '(' || CAST(f.airline_id AS VARCHAR) || ')' AS airline,
  avg(f.arr_delay) AS delay
FROM flights f LEFT JOIN airlines a ON CAST(f.airline_id AS VARCHAR) = a.code
WHERE (f.airline_id IS NOT NULL OR a.description IS NOT NULL) AND f.arr_delay IS NOT NULL
GROUP BY 1
ORDER BY delay, airline
LIMIT 10""",
    "route_key_value": _with(FLIGHTS, f"routes AS ({_route_means()})") + f"""SELECT origin || '-' || dest AS key,
  {_short('delay')} AS value
FROM routes""",
    "etl_roundtrip": _with(FLIGHTS) + """SELECT f.*,
  o.r_name || '  ' || f.origin AS origin_name, d.r_name || '  ' || f.dest AS dest_name,
  f.carrier || '  ' || CAST(f.airline_id AS VARCHAR) AS airline_name
FROM flights f
JOIN (SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) o ON o.n_name = f.origin
JOIN (SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) d ON d.n_name = f.dest
WHERE f.flight_date > DATE '1900-01-01'""",
    "leg_serving": _with(FLIGHTS, ITINERARIES) + f""", items AS (
  SELECT origin, dest, flight_date, dep_time, replace(airline, '"', '') AS airline,
         {_r2('min(arr_delay)')} AS delay
  FROM cand
  GROUP BY origin, dest, flight_date, dep_time, replace(airline, '"', '')
)
SELECT * FROM items
QUALIFY row_number() OVER (PARTITION BY origin, dest, flight_date, dep_time ORDER BY delay, airline) = 1""",
}

_DEST_PAIRS = _with(FLIGHTS, ORIGIN_DEST) + """SELECT origin,
  '[' || string_agg('(' || CAST(delay AS VARCHAR) || ', ' || dest || ')', ', ' ORDER BY rank) || ']' AS pairs
FROM od_best GROUP BY origin"""

# The same questions with every connection as a request.
ORACLE_SQL.update(
    {many: ORACLE_SQL[few].replace(ITINERARIES, ALL_ITINERARIES)
     for many, few in (("leg_requests_all", "leg_flight_min_delay"), ("two_leg_trips_all", "two_leg_itineraries"))}
)

_ROWS = "SELECT '{q}' AS question, {key} AS key, {name} AS name, CAST({value} AS DOUBLE) AS value, {rank} AS rank FROM ({sql}) AS q{n}"
_SIX = (
    ("1-1", "airport", "NULL", "flights", "NULL", "SELECT airport, flights FROM traffic ORDER BY flights DESC, airport DESC LIMIT 10"),
    ("1-2", "airline", "NULL", "delay", "NULL", f"""SELECT carrier AS airline, avg({_r2('arr_delay')}) AS delay FROM flights
  WHERE {NINE} AND {_p('carrier')} AND arr_delay IS NOT NULL GROUP BY carrier ORDER BY delay, airline LIMIT 10"""),
    ("2-1", "origin", "carrier", "delay", "rank", "SELECT * FROM oc_best"),
    ("2-2", "origin", "dest", "delay", "rank", "SELECT * FROM od_best"),
    ("2-4", "origin", "dest", "delay", "NULL", _route_means()),
    ("3-1", "airport", "NULL", "flights", "NULL", "SELECT airport, flights FROM traffic"),
)
ORACLE_SQL["rollup_answers"] = _with(FLIGHTS, TRAFFIC, ORIGIN_CARRIER, ORIGIN_DEST) + "\nUNION ALL\n".join(
    _ROWS.format(q=q, key=k, name=f"CAST({n} AS VARCHAR)", value=v, rank=f"CAST({r} AS INTEGER)", sql=sql, n=i)
    for i, (q, k, n, v, r, sql) in enumerate(_SIX)
)
ORACLE_SQL["airports_positions"] = _with(FLIGHTS, TRAFFIC) + """SELECT airport, flights,
  row_number() OVER (ORDER BY flights DESC, airport DESC) AS position
FROM traffic"""
ORACLE_SQL["hub_pair_stats"] = _with(FLIGHTS) + f"""SELECT a.dest AS hub, CAST(count(*) AS DOUBLE) AS pairs,
  {_r2('avg(a.arr_delay)')} AS first_delay, {_r2('avg(b.arr_delay)')} AS second_delay, {_r2('avg(a.arr_delay + b.arr_delay)')} AS total_delay,
  CAST(count(*) FILTER (WHERE a.arr_delay >= 15 AND b.arr_delay >= 15) AS DOUBLE) AS both_late
FROM flights a JOIN flights b ON b.origin = a.dest
WHERE a.dest <> ''
GROUP BY a.dest"""
ORACLE_SQL["route_key_value_unrounded"] = _with(FLIGHTS) + f"""SELECT origin || '-' || dest AS key, avg(arr_delay) AS value
FROM flights WHERE {NINE} AND {_p('origin')} AND {_p('dest')} AND arr_delay IS NOT NULL
GROUP BY origin, dest"""
ORACLE_SQL["raw_set_aside"] = _with(FLIGHTS) + """SELECT
  CASE flight_num WHEN '5' THEN 'fields' WHEN '6' THEN 'date' WHEN '7' THEN 'number' ELSE 'good' END AS kind, origin, count(*) AS lines
FROM flights GROUP BY 1, 2"""
ORACLE_SQL["stream_route_means"] = ORACLE_SQL["route_mean_arrival"]
ORACLE_SQL["stream_airport_counts"] = _with(FLIGHTS, TRAFFIC) + "SELECT airport, flights FROM traffic"

# What is read back from a serving table is the answer that was published.
ORACLE_SQL.update(
    serving_two_streams=ORACLE_SQL["serving_upsert"],
    serving_airports=ORACLE_SQL["airports_top10"],
    serving_airlines=ORACLE_SQL["carriers_ontime_top10"],
    serving_carriers=ORACLE_SQL["origin_carrier_pairs"],
    serving_destinations=_DEST_PAIRS,
    stream_lines=ORACLE_SQL["flights_parsed"],
    leg_pairs_raw=ORACLE_SQL["leg_pairs"],
)
