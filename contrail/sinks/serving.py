"""Answers published as keyed serving tables, one table per question."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.operators.upsert import first_per_key
from contrail.plans import questions as Q
from contrail.sinks.keyed import KeyedTable

# The key of each question's serving table.
SERVING_KEYS = {
    "1-1": ["airport"],
    "1-2": ["airline"],
    "2-1": ["origin"],
    "2-2": ["origin"],
    "2-4": ["route"],
    "3-2": ["origin", "dest", "flight_date", "dep_time"],
}


def serving_items(qid: str, answer: DataFrame) -> DataFrame:
    """The items of a question's serving table, one per key: counts and means as
    they are, the per-origin lists of 2-1 and 2-2 as pair text, routes of 2-4 as
    ``origin-dest``, and of 3-2 the lowest (delay, airline) of each departure."""
    if qid in ("2-1", "2-2"):
        return Q.pairs_by_origin(answer, "carrier" if qid == "2-1" else "dest")
    if qid == "2-4":
        return answer.select(F.concat_ws("-", "origin", "dest").alias("route"), "delay")
    if qid == "3-2":
        return first_per_key(answer, SERVING_KEYS[qid], ["delay", "airline"])
    return answer


def publish(spark: SparkSession, qid: str, answer: DataFrame, directory: str) -> DataFrame:
    """Upsert an answer into ``<directory>/<qid>``; returns the table's current items."""
    if qid not in SERVING_KEYS:
        raise ValueError(f"{qid} has no serving table")
    table = KeyedTable(spark, f"{directory.rstrip('/')}/{qid}", SERVING_KEYS[qid])
    table.upsert(serving_items(qid, answer))
    return table.current()
