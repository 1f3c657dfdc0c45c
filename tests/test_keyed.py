"""The bucketed keyed table: untouched buckets, ledger, concurrent writers, lost jobs; safe replacement of outputs."""

import os

import pytest
from pyspark.sql import functions as F

from contrail.sinks.files import write_delimited, write_table
from contrail.sinks.keyed import KeyedTable


def items(df):
    return sorted(tuple(r) for r in df.collect())


def table(spark, scratch, **kw):
    return KeyedTable(spark, os.path.join(scratch, "serving"), ["k"], **kw)


def files_of(t):
    return {os.path.join(d, f) for d, _, fs in os.walk(os.path.join(t.path, "data")) for f in fs if f.startswith("part-")}


def test_untouched_buckets_keep_their_files(spark, scratch):
    t = table(spark, scratch, buckets=8)
    rows = [(f"k{i}", i) for i in range(100)]
    t.upsert(spark.createDataFrame(rows, "k string, v int"))
    before, first = files_of(t), t.manifest(0)["files"]
    t.upsert(spark.createDataFrame([("k7", 700), ("new", 1)], "k string, v int"))
    second = t.manifest(1)["files"]
    changed = [b for b in second if second[b] != first.get(b)]
    assert 1 <= len(changed) <= 2 and before <= files_of(t)
    want = sorted([(k, 700 if k == "k7" else v) for k, v in rows] + [("new", 1)])
    assert items(t.current()) == want and items(t.read(0)) == sorted(rows)
    written = files_of(t) - before
    assert spark.read.parquet(*written).count() < 40  # the rows of the touched buckets only


def test_ledger_ignores_replays_of_interleaved_streams(spark, scratch):
    t = table(spark, scratch)
    b = lambda v: spark.createDataFrame([("A", v)], "k string, v int")
    assert t.upsert(b(1), batch=("s1", 0)) == 0 and t.upsert(b(2), batch=("s2", 0)) == 1
    assert t.upsert(b(1), batch=("s1", 0)) == 1  # replay of an older batch over a newer one
    assert items(t.current()) == [("A", 2)] and t.versions() == [0, 1]
    assert t.upsert(b(3), batch=("s1", 1)) == 2 and t.upsert(b(2), batch=("s2", 0)) == 2
    assert items(t.current()) == [("A", 3)] and t.last_batch("s1") == 1 and t.last_batch("s2") == 0 and t.last_batch("s3") is None


def test_a_concurrent_commit_is_merged(spark, scratch):
    t, other = table(spark, scratch, buckets=2), table(spark, scratch)
    t.upsert(spark.createDataFrame([("A", 1), ("B", 1), ("C", 1)], "k string, v int"))
    plain, done = t._write, []

    def slow(*args):
        plain(*args)
        if not done:  # another writer commits while this one is writing
            done.append(other.upsert(spark.createDataFrame([("A", 5), ("B", 5)], "k string, v int"), batch=("other", 3)))

    t._write = slow
    assert t.upsert(spark.createDataFrame([("B", 9)], "k string, v int"), batch=("mine", 0)) == 2 and done == [1]
    assert items(t.current()) == [("A", 5), ("B", 9), ("C", 1)] and t.manifest(2)["ledger"] == {"other": 3, "mine": 0}


def test_a_lost_job_leaves_the_previous_version(spark, scratch):
    t = table(spark, scratch)
    t.upsert(spark.createDataFrame([("A", 1)], "k string, v int"), batch=("s", 0))
    lost = table(spark, scratch)
    lost._write = lambda *a: (KeyedTable._write(lost, *a), (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        lost.upsert(spark.createDataFrame([("A", 2)], "k string, v int"), batch=("s", 1))
    assert t.versions() == [0] and items(t.current()) == [("A", 1)] and t.last_batch("s") == 0
    assert t.upsert(spark.createDataFrame([("A", 2)], "k string, v int"), batch=("s", 1)) == 1
    assert items(t.current()) == [("A", 2)]


def test_expire_keeps_what_kept_versions_name(spark, scratch):
    t = table(spark, scratch, buckets=4)
    for v in range(4):
        t.upsert(spark.createDataFrame([("A", v), (f"only{v}", v)], "k string, v int"))
    n = len(files_of(t))
    assert t.expire(keep=1) == [0, 1, 2] and t.versions() == [3] and len(files_of(t)) < n
    assert items(t.current()) == [("A", 3)] + [(f"only{v}", v) for v in range(4)]
    assert t.expire(keep=1) == [] and t.upsert(spark.createDataFrame([("A", 9)], "k string, v int")) == 4


def test_empty_updates_and_other_columns(spark, scratch):
    t = table(spark, scratch)
    empty = spark.createDataFrame([], "k string, v int")
    assert t.upsert(empty, batch=("s", 0)) == 0 and t.current().count() == 0 and t.current().columns == ["k", "v"]
    assert t.upsert(spark.createDataFrame([(None, 1), (None, 2), ("A", 3)], "k string, v int")) == 1
    assert t.upsert(spark.createDataFrame([(4, "A")], "v bigint, k string")) == 2  # other order and width
    assert ("A", 4) in [tuple(r) for r in t.current().collect()] and t.current().schema["v"].dataType.simpleString() == "int"
    with pytest.raises(ValueError):
        t.upsert(spark.createDataFrame([("A", 1)], "k string, w int"))


def test_a_failing_job_leaves_the_previous_answer(spark, scratch):
    good = spark.createDataFrame([("A", 1)], "k string, v int")
    bad = good.withColumn("v", F.raise_error(F.lit("broken")).cast("int"))
    for name, write, read in (
        ("csv", write_delimited, lambda p: spark.read.text(p).count()),
        ("table", write_table, lambda p: spark.read.parquet(p).count()),
    ):
        path = os.path.join(scratch, name)
        write(good, path)
        with pytest.raises(Exception, match="broken"):
            write(bad, path)
        assert read(path) == 1 and os.listdir(scratch).count(name) == 1
        write(good.unionByName(good), path)
        assert read(path) == 2 and [f for f in os.listdir(scratch) if name in f] == [name]
