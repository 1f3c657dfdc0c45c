"""Runtime filters keep every wanted row, let little else through, and start no job."""

from pyspark.sql import functions as F

from contrail.operators import runtime_filter as R


def pairs(spark, n, step=1):
    return spark.range(0, n, step).select((F.col("id") % 1000).cast("int").alias("a"), F.concat(F.lit("k"), F.col("id")).alias("b"))


def test_bloom_keeps_all_wanted_and_few_others(spark):
    df, wanted = pairs(spark, 20_000), pairs(spark, 20_000, 40)
    keys = [F.col("a"), F.col("b")]
    passed = R.maybe_wanted(df, keys, wanted, keys, bits=1 << 14)
    assert passed.join(wanted, ["a", "b"], "left_semi").count() == 500
    assert passed.count() < 500 + 20_000 * 0.02
    small = R.maybe_wanted(df, keys, wanted, keys, bits=64)  # full filter: passes everything
    assert small.count() > 15_000
    assert R.maybe_wanted(df, keys, wanted.limit(0), keys).count() == 0


def test_semi_join_is_exact_for_any_size_and_repeated_keys(spark):
    df = pairs(spark, 5_000).unionByName(pairs(spark, 10)).unionByName(spark.sql("select cast(null as int) a, 'x' b"))
    wanted = pairs(spark, 300).crossJoin(spark.range(3)).drop("id").unionByName(spark.sql("select cast(null as int) a, 'x' b"))
    want = sorted(df.join(wanted, ["a", "b"], "left_semi").collect())
    assert sorted(R.semi_join(df, wanted, ["a", "b"], bits=1 << 12).collect()) == want
    assert sorted(R.semi_join(df, wanted, ["a", "b"], known_rows=901).collect()) == want and len(want) == 310


def test_range_is_null_safe_and_empty_requests_give_nothing(spark):
    df = spark.range(100)
    wanted = spark.createDataFrame([(7,), (None,), (20,)], "v long")
    assert R.within_range(df, F.col("id"), wanted, F.col("v")).count() == 14
    assert R.within_range(df, F.col("id"), wanted, F.col("v"), F.col("v") + 5).count() == 18
    assert R.within_range(df, F.col("id"), wanted.filter("v is null"), F.col("v")).count() == 0


def test_computed_once_gives_the_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "n int, s string")
    assert sorted(R.computed_once(df).collect(), key=str) == sorted(df.collect(), key=str)
    assert R.computed_once(df.limit(0)).count() == 0 and R.computed_once(df).columns == ["n", "s"]
