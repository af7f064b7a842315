from __future__ import annotations

import random

from pyspark.sql import functions as F

from tillmark.functions.ordering import first_per_key, numbered_after, rank_within, running_total


def test_running_total_matches_a_plain_loop(spark):
    random.seed(7)
    data = [(i, random.choice([0, 0, 5, 7, 100])) for i in range(500)]
    got = {r["id"]: (r["run"], r["all"]) for r in running_total(
        spark.createDataFrame(data, "id int, v bigint"), [F.col("v").desc(), F.col("id").asc()], "v", "run", total="all",
        slices=7).collect()}
    total = 0
    for i, v in sorted(data, key=lambda r: (-r[1], r[0])):
        total += v
        assert got[i] == (total, sum(v for _, v in data))


def test_running_total_per_group_with_a_hot_and_a_null_group(spark):
    data = [("hot", i, 1) for i in range(400)] + [("b", 1, 3), ("b", 2, 4), (None, 1, 9)]
    df = spark.createDataFrame(data, "g string, id int, v bigint")
    got = running_total(df, [F.col("id").asc()], "v", "run", groups=["g"], slices=5)
    ends = {r["g"]: r["m"] for r in got.groupBy("g").agg(F.max("run").alias("m")).collect()}
    assert ends == {"hot": 400, "b": 7, None: 9}
    assert got.count() == len(data)


def test_hot_group_is_spread_over_slices(spark):
    df = spark.range(1000).withColumn("g", F.lit("hot")).withColumn("v", F.lit(1).cast("long"))
    spread = df.repartitionByRange(4, "g", "id").groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) == 4


def test_rank_counts_ties_like_sql(spark):
    data = [("a", v) for v in (5, 9, 9, 1, 5, 5)] + [("b", 2), (None, 3), (None, 3)]
    df = spark.createDataFrame(data, "g string, v bigint")
    df.createOrReplaceTempView("ranked")
    want = spark.sql("select g, v, cast(rank() over (partition by g order by v desc) as bigint) r from ranked").collect()
    got = rank_within(df, ["g"], "v", "r").select("g", "v", "r").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, want), key=repr)


def test_first_per_key_prunes_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 2, "x"), (1, 1, "y"), (2, 1, "z")], "k int, t int, v string")
    first = first_per_key(df, ["k"], ["t"])
    assert {(r["k"], r["v"]) for r in first.collect()} == {(1, "y"), (2, "z")}
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_numbers_follow_the_start_without_gaps(spark):
    got = numbered_after(spark.createDataFrame([(c,) for c in "dbca"], "k string"), 10, ["k"], "n")
    assert {r["k"]: r["n"] for r in got.collect()} == {"a": 11, "b": 12, "c": 13, "d": 14}
