"""Distributed positions against brute force."""

import random
import statistics

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shopsight.operators import ranking


def with_values(spark, values):
    rows = list(enumerate(values))
    return spark.createDataFrame(rows, "id bigint, v double").repartition(4)


def test_ranks_equal_pandas_for_every_bucket_count(spark):
    rng = random.Random(7)
    values = [float(rng.choice([0, 1, 1, rng.randrange(400)])) for _ in range(1500)]
    expected = pd.Series(values).rank(method="average")
    df = with_values(spark, values)
    for bucket_rows in (10, 100, 1000):  # from tens of buckets to one
        placed = ranking.positions(ranking.stack(df, {"v": F.col("v")}), bucket_rows).select(
            "value", ranking.average_rank().alias("rank"), "total"
        )
        got = {r.value: (r.rank, r.total) for r in placed.collect()}
        assert got == {v: (r, 1500) for v, r in zip(values, expected)}


def test_series_do_not_mix(spark):
    df = spark.createDataFrame([(1, 5.0, 100.0), (2, 6.0, 50.0), (3, 6.0, 70.0)], "id bigint, a double, b double")
    ranked = ranking.average_ranks(df, {"a": F.col("a"), "b": F.col("b")})
    assert {r.id: (r.a_rank, r.b_rank) for r in ranked.collect()} == {1: (1.0, 3.0), 2: (2.5, 1.0), 3: (2.5, 2.0)}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60))
def test_median(spark, values):
    df = with_values(spark, [float(v) for v in values])
    got = spark.range(1).select(ranking.median(df, F.col("v")).alias("m")).first().m
    assert got == statistics.median(values)


def test_median_skips_nulls_and_empty(spark):
    df = with_values(spark, [1.0, None, 4.0])
    assert spark.range(1).select(ranking.median(df, F.col("v")).alias("m")).first().m == 2.5
    assert spark.range(1).select(ranking.median(df.limit(0), F.col("v")).alias("m")).first().m is None


def test_hot_value_holds_most_rows(spark):
    values = [0.0] * 700 + [float(i) for i in range(1, 301)]
    placed = ranking.positions(ranking.stack(with_values(spark, values), {"v": F.col("v")}))
    zero = placed.filter("value = 0").first()
    assert (zero.ties, zero.before) == (700, 0)
    assert placed.filter("value = 300").first().before == 999


def test_first_per_key(spark):
    df = spark.createDataFrame(
        [(1, "b", "2023-01-02"), (1, "a", "2023-01-02"), (1, "c", None), (2, "z", None)],
        "k bigint, x string, created_at string",
    )
    assert {r.k: r.x for r in ranking.first_per_key(df, "k").collect()} == {1: "a", 2: "z"}


@pytest.mark.parametrize("hot_share", [0.4])
def test_first_per_key_prunes_before_the_shuffle(spark, hot_share):
    df = spark.range(1000).select(F.when(F.col("id") < 1000 * hot_share, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("x"))
    unique = ranking.first_per_key(df, "k")
    assert unique.count() == 601 and unique.filter("k = 0").first().x == 0
    assert "WindowGroupLimit" in unique._jdf.queryExecution().executedPlan().toString()


def test_buckets_grow_with_the_values_and_stay_small(spark):
    """Twenty times the values make twenty times the buckets, none far larger than asked for."""
    for n in (2_000, 40_000):
        df = spark.range(n).select((F.col("id") * 7 % n).cast("double").alias("v"))
        sizes = [r["count"] for r in ranking.dealt(ranking.stack(df, {"a": F.col("v")}), 1_000).groupBy("bucket").count().collect()]
        assert n / 2_000 <= len(sizes) <= n / 1_000 + 1 and max(sizes) <= 3_000


def test_three_ranks_take_few_exchanges(spark):
    df = spark.range(500).select("id", *[(F.col("id") * k % 97).cast("double").alias(f"m{k}") for k in (3, 5, 7)])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ranked = ranking.average_ranks(df, {f"m{k}": F.col(f"m{k}") for k in (3, 5, 7)})
        assert ranked._jdf.queryExecution().executedPlan().toString().count("Exchange ") <= 9
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
