from pyspark.sql import functions as F

from shopsight.functions import money


def test_rounding_and_guarded_division(spark):
    df = spark.createDataFrame([(1.005, 3, 0), (0.285, 7, 2), (1234.5, 0, 4)], "price double, part bigint, whole bigint")
    rows = df.select(
        money.dollars(money.to_micros(F.col("price"))).alias("dollars"),
        money.ratio(F.col("part"), F.col("whole")).alias("ratio"),
        money.safe_divide(F.col("part"), F.col("whole"), -1.0).alias("guarded"),
        money.mean_dollars(money.to_micros(F.col("price")), F.col("whole")).alias("mean"),
    ).collect()
    assert [r.dollars for r in rows] == [1.01, 0.29, 1234.5]
    assert [r.ratio for r in rows] == [None, 3.5, 0.0]
    assert [r.guarded for r in rows] == [-1.0, 3.5, 0.0]
    assert [r["mean"] for r in rows] == [None, 0.14, 308.63]
