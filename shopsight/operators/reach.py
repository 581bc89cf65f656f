"""Exact distinct counts that can be added up: bitmaps of identifiers.

Identifiers fall into runs of 32,768; each run that occurs is a bitmap of 4 KB, built
while rows are combined on the map side, so that an identifier in a third of all rows
is one bit. Bitmaps of finer keys (products) add up to those of coarser ones
(categories) without another look at the rows, which distinct counts do not.

Bitmaps need whole numbers, and are compact where these are dense. `dense_numbers`
stores a number for every identifier of another type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from shopsight.sources.scratch import materialize

RUN, BITS = "id_run", "id_bits"


def dense_numbers(rows: DataFrame, column: str) -> DataFrame:
    """(column, number): the distinct values numbered from 1 in their order, stored; null has no number.

    Values are sorted by range over all tasks; a value's number is its place in its range and the sizes of the
    ranges before it.
    """
    values = rows.where(F.col(column).isNotNull()).select(column).distinct()
    placed = values.repartitionByRange(column).sortWithinPartitions(column)
    placed = materialize(
        placed.select(column, F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "id-order"
    )
    ranges = placed.groupBy("part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = ranges.select("part", (F.col("first") - F.coalesce(F.sum("n").over(before), F.lit(0)) - 1).alias("start"))
    numbers = placed.join(F.broadcast(starts), "part").select(column, (F.col("at") - F.col("start")).alias("number"))
    return materialize(numbers, "id-numbers")


def numbered(rows: DataFrame, column: str) -> DataFrame:
    """The rows with whole numbers in `column`: as they are, or dense numbers of other identifiers."""
    if isinstance(rows.schema[column].dataType, IntegralType):
        return rows
    numbers = dense_numbers(rows, column)
    return rows.join(numbers, column, "left").withColumn(column, F.col("number")).drop("number")


def bitmaps(rows: DataFrame, keys: list[str], column: str) -> DataFrame:
    """One bitmap per key and run of identifiers; rows without an identifier count for none."""
    return (
        rows.where(F.col(column).isNotNull())
        .groupBy(*keys, F.bitmap_bucket_number(column).alias(RUN))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(column)).alias(BITS))
    )


def merged(fine: DataFrame, keys: list[str]) -> DataFrame:
    """Bitmaps of coarser keys."""
    return fine.groupBy(*keys, RUN).agg(F.bitmap_or_agg(BITS).alias(BITS))


def counted(bitmaps_: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Number of identifiers per key."""
    return bitmaps_.groupBy(*keys).agg(F.sum(F.bitmap_count(BITS)).alias(name))


def orders_and_customers(sold: DataFrame, key: str) -> DataFrame:
    """(key, order_count, unique_customers) of rows (key, order_id, user_id).

    Orders are nearly as many as the rows: these are shuffled once, combined to one per key and order. Customers
    are far fewer and come from bitmaps.
    """
    orders = sold.groupBy(key, "order_id").agg(F.count("*")).groupBy(key).agg(F.count("order_id").alias("order_count"))
    customers = counted(bitmaps(sold, [key], "user_id"), [key], "unique_customers")
    joined = orders.join(customers, key, "left")
    return joined.select(key, "order_count", F.coalesce("unique_customers", F.lit(0)).alias("unique_customers"))
