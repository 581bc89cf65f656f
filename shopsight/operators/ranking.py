"""Positions in a global order, without a single-task window.

`positions` gives each distinct value of one or more series the number of rows
before it. Ties collapse first, with map-side combine, so a value held by a
third of all rows is one row from there on. The distinct values are stored, dealt by
range to as many buckets of about `BUCKET_ROWS` as there need to be, and stored with
their bucket, so that a re-run task sees the same ones. Each bucket is ordered in its
own task, and its offset comes from the bucket totals. Average ranks, scores, exact
medians and exact splits all follow from the positions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shopsight.sources.scratch import materialize

SERIES, VALUE, TIES, BEFORE, TOTAL = "series", "value", "ties", "before", "total"
BUCKET_ROWS = 1_000_000


def stack(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """One (series, value) row per row and named column."""
    pairs = [F.struct(F.lit(name).alias(SERIES), value.alias(VALUE)) for name, value in columns.items()]
    return df.select(F.inline(F.array(*pairs)))


def dealt(stacked: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Stored distinct values (series, value, ties, bucket); buckets follow each other in order."""
    histogram = materialize(stacked.groupBy(SERIES, VALUE).agg(F.count("*").alias(TIES)), "histogram")
    buckets = 1 + histogram.count() // bucket_rows
    ranged = histogram.repartitionByRange(buckets, SERIES, VALUE).withColumn("bucket", F.spark_partition_id())
    return materialize(ranged, "histogram-buckets")


def positions(stacked: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(series, value) rows -> distinct values with ties, rows before, rows in total.

    The number of series must be small and fixed by the caller (metrics,
    classes): the bucket totals, one row per bucket and series in it, are broadcast.
    """
    bucketed = dealt(stacked, bucket_rows)
    in_order = W.partitionBy(SERIES).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy(SERIES, "bucket")
        .agg(F.sum(TIES).alias("bucket_rows"))
        .select(
            SERIES,
            "bucket",
            F.coalesce(F.sum("bucket_rows").over(in_order), F.lit(0)).alias("offset"),
            F.sum("bucket_rows").over(W.partitionBy(SERIES)).alias(TOTAL),
        )
    )
    in_bucket = W.partitionBy(SERIES, "bucket").orderBy(VALUE).rowsBetween(W.unboundedPreceding, -1)
    return (
        bucketed.withColumn("earlier", F.coalesce(F.sum(TIES).over(in_bucket), F.lit(0)))
        .join(F.broadcast(offsets), [SERIES, "bucket"])
        .select(SERIES, VALUE, TIES, (F.col("offset") + F.col("earlier")).alias(BEFORE), TOTAL)
    )


def average_rank() -> Column:
    """Tie-averaged 1-based rank of a `positions` row."""
    return F.col(BEFORE) + 1 + (F.col(TIES) - 1) / F.lit(2.0)


def average_ranks(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """`df` plus a `<name>_rank` column per named column.

    Values must be equal exactly when they are meant to tie.
    """
    ranked = materialize(positions(stack(df, columns)).select(SERIES, VALUE, average_rank().alias("rank")), "ranks")

    def attach(left: DataFrame, name: str) -> DataFrame:
        key = f"_{name}_key"
        ranks = ranked.filter(F.col(SERIES) == name).select(
            F.col(VALUE).alias(key), F.col("rank").alias(f"{name}_rank")
        )
        return left.withColumn(key, columns[name]).join(ranks, key).drop(key)

    return reduce(attach, columns, df)


def level_cutoffs(stacked: DataFrame, level: Column, names: list[str], levels: range) -> Column:
    """Struct of the smallest value of each series that reaches each level.

    `level` is a non-decreasing function of the position. Comparing with the
    cut-offs then grades every row where it stands, with no join on the value.
    Fields are named `<series>_<level>`.
    """
    graded = positions(stacked).withColumn("level", level)
    fields = [
        F.min(F.when((F.col(SERIES) == n) & (F.col("level") >= k), F.col(VALUE))).alias(f"{n}_{k}")
        for n in names
        for k in levels
    ]
    return graded.agg(*fields).select(F.struct("*").alias("cutoffs")).scalar()


def median(df: DataFrame, value: Column) -> Column:
    """Exact median as a scalar subquery; NULLs do not count."""
    placed = positions(stack(df, {"all": value}).filter(F.col(VALUE).isNotNull()))
    lower = F.call_function("div", F.col(TOTAL) + 1, F.lit(2))
    upper = F.call_function("div", F.col(TOTAL) + 2, F.lit(2))

    def holds(position: Column) -> Column:
        return (F.col(BEFORE) < position) & (F.col(BEFORE) + F.col(TIES) >= position)

    middle = placed.filter(holds(lower) | holds(upper))
    return middle.agg(((F.min(VALUE) + F.max(VALUE)) / 2).alias("median")).scalar()


def first_per_key(df: DataFrame, key: str, order_by: list[str] | None = None) -> DataFrame:
    """One row per key: the earliest `created_at`, then the smallest row.

    `row_number() = 1` prunes on the map side, so a heavily repeated key never
    gathers in one task.
    """
    if order_by is None:
        first = ["created_at"] if "created_at" in df.columns else []
        order_by = first + [c for c in df.columns if c not in (key, *first)]
    order = [F.col(c).asc_nulls_last() for c in order_by]
    numbered = df.withColumn("_row", F.row_number().over(W.partitionBy(key).orderBy(*order)))
    return numbered.filter(F.col("_row") == 1).drop("_row")
