"""Monthly KPIs and cohort retention.

Both start from one row per customer and active month. At that grain every
distinct count of the reports is a plain count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shopsight.functions import calendar
from shopsight.functions.money import dollars_unrounded, mean_dollars, ratio, wide_sum
from shopsight.operators.purchases import Facts, completed, order_facts


def _with_first_month(months: DataFrame) -> DataFrame:
    """A customer has at most one row per calendar month, so the window is small."""
    return months.withColumn("first_month", F.min("month").over(W.partitionBy("user_id")))


def compute_monthly_kpis(orders: DataFrame, items: DataFrame, facts: Facts | None = None) -> DataFrame:
    months = (
        (facts.orders if facts else order_facts(orders, items))
        .groupBy("user_id", calendar.month_of(F.col("created_at")).alias("month"))
        .agg(
            F.count("*").alias("orders"),
            F.coalesce(F.sum("order_micros"), F.lit(0)).alias("micros"),
        )
    )
    is_new = F.col("month") == F.col("first_month")
    monthly = (
        _with_first_month(months)
        .groupBy("month")
        .agg(
            wide_sum(F.col("micros")).alias("micros"),
            F.sum("orders").alias("total_orders"),
            F.count("*").alias("unique_customers"),
            F.count_if(is_new).alias("new_customers"),
            F.count_if(~is_new).alias("repeat_customers"),
        )
    )
    return monthly.select(
        calendar.month_label(F.col("month")).alias("year_month"),
        dollars_unrounded(F.col("micros")).alias("total_revenue"),
        "total_orders",
        "unique_customers",
        mean_dollars(F.col("micros"), F.col("total_orders")).alias("avg_order_value"),
        "new_customers",
        "repeat_customers",
        ratio(F.col("repeat_customers"), F.col("unique_customers")).alias("repeat_customer_rate"),
    ).orderBy("year_month")


def cohort_activity(orders: DataFrame) -> DataFrame:
    """Long retention: active customers per cohort and months since the first order."""
    months = completed(orders).select("user_id", calendar.month_of(F.col("created_at")).alias("month")).distinct()
    active = (
        _with_first_month(months)
        .groupBy(
            F.col("first_month").alias("cohort"),
            calendar.months_between(F.col("month"), F.col("first_month")).alias("months_since"),
        )
        .agg(F.count("*").alias("active_customers"))
    )
    # Every customer of a cohort is active at offset 0.
    size = F.max(F.when(F.col("months_since") == 0, F.col("active_customers"))).over(W.partitionBy("cohort"))
    return active.withColumn("cohort_size", size).select(
        calendar.month_label(F.col("cohort")).alias("cohort_month"),
        "months_since",
        "active_customers",
        "cohort_size",
        ratio(F.col("active_customers"), F.col("cohort_size")).alias("retention_rate"),
    )


def compute_cohort_retention(orders: DataFrame, offsets: int | None = None) -> DataFrame:
    """Wide retention: one column per month offset, NULL where nobody was active.

    Without `offsets` the columns run to the largest offset in the data.
    """
    by_cohort = cohort_activity(orders).groupBy("cohort_month")
    if offsets is None:
        wide = by_cohort.pivot("months_since")
    else:
        wide = by_cohort.pivot("months_since", list(range(offsets)))
    return wide.agg(F.first("retention_rate")).orderBy("cohort_month")
