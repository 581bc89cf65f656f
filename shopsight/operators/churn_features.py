"""Churn features and labels, separated in time.

Features use orders strictly before the cut-off. A customer has churned when no
completed order falls in [cut-off, cut-off + horizon], both ends included.
"""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsight.contracts import CHURN_HORIZON_DAYS
from shopsight.functions import calendar
from shopsight.functions.money import dollars_unrounded, ratio
from shopsight.operators.purchases import Facts, order_facts, order_span, product_variety
from shopsight.operators.rfm import epoch_micros


class ChurnWindow(NamedTuple):
    """Microseconds since the epoch."""

    cutoff: int
    end: int
    last_order: int


def churn_window(
    orders: DataFrame, horizon_days: int = CHURN_HORIZON_DAYS, cutoff: datetime | str | None = None
) -> ChurnWindow:
    if horizon_days <= 0:
        raise ValueError("The churn horizon must be a positive number of days.")
    first, last = order_span(orders)
    horizon = horizon_days * calendar.MICROS_PER_DAY
    start = last - horizon if cutoff is None else epoch_micros(cutoff)
    if last < start + horizon:
        raise ValueError(f"The order history ends before the full {horizon_days}-day label window ends.")
    if first >= start:
        raise ValueError("No historical orders found before the cut-off date.")
    return ChurnWindow(start, start + horizon, last)


def build_churn_features(
    orders: DataFrame,
    items: DataFrame,
    users: DataFrame,
    horizon_days: int = CHURN_HORIZON_DAYS,
    cutoff: datetime | str | None = None,
    facts: Facts | None = None,
) -> DataFrame:
    """One row per customer with history: features and the `churned` label."""
    window = churn_window(orders, horizon_days, cutoff)
    return churn_features_in(window, orders, items, users, facts)


def churn_features_in(
    window: ChurnWindow, orders: DataFrame, items: DataFrame, users: DataFrame, facts: Facts | None = None
) -> DataFrame:
    """An order's date is that of its earliest completed row, so that facts of all orders can be cut by date."""
    cutoff, end = calendar.at_micros(window.cutoff), calendar.at_micros(window.end)
    created = F.col("created_at")
    in_history = created < cutoff

    # Features and label come out of the same aggregation over the order facts.
    purchases = (
        (facts.orders.filter(created <= end) if facts else order_facts(orders.filter(created <= end), items))
        .groupBy("user_id")
        .agg(
            F.count_if(in_history).alias("frequency"),
            F.max(F.when(in_history, created)).alias("last_order_date"),
            F.min(F.when(in_history, created)).alias("first_order_date"),
            F.sum(F.when(in_history, F.col("order_micros"))).alias("history_micros"),
            F.count(F.when(in_history, F.col("order_micros"))).alias("orders_with_items"),
            F.count_if(~in_history).alias("label_orders"),
        )
        .filter(F.col("frequency") > 0)
    )
    variety = product_variety(orders, items, facts, before=cutoff).withColumnRenamed("customer_id", "user_id")
    people = users.select(
        F.col("id").alias("user_id"), F.col("age").try_cast("double").alias("age"), "gender", "country"
    )
    monetary = F.coalesce(dollars_unrounded(F.col("history_micros")), F.lit(0.0))
    return (
        purchases.join(variety, "user_id", "left")
        .join(people, "user_id", "left")
        .select(
            "user_id",
            "frequency",
            "last_order_date",
            "first_order_date",
            monetary.alias("monetary"),
            F.coalesce(F.try_divide(monetary, F.col("orders_with_items")), F.lit(0.0)).alias("avg_order_value"),
            F.coalesce("n_unique_products", F.lit(0)).alias("n_unique_products"),
            calendar.elapsed_days(cutoff, F.col("last_order_date")).alias("recency"),
            calendar.elapsed_days(F.col("last_order_date"), F.col("first_order_date")).alias("tenure_days"),
            F.coalesce("age", F.lit(0.0)).alias("age"),
            "gender",
            "country",
            F.coalesce(F.lower("gender") == "m", F.lit(False)).cast("int").alias("is_male"),
            (F.col("label_orders") == 0).cast("int").alias("churned"),
        )
    )


def churn_rate(features: DataFrame) -> DataFrame:
    return features.agg(
        F.count("*").alias("customers"),
        F.sum(F.col("churned").cast("bigint")).alias("churned"),
        F.count_if(F.col("churned") == 0).alias("active"),
    ).withColumn("churn_rate", ratio(F.col("churned"), F.col("customers")))
