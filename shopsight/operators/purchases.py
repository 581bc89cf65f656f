"""Completed purchases: what counts, and who owns it.

Prices are present and non-negative, as in cleaned tables. Order rows may repeat:
an order counts once, with the customer and date of its earliest completed row.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsight.contracts import COMPLETED_STATUSES
from shopsight.functions.money import to_micros
from shopsight.operators.ranking import first_per_key
from shopsight.sources.concurrent import run_all
from shopsight.sources.scratch import materialize


class Facts(NamedTuple):
    """What several reports need of the purchases, stored once.

    orders: one row per completed order (order_id, user_id, created_at, order_micros).
    owned: one row per customer and product (customer_id, product_id, first_at), by the order's customer.
    """

    orders: DataFrame
    owned: DataFrame


def completed(df: DataFrame) -> DataFrame:
    return df.filter(F.col("status").isin(*COMPLETED_STATUSES))


def order_heads(orders: DataFrame) -> DataFrame:
    """One (order_id, user_id, created_at) per completed order.

    The exchange on order_id that this needs also serves the join that follows.
    """
    return first_per_key(completed(orders).select("order_id", "user_id", "created_at"), "order_id")


def _stored_owners(orders: DataFrame) -> DataFrame:
    """(order_id, user_id), stored: joined from there, a hot order's items can be split over tasks."""
    return materialize(order_heads(orders).select("order_id", "user_id"), "order-owners")


def completed_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Completed items of completed orders, owned by the order's customer."""
    owners = _stored_owners(orders)
    return completed(items).drop("user_id").join(owners, "order_id")


def order_totals(items: DataFrame) -> DataFrame:
    """Completed revenue per order; one row per order leaves each map task."""
    return (
        completed(items)
        .groupBy("order_id")
        .agg(F.sum(to_micros(F.col("sale_price"))).alias("order_micros"))
    )


def order_facts(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Completed orders with their revenue, NULL for an order without items."""
    return order_heads(orders).join(order_totals(items), "order_id", "left")


def owned_products(heads: DataFrame, items: DataFrame) -> DataFrame:
    """Distinct completed products of each order's customer, with the time of the first order of it."""
    return (
        completed(items)
        .select("order_id", "product_id")
        .join(heads, "order_id")
        .where(F.col("product_id").isNotNull())
        .groupBy(F.col("user_id").alias("customer_id"), "product_id")
        .agg(F.min("created_at").alias("first_at"))
    )


def stored_facts(orders: DataFrame, items: DataFrame) -> Facts:
    """The order heads are stored first, so that items of a hot order can be split over tasks in both joins."""
    heads = materialize(order_heads(orders), "order-heads")
    facts = {
        "orders": lambda: materialize(heads.join(order_totals(items), "order_id", "left"), "order-facts"),
        "owned": lambda: materialize(owned_products(heads, items), "owned-products"),
    }
    return Facts(**run_all(orders.sparkSession, facts))


def customer_activity(orders: DataFrame, items: DataFrame, facts: Facts | None = None) -> DataFrame:
    """One pass over the order facts gives all per-customer purchase totals."""
    return (
        (facts.orders if facts else order_facts(orders, items))
        .groupBy(F.col("user_id").alias("customer_id"))
        .agg(
            F.min("created_at").alias("first_order_date"),
            F.max("created_at").alias("last_order_date"),
            F.count("order_id").alias("total_orders"),
            F.count("order_micros").alias("orders_with_items"),
            F.sum("order_micros").alias("revenue_micros"),
        )
    )


def product_variety(orders: DataFrame, items: DataFrame, facts: Facts | None = None, before: Column | None = None) -> DataFrame:
    """Distinct completed products per customer; with `before`, those of orders before that time."""
    owned = facts.owned if facts else owned_products(materialize(order_heads(orders), "order-heads"), items)
    if before is not None:
        owned = owned.where(F.col("first_at") < before)
    return owned.groupBy("customer_id").agg(F.count("*").alias("n_unique_products"))


def order_span(orders: DataFrame) -> tuple[int, int]:
    """First and last completed order, in microseconds since the epoch."""
    at = F.unix_micros(F.col("created_at"))
    row = completed(orders).agg(F.min(at).alias("first"), F.max(at).alias("last")).first()
    if row is None or row["last"] is None:
        raise ValueError("No completed orders found.")
    return row["first"], row["last"]
