"""Category and product performance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsight.functions.money import dollars, mean_dollars, to_micros, wide_sum
from shopsight.operators import reach
from shopsight.operators.purchases import completed


def compute_category_analytics(items: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue, orders, customers, mean price and products per category.

    Revenue, item and product counts are summed per product before the product
    table is touched. Orders and customers need the items themselves: one shuffle
    of them by category and order, see `reach.orders_and_customers`.
    """
    sold = completed(items).select(
        "product_id", "order_id", "user_id", to_micros(F.col("sale_price")).alias("micros")
    )
    categories = products.filter(F.col("category").isNotNull()).select(
        F.col("id").alias("product_id"), "category"
    )
    sales = (
        sold.groupBy("product_id")
        .agg(F.sum("micros").alias("micros"), F.count("micros").alias("priced_items"))
        .join(categories, "product_id")
        .groupBy("category")
        .agg(
            wide_sum(F.col("micros")).alias("micros"),
            F.sum("priced_items").alias("priced_items"),
            F.count("*").alias("product_count"),
        )
    )
    found = sold.select("product_id", "order_id", "user_id").join(categories, "product_id")
    return (
        sales.join(reach.orders_and_customers(reach.numbered(found, "user_id"), "category"), "category")
        .select(
            "category",
            dollars(F.col("micros")).alias("total_revenue"),
            "order_count",
            "unique_customers",
            mean_dollars(F.col("micros"), F.col("priced_items")).alias("avg_selling_price"),
            "product_count",
        )
        .orderBy(F.desc("total_revenue"), "category")
    )


def compute_product_analytics(items: DataFrame, products: DataFrame, top_n: int = 50) -> DataFrame:
    """Top products by revenue.

    Revenue alone decides the ranking; the distinct counts are then taken only
    for the `top_n` winners, a broadcast of at most `top_n` rows.
    """
    sold = completed(items).select(
        "product_id", "order_id", "user_id", to_micros(F.col("sale_price")).alias("micros")
    )
    revenue = sold.groupBy("product_id").agg(
        F.sum("micros").alias("micros"), F.count("micros").alias("priced_items")
    )
    best = revenue.select(
        "product_id",
        dollars(F.col("micros")).alias("total_revenue"),
        mean_dollars(F.col("micros"), F.col("priced_items")).alias("avg_selling_price"),
    ).orderBy(F.desc("total_revenue"), "product_id").limit(top_n)
    winners = sold.select("product_id", "order_id", "user_id").join(
        F.broadcast(best.select("product_id")), "product_id", "left_semi"
    )
    counts = reach.orders_and_customers(reach.numbered(winners, "user_id"), "product_id")
    described = products.select(F.col("id").alias("product_id"), "name", "category", "brand").join(
        F.broadcast(best.select("product_id")), "product_id", "left_semi"
    )
    return (
        best.join(counts, "product_id")
        .join(F.broadcast(described), "product_id", "left")
        .select(
            "product_id", "name", "category", "brand",
            "total_revenue", "order_count", "unique_customers", "avg_selling_price",
        )
        .orderBy(F.desc("total_revenue"), "product_id")
    )
