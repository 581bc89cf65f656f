"""Small hand-made tables for the tests."""

from __future__ import annotations

import random
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from shopsight.operators.cleaning import clean_all

SCHEMAS = {
    "users": "id bigint, first_name string, last_name string, email string, age int, gender string, "
    "country string, state string, city string, created_at string",
    "orders": "order_id bigint, user_id bigint, status string, created_at string, num_of_item int",
    "order_items": "id bigint, order_id bigint, user_id bigint, product_id bigint, status string, "
    "created_at string, sale_price double",
    "products": "id bigint, name string, category string, brand string, department string, cost double, "
    "retail_price double",
    "events": "id bigint, user_id bigint, event_type string, created_at string",
    "inventory_items": "id bigint, product_id bigint, created_at string, sold_at string, cost double",
    "distribution_centers": "id bigint, name string, latitude double, longitude double",
}


def day(start: str, offset: int) -> str:
    return (date.fromisoformat(start) + timedelta(days=offset)).isoformat()


def table(spark: SparkSession, name: str, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, SCHEMAS[name])


def raw_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """A valid raw set."""
    rows = {
        "users": [
            (i, f"First{i}", f"Last{i}", f"u{i}@example.com", 25 + i, "MF"[i % 2], "US", "CA", "LA", day("2020-01-01", i))
            for i in range(1, 11)
        ],
        "orders": [(i, (i - 1) % 10 + 1, "complete", day("2021-01-01", 7 * i), 2) for i in range(1, 21)],
        "order_items": [
            (i, (i - 1) % 20 + 1, (i - 1) % 10 + 1, (i - 1) % 10 + 1, "complete", day("2021-01-01", 7 * i), 50.0 + i)
            for i in range(1, 41)
        ],
        "products": [
            (i, f"Product {i}", "ABC"[i % 3], f"Brand{i % 4}", "MW"[i % 2], 20.0 + i, 50.0 + i) for i in range(1, 11)
        ],
        "events": [
            (i, (i - 1) % 10 + 1, ("purchase", "view", "cart")[i % 3], day("2021-01-01", i)) for i in range(1, 31)
        ],
        "inventory_items": [(i, i, day("2020-06-01", i), day("2021-01-01", i), 20.0) for i in range(1, 11)],
        "distribution_centers": [(i, f"Center {i}", 40.0 + i, -70.0 - i) for i in range(1, 4)],
    }
    return {name: table(spark, name, r) for name, r in rows.items()}


def orders(spark: SparkSession, rows: list[tuple[int, int, str]], status: str = "complete") -> DataFrame:
    """Cleaned orders from (order, user, day)."""
    raw = table(spark, "orders", [(o, u, status, d, 1) for o, u, d in rows])
    return clean_all({"orders": raw})["orders"]


def items(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Cleaned items from (order, user, product, price[, status])."""
    full = [
        (i, r[0], r[1], r[2], r[4] if len(r) > 4 else "complete", "2023-01-01", float(r[3])) for i, r in enumerate(rows)
    ]
    return clean_all({"order_items": table(spark, "order_items", full)})["order_items"]


def products(spark: SparkSession, rows: list[tuple[int, str, str]]) -> DataFrame:
    return table(spark, "products", [(i, n, c, f"Brand{i}", "M", 1.0, 2.0) for i, n, c in rows])


def shop(spark: SparkSession, customers: int, seed: int = 42) -> dict[str, DataFrame]:
    """Random but fixed history: 1-11 orders per customer, one item each."""
    rng = random.Random(seed)
    order_rows, item_rows = [], []
    for user in range(1, customers + 1):
        for _ in range(rng.randint(1, 11)):
            number = len(order_rows) + 1
            when = day("2022-01-01", rng.randrange(730))
            order_rows.append((number, user, "complete", when, 1))
            item_rows.append((number, number, user, rng.randint(1, 19), "complete", when, round(rng.uniform(20, 300), 2)))
    raw = raw_tables(spark)
    raw["orders"] = table(spark, "orders", order_rows)
    raw["order_items"] = table(spark, "order_items", item_rows)
    raw["users"] = table(
        spark,
        "users",
        [(i, f"F{i}", f"L{i}", f"{i}@x.com", 20 + i % 50, "MF"[i % 2], "US", "CA", "LA", "2020-01-01") for i in range(1, customers + 1)],
    )
    raw["products"] = table(
        spark, "products", [(i, f"Product {i}", "ABCDE"[i % 5], "B", "M", 5.0, 10.0) for i in range(1, 31)]
    )
    raw["events"] = table(spark, "events", [(i, i % customers + 1, "view", day("2022-01-01", i)) for i in range(1, 101)])
    return raw


def keyed(df: DataFrame, key: str) -> dict:
    return {row[key]: row for row in df.collect()}
