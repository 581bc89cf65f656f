"""The retail model on top of the TPC-H-like test tables.

`Model` gives clean tables; `Model.dirty` gives text tables with faults whose
places follow from the keys, so that SQL can build the same ones.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsight.plans import customers
from shopsight.session import tune
from shopsight.sources.scratch import materialize

ORPHAN_OFFSET = 1_000_000_000


def _case(column: str, mapping: dict[str, str]) -> Column:
    case = None
    for value, label in mapping.items():
        case = F.when(F.col(column) == value, label) if case is None else case.when(F.col(column) == value, label)
    return case


def _every(key: Column, n: int) -> Column:
    return key % n == 0


class Model:
    """Lazy model tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = tune(spark)
        self.sf_dir = sf_dir

    def source(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")

    # --- clean tables -------------------------------------------------------

    @cached_property
    def users(self) -> DataFrame:
        key = F.col("c_custkey")
        nation = self.source("nation").join(
            self.source("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
        )
        return (
            self.source("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(
                key.alias("id"),
                F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
                F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
                F.concat(F.lit("c"), key.cast("string"), F.lit("@example.com")).alias("email"),
                (18 + key % 60).alias("age"),
                F.when(_every(key, 2), "M").otherwise("F").alias("gender"),
                F.col("n_name").alias("country"),
                F.col("r_name").alias("state"),
                F.col("c_mktsegment").alias("city"),
                F.lit("1992-01-01 00:00:00").cast("timestamp").alias("created_at"),
            )
        )

    @cached_property
    def orders(self) -> DataFrame:
        status = _case("o_orderstatus", {"F": "complete", "O": "processing", "P": "cancelled"})
        return self.source("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("user_id"),
            status.alias("status"),
            F.col("o_orderdate").cast("timestamp").alias("created_at"),
            (1 + F.col("o_orderkey") % 7).alias("num_of_item"),
        )

    @cached_property
    def same_owner_orders(self) -> DataFrame:
        """The orders, every third one twice."""
        return self.orders.unionByName(self.orders.filter(F.col("order_id") % 3 == 0))

    @cached_property
    def repeated_orders(self) -> DataFrame:
        """The orders, every third one twice and every fifth one again later under another customer."""
        again = self.orders.filter(F.col("order_id") % 3 == 0)
        later = self.orders.filter(F.col("order_id") % 5 == 0).withColumns(
            {"user_id": F.col("user_id") + 1, "created_at": F.col("created_at") + F.expr("INTERVAL 1 DAY")}
        )
        return self.orders.unionByName(again).unionByName(later)

    @cached_property
    def bare_items(self) -> DataFrame:
        """Items without customer and date, for operators that take both from the order."""
        status = _case("l_returnflag", {"A": "complete", "N": "shipped", "R": "returned"})
        return self.source("lineitem").select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            status.alias("status"),
            F.col("l_extendedprice").alias("sale_price"),
        )

    @cached_property
    def items(self) -> DataFrame:
        owners = self.orders.select("order_id", "user_id", "created_at")
        return self.bare_items.join(owners, "order_id", "left").select(
            "id", "order_id", "user_id", "product_id", "status", "created_at", "sale_price"
        )

    @cached_property
    def products(self) -> DataFrame:
        return self.source("part").select(
            F.col("p_partkey").alias("id"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("brand"),
            F.when(F.col("p_size") <= 25, "Small").otherwise("Large").alias("department"),
            (F.col("p_retailprice") - 100).alias("cost"),
            F.col("p_retailprice").alias("retail_price"),
        )

    @cached_property
    def events(self) -> DataFrame:
        return self.source("events").select(
            F.col("event_id").alias("id"), "user_id", "event_type", F.col("ts").cast("timestamp").alias("created_at")
        )

    @cached_property
    def inventory_items(self) -> DataFrame:
        shipped = F.col("l_shipdate").cast("timestamp")
        return self.source("lineitem").select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
            F.col("l_partkey").alias("product_id"),
            shipped.alias("created_at"),
            F.when(F.col("l_linestatus") == "F", shipped).alias("sold_at"),
            F.col("l_extendedprice").alias("cost"),
        )

    @cached_property
    def distribution_centers(self) -> DataFrame:
        return self.source("supplier").select(
            F.col("s_suppkey").alias("id"),
            F.col("s_name").alias("name"),
            (F.col("s_suppkey") % 180 - 90).cast("double").alias("latitude"),
            (F.col("s_nationkey") * 14 - 180).cast("double").alias("longitude"),
        )

    @property
    def tables(self) -> dict[str, DataFrame]:
        return {
            "users": self.users,
            "orders": self.orders,
            "order_items": self.items,
            "products": self.products,
            "events": self.events,
            "inventory_items": self.inventory_items,
            "distribution_centers": self.distribution_centers,
        }

    # --- dirty tables -------------------------------------------------------

    @staticmethod
    def _with_copies(df: DataFrame, key: str, changed: str, change: Column) -> DataFrame:
        """Repeat every 71st key; every second repeat differs in one column."""
        copies = df.filter(_every(F.col("_k"), 71)).withColumn(
            changed, F.when(_every(F.col("_k"), 142), change).otherwise(F.col(changed))
        )
        return df.unionByName(copies).drop("_k")

    @staticmethod
    def _text(ts: str) -> Column:
        return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")

    @staticmethod
    def _padded(column: str) -> Column:
        return F.concat(F.lit("  "), F.upper(column), F.lit(" "))

    @staticmethod
    def _price(column: str, key: Column) -> Column:
        amount = F.col(column).cast("decimal(18,2)")
        return (
            F.when(_every(key, 79), "abc").when(_every(key, 83), (-amount).cast("string")).otherwise(amount.cast("string"))
        )

    @cached_property
    def dirty(self) -> dict[str, DataFrame]:
        key, none = F.col("_k"), F.lit(None).cast("string")

        users = self.users.withColumn("_k", F.col("id")).select(
            F.when(~_every(key, 97), key.cast("string")).alias("id"),
            "first_name", "last_name", "email",
            F.when(_every(key, 43), "n/a").when(_every(key, 47), "130").when(_every(key, 53), "-5")
            .otherwise(F.col("age").cast("string")).alias("age"),
            F.concat(F.lit(" "), "gender", F.lit(" ")).alias("gender"),
            F.concat(F.lit("  "), "country").alias("country"),
            F.concat("state", F.lit("  ")).alias("state"),
            "city",
            F.when(_every(key, 89), "not a date").otherwise(self._text("created_at")).alias("created_at"),
            "_k",
        )
        users = self._with_copies(users, "id", "age", F.lit("99"))

        owner = F.col("user_id") + F.when(_every(key, 67), ORPHAN_OFFSET).otherwise(0)
        orders = self.orders.withColumn("_k", F.col("order_id")).select(
            key.cast("string").alias("order_id"),
            F.when(~_every(key, 97), owner.cast("string")).alias("user_id"),
            self._padded("status").alias("status"),
            F.when(_every(key, 89), "not a date").otherwise(self._text("created_at")).alias("created_at"),
            F.when(_every(key, 59), "-1").otherwise(F.col("num_of_item").cast("string")).alias("num_of_item"),
            "_k",
        )
        orders = self._with_copies(orders, "order_id", "num_of_item", F.lit("9"))

        buyer = F.col("user_id") + F.when(_every(F.col("order_id"), 61), 1).otherwise(0)
        items = self.items.withColumn("_k", F.col("product_id")).select(
            F.col("id").cast("string").alias("id"),
            (F.col("order_id") + F.when(_every(F.col("order_id"), 73), ORPHAN_OFFSET).otherwise(0))
            .cast("string").alias("order_id"),
            F.when(~_every(key, 97), buyer.cast("string")).alias("user_id"),
            F.when(~_every(key, 101), key.cast("string")).alias("product_id"),
            self._padded("status").alias("status"),
            self._text("created_at").alias("created_at"),
            self._price("sale_price", key).alias("sale_price"),
        )

        products = self.products.withColumn("_k", F.col("id")).select(
            F.when(~_every(key, 97), key.cast("string")).alias("id"),
            F.concat(F.lit(" "), "name", F.lit(" ")).alias("name"),
            F.when(~_every(key, 103), F.concat(F.lit(" "), "category")).alias("category"),
            "brand", "department",
            self._price("cost", key).alias("cost"),
            F.col("retail_price").cast("decimal(18,2)").cast("string").alias("retail_price"),
            "_k",
        )
        products = self._with_copies(products, "id", "brand", F.lit("Brand#0"))

        events = self.events.withColumn("_k", F.col("id")).select(
            key.cast("string").alias("id"),
            F.when(~_every(key, 97), F.col("user_id").cast("string")).alias("user_id"),
            F.when(~_every(key, 101), self._padded("event_type")).alias("event_type"),
            F.when(_every(key, 89), "not a date").otherwise(self._text("created_at")).alias("created_at"),
        )

        inventory = self.inventory_items.withColumn("_k", F.col("product_id")).select(
            F.col("id").cast("string").alias("id"),
            key.cast("string").alias("product_id"),
            self._text("created_at").alias("created_at"),
            F.when(_every(key, 89), "not a date").otherwise(self._text("sold_at")).alias("sold_at"),
            self._price("cost", key).alias("cost"),
        )

        centers = self.distribution_centers.select(
            F.col("id").cast("string").alias("id"),
            F.when(F.col("id") == 0, none).otherwise(F.col("name")).alias("name"),
            "latitude", "longitude",
        )
        return {
            "users": users,
            "orders": orders,
            "order_items": items,
            "products": products,
            "events": events,
            "inventory_items": inventory,
            "distribution_centers": centers,
        }

    # --- stored intermediate results ---------------------------------------

    @cached_property
    def activity(self) -> DataFrame:
        return customers.stored_activity(self.orders, self.bare_items)

    @cached_property
    def rfm_activity(self) -> DataFrame:
        """The customer table as far as RFM needs it; the full one if it exists already."""
        full = self.__dict__.get("activity")
        return full if full is not None else customers.stored_activity(self.orders, self.bare_items, variety=False)

    @cached_property
    def rfm(self) -> DataFrame:
        return customers.rfm_features(self.rfm_activity)

    @cached_property
    def segmented(self) -> DataFrame:
        """Stored, as the published table that reports read."""
        return materialize(customers.segmented(self.rfm_activity), "rfm")

    @cached_property
    def profile(self) -> DataFrame:
        activity = self.activity
        return materialize(customers.full_profile(activity, self.users, self.segmented), "profile")
