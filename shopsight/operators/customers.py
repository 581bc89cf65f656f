"""Customer profile and lifetime value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsight.contracts import CLV_HORIZON_YEARS, DAYS_PER_YEAR, MIN_TENURE_YEARS, SHORT_TENURE_DAYS
from shopsight.functions import calendar
from shopsight.functions.money import dollars, mean_dollars, round_double
from shopsight.operators import ranking
from shopsight.operators.purchases import customer_activity, order_span, product_variety

PROFILE_COLUMNS = [
    "first_name", "last_name", "email", "age", "gender", "country", "state", "city", "created_at",
]
SCORE_COLUMNS = [
    "segment", "r_score", "f_score", "m_score", "rfm_score", "recency", "frequency", "monetary",
]


def build_customer_aggregates(orders: DataFrame, items: DataFrame, users: DataFrame) -> DataFrame:
    """Purchase statistics and profile, one row per customer with a completed order."""
    _, latest = order_span(orders)
    activity = customer_activity(orders, items).join(product_variety(orders, items), "customer_id", "left")
    return with_profile(purchase_statistics(activity, latest), users)


def purchase_statistics(activity: DataFrame, observed_micros: int) -> DataFrame:
    """`activity` carries the columns of `customer_activity` and `product_variety`."""
    observed = calendar.at_micros(observed_micros)
    return activity.select(
        "customer_id",
        "total_orders",
        "first_order_date",
        "last_order_date",
        F.coalesce(dollars(F.col("revenue_micros")), F.lit(0.0)).alias("total_revenue"),
        "n_unique_products",
        F.coalesce(
            mean_dollars(F.col("revenue_micros"), F.col("orders_with_items")), F.lit(0.0)
        ).alias("avg_order_value"),
        calendar.elapsed_days_tenths(observed, F.col("last_order_date")).alias("recency"),
        calendar.elapsed_days_tenths(F.col("last_order_date"), F.col("first_order_date")).alias("tenure_days"),
    )


def with_profile(statistics: DataFrame, users: DataFrame) -> DataFrame:
    profile = users.select(
        F.col("id").alias("customer_id"), *[c for c in PROFILE_COLUMNS if c in users.columns]
    )
    return statistics.join(profile, "customer_id", "left")


def annual_frequency(aggregates: DataFrame) -> DataFrame:
    """Orders per year of tenure, before short tenures are replaced."""
    years = F.greatest(F.col("tenure_days") / F.lit(DAYS_PER_YEAR), F.lit(MIN_TENURE_YEARS))
    return aggregates.withColumn("annual_frequency", F.col("total_orders") / years)


def estimate_clv(aggregates: DataFrame, horizon_years: float = CLV_HORIZON_YEARS) -> DataFrame:
    """Average order value x annual frequency x horizon.

    Customers with a short tenure take the median frequency of all customers.
    `aggregates` is read three times: pass a stored table at scale.
    """
    rated = annual_frequency(aggregates)
    typical = ranking.median(rated, F.col("annual_frequency"))
    replaced = F.when(F.col("tenure_days") < SHORT_TENURE_DAYS, F.col("_typical")).otherwise(
        F.col("annual_frequency")
    )
    return (
        rated.withColumn("_typical", typical)
        .withColumn("annual_frequency", replaced)
        .drop("_typical")
        .withColumn(
            "estimated_clv",
            round_double(
                F.col("avg_order_value") * F.col("annual_frequency") * F.lit(float(horizon_years)), 2
            ),
        )
    )


def customer_profile(clv: DataFrame, segmented: DataFrame) -> DataFrame:
    """Full profile: lifetime value plus the RFM columns, which win on a clash."""
    own = [c for c in clv.columns if c not in SCORE_COLUMNS]
    return clv.select(*own).join(segmented.select("customer_id", *SCORE_COLUMNS), "customer_id", "left")


def clv_table(profile: DataFrame) -> DataFrame:
    return profile.select("customer_id", "estimated_clv", "annual_frequency")
