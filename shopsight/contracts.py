"""Table contracts and parameters.

The values in this module are fixed: results are only right with exactly these
names, thresholds and texts.
"""

from __future__ import annotations

from typing import NamedTuple

# --- raw tables -------------------------------------------------------------

RAW_COLUMNS: dict[str, list[str]] = {
    "users": ["id", "first_name", "last_name", "email", "age", "gender", "country", "state", "city", "created_at"],
    "orders": ["order_id", "user_id", "status", "created_at", "num_of_item"],
    "order_items": ["id", "order_id", "user_id", "product_id", "status", "created_at", "sale_price"],
    "products": ["id", "name", "category", "brand", "department", "cost", "retail_price"],
    "events": ["id", "user_id", "event_type", "created_at"],
    "inventory_items": ["id", "product_id", "created_at", "sold_at", "cost"],
    "distribution_centers": ["id", "name", "latitude", "longitude"],
}
RAW_TABLES: list[str] = list(RAW_COLUMNS)

PRIMARY_KEYS: dict[str, str] = {t: "order_id" if t == "orders" else "id" for t in RAW_TABLES}

NOT_NULL: dict[str, list[str]] = {
    "users": ["id", "created_at"],
    "orders": ["order_id", "user_id", "status", "created_at"],
    "order_items": ["id", "order_id", "user_id", "product_id", "status", "sale_price"],
    "products": ["id", "name", "category"],
    "events": ["id", "user_id", "event_type", "created_at"],
    "inventory_items": ["id", "product_id"],
    "distribution_centers": ["id", "name"],
}

DATES: dict[str, list[str]] = {
    "users": ["created_at"],
    "orders": ["created_at"],
    "order_items": ["created_at"],
    "events": ["created_at"],
    "inventory_items": ["created_at", "sold_at"],
}

NON_NEGATIVE: dict[str, list[str]] = {
    "orders": ["num_of_item"],
    "order_items": ["sale_price"],
    "products": ["cost", "retail_price"],
    "inventory_items": ["cost"],
}


class ForeignKey(NamedTuple):
    child: str
    child_column: str
    parent: str
    parent_column: str


FOREIGN_KEYS: list[ForeignKey] = [
    ForeignKey("order_items", "order_id", "orders", "order_id"),
    ForeignKey("order_items", "product_id", "products", "id"),
    ForeignKey("orders", "user_id", "users", "id"),
]

# --- parameters -------------------------------------------------------------

COMPLETED_STATUSES = ("complete", "shipped", "processing")
RFM_BINS = 5
CHURN_HORIZON_DAYS = 90
CLV_HORIZON_YEARS = 2.0
DAYS_PER_YEAR = 365.0
MIN_TENURE_YEARS = 0.0833
SHORT_TENURE_DAYS = 30
KMEANS_CLUSTERS = 6
KMEANS_RESTARTS = 10
SEED = 42
TEST_SHARE = 0.20
MIN_TRAINING_CUSTOMERS = 100
MIN_CUSTOMERS_PER_CLASS = 10
MAX_RECOMMENDATIONS = 5
POOL_PER_RECOMMENDATION = 10
MIN_POOL = 50
LOW_RISK_BELOW = 0.30
HIGH_RISK_FROM = 0.60
MAX_AGE = 120


class SegmentRule(NamedTuple):
    """Inclusive score ranges; `orders` restricts the raw order count."""

    segment: str
    r: tuple[int, int]
    f: tuple[int, int] | None
    m: tuple[int, int]
    orders: int | None = None


# First match wins.
SEGMENT_RULES: list[SegmentRule] = [
    SegmentRule("New Customers", (4, 5), None, (1, 5), orders=1),
    SegmentRule("Champions", (4, 5), (4, 5), (4, 5)),
    SegmentRule("Loyal Customers", (3, 5), (4, 5), (1, 5)),
    SegmentRule("Potential Loyalists", (4, 5), (2, 3), (1, 5)),
    SegmentRule("Promising", (3, 3), (1, 3), (1, 5)),
    SegmentRule("At Risk", (2, 2), (3, 5), (1, 5)),
    SegmentRule("Cannot Lose Them", (1, 1), (4, 5), (1, 5)),
    SegmentRule("Hibernating", (2, 2), (1, 2), (1, 5)),
    SegmentRule("Lost Customers", (1, 1), (1, 2), (1, 5)),
]
UNMATCHED_SEGMENT = "Other"

CLUSTER_LABELS = [
    "High Value",
    "Loyal Active",
    "Moderate Buyers",
    "Occasional Buyers",
    "Low Engagement",
    "Inactive",
]

CHURN_FEATURES = [
    "recency",
    "frequency",
    "monetary",
    "avg_order_value",
    "n_unique_products",
    "tenure_days",
    "is_male",
    "age",
]

# Explanation texts of a recommendation.
TEXT_TRENDING = "Trending product: popular across all customers in our platform."
TEXT_SAME_CATEGORY = (
    "Recommended because you've purchased from '{category}' before, "
    "and this product is popular among {segment} customers like you."
)
TEXT_NEW_CATEGORY = (
    "Recommended because customers in the '{segment}' segment "
    "frequently purchase from the '{category}' category."
)

# --- outputs ----------------------------------------------------------------

RISK_LEVELS = ("Low Risk", "Medium Risk", "High Risk")


class OutputContract(NamedTuple):
    """Columns an output must have; `numeric` ones must be of a numeric type."""

    path: str
    required: list[str]
    numeric: list[str]


OUTPUTS: dict[str, OutputContract] = {
    "customer_rfm": OutputContract(
        "customer_rfm.parquet",
        ["customer_id", "last_purchase_date", "recency", "frequency", "monetary",
         "r_score", "f_score", "m_score", "rfm_score", "segment"],
        ["recency", "frequency", "monetary", "r_score", "f_score", "m_score", "rfm_score"],
    ),
    "customer_segments": OutputContract(
        "customer_segments.parquet",
        ["customer_id", "total_orders", "first_order_date", "last_order_date", "total_revenue",
         "avg_order_value", "n_unique_products", "tenure_days", "annual_frequency", "estimated_clv",
         "segment", "r_score", "f_score", "m_score", "rfm_score", "recency", "frequency", "monetary"],
        ["total_orders", "total_revenue", "avg_order_value", "n_unique_products", "tenure_days",
         "annual_frequency", "estimated_clv", "r_score", "f_score", "m_score", "rfm_score",
         "recency", "frequency", "monetary"],
    ),
    "churn_predictions": OutputContract(
        "churn_predictions.parquet",
        ["customer_id", "churn_probability", "churn_prediction", "risk_level"],
        ["churn_probability", "churn_prediction"],
    ),
    "churn_feature_importance": OutputContract(
        "churn_feature_importance.parquet", ["feature", "importance"], ["importance"]
    ),
    "monthly_kpis": OutputContract(
        "monthly_kpis.parquet",
        ["year_month", "total_revenue", "total_orders", "unique_customers", "avg_order_value",
         "new_customers", "repeat_customers", "repeat_customer_rate"],
        ["total_revenue", "total_orders", "unique_customers", "avg_order_value",
         "new_customers", "repeat_customers", "repeat_customer_rate"],
    ),
    "cohort_retention": OutputContract("cohort_retention.parquet", ["cohort_month"], []),
    "category_analytics": OutputContract(
        "category_analytics.parquet",
        ["category", "total_revenue", "order_count", "unique_customers", "avg_selling_price", "product_count"],
        ["total_revenue", "order_count", "unique_customers", "avg_selling_price", "product_count"],
    ),
    "recommendations": OutputContract(
        "recommendations.parquet",
        ["customer_id", "product_id", "product_name", "category", "brand",
         "affinity_score", "explanation", "rank"],
        ["product_id", "affinity_score", "rank"],
    ),
    "clv": OutputContract(
        "customer_clv.parquet",
        ["customer_id", "estimated_clv", "annual_frequency"],
        ["estimated_clv", "annual_frequency"],
    ),
}

# What CSV files write for a missing value, and the forms of dates
# besides ISO that are read, in the order in which they are tried.
NULL_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
]
DATE_FORMATS = [
    "yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd HH:mm", "yyyy/MM/dd",
    "MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy HH:mm", "MM/dd/yyyy",
]
