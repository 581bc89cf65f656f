"""Report queries on the published outputs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsight.contracts import MAX_RECOMMENDATIONS, RISK_LEVELS
from shopsight.functions.money import (
    div_half_up,
    dollars,
    mean_dollars,
    ratio,
    to_micros,
    wide_sum,
)
from shopsight.operators.churn_model import risk_counts
from shopsight.operators.rfm import METRICS

DETAIL_COLUMNS = [
    "customer_id", "first_name", "last_name", "segment", "recency", "frequency", "monetary",
    "r_score", "f_score", "m_score", "rfm_score", "estimated_clv", "country", "age", "gender",
]
SCATTER_COLUMNS = [
    "recency", "monetary", "frequency", "segment", "customer_id", "r_score", "f_score", "m_score", "estimated_clv",
]
HIGH_RISK = RISK_LEVELS[-1]
HISTOGRAM_BINS = 40


def _amount(column: str) -> Column:
    return to_micros(F.col(column))


def _percent(part: Column, whole: Column) -> Column:
    """Share in percent, one decimal; 0 when there is nothing to share."""
    return F.coalesce(F.when(whole > 0, div_half_up(part * 1000, whole) / F.lit(10.0)), F.lit(0.0))


def _tenths(column: str) -> Column:
    return F.floor(F.col(column) * 10 + F.lit(0.5))


# --- executive page ---------------------------------------------------------


def overview(rfm: DataFrame, segments: DataFrame, churn: DataFrame, kpis: DataFrame) -> DataFrame:
    """Headline totals; the repeat rate is the unweighted mean of the months."""
    customers = rfm.agg(F.count("*")).scalar()
    high_risk = churn.agg(F.count_if(F.col("risk_level") == HIGH_RISK)).scalar()
    rates = F.floor(F.col("repeat_customer_rate") * 10_000 + F.lit(0.5))
    repeat = kpis.agg(F.sum(rates) / F.count("*") / F.lit(100.0)).scalar()
    return segments.agg(
        wide_sum(_amount("total_revenue")).alias("micros"), F.sum("total_orders").alias("total_orders")
    ).select(
        customers.alias("total_customers"),
        dollars(F.col("micros")).alias("total_revenue"),
        "total_orders",
        mean_dollars(F.col("micros"), F.col("total_orders")).alias("avg_order_value"),
        repeat.alias("repeat_rate_pct"),
        high_risk.alias("high_risk_customers"),
    )


def monthly_series(kpis: DataFrame) -> DataFrame:
    return kpis.select("year_month", "total_revenue", "total_orders", "new_customers", "repeat_customers")


# --- segment page -----------------------------------------------------------


def segment_base(segments: DataFrame | None, rfm: DataFrame | None) -> DataFrame:
    """Customer table of the segment page.

    RFM adds only the columns the profile lacks; a metric missing from both
    falls back to its order total, then to 0.
    """
    if segments is None and rfm is None:
        raise ValueError("Segment data is not available.")
    if segments is None or rfm is None:
        base = segments if rfm is None else rfm
    else:
        extra = [c for c in rfm.columns if c not in segments.columns]
        base = segments.join(rfm.select("customer_id", *extra), "customer_id", "left") if extra else segments
    fallback = {"monetary": "total_revenue", "frequency": "total_orders"}

    def metric(name: str) -> Column:
        source = name if name in base.columns else fallback.get(name)
        value = F.col(source).try_cast("double") if source in base.columns else F.lit(0.0)
        value = F.coalesce(F.when(~F.isnan(value), value), F.lit(0.0))
        return value.cast("bigint") if name == "frequency" else value

    return base.withColumns({m: metric(m) for m in METRICS})


def filter_options(base: DataFrame) -> DataFrame:
    """Choices of the label filters and bounds of the range filters."""
    labels = [c for c in ("segment", "country", "gender") if c in base.columns]
    pairs = [F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("option")) for c in labels]
    none = F.lit(None)
    choices = (
        base.select(F.inline(F.array(*pairs)))
        .filter(F.col("option").isNotNull())
        .distinct()
        .select("field", "option", none.cast("double").alias("low"), none.cast("double").alias("high"))
    )
    bounds = base.agg(
        *[f(m).cast("double").alias(f"{m}_{f.__name__}") for m in METRICS for f in (F.min, F.max)]
    ).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(m).alias("field"),
                        none.cast("string").alias("option"),
                        F.col(f"{m}_min").alias("low"),
                        F.col(f"{m}_max").alias("high"),
                    )
                    for m in METRICS
                ]
            )
        )
    )
    return choices.unionByName(bounds).orderBy("field", "option")


def filter_customers(
    base: DataFrame,
    segments: Sequence[str] = (),
    countries: Sequence[str] = (),
    genders: Sequence[str] = (),
    recency: tuple[float, float] | None = None,
    frequency: tuple[int, int] | None = None,
    monetary: tuple[float, float] | None = None,
    search: str | None = None,
) -> DataFrame:
    """Label filters (empty means all), inclusive ranges, literal text search."""
    conditions: list[Column] = []
    for column, wanted in (("segment", segments), ("country", countries), ("gender", genders)):
        if wanted and column in base.columns:
            conditions.append(F.col(column).isin(*wanted))
    for column, bounds in (("recency", recency), ("frequency", frequency), ("monetary", monetary)):
        if bounds is not None:
            conditions.append(F.col(column).between(*bounds))
    if search and search.strip():
        text = F.lit(search.strip().lower())
        searched = [c for c in ("customer_id", "first_name", "last_name") if c in base.columns]
        hits = [F.contains(F.lower(F.coalesce(F.col(c).cast("string"), F.lit(""))), text) for c in searched]
        conditions.append(reduce(lambda a, b: a | b, hits))
    return base.filter(reduce(lambda a, b: a & b, conditions)) if conditions else base


def _totals(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("customers"),
        F.coalesce(wide_sum(_amount("monetary")), F.lit(0)).alias("micros"),
        F.coalesce(F.sum("frequency"), F.lit(0)).alias("orders"),
    )


def filter_summary(base: DataFrame, filtered: DataFrame) -> DataFrame:
    """Headline numbers of a filtered customer list.

    The dominant segment is the most frequent one, the first by name on a tie.
    """
    everyone = base.agg(
        F.struct(F.count("*").alias("customers"), wide_sum(_amount("monetary")).alias("micros")).alias("all")
    ).scalar()
    dominant = (
        filtered.filter(F.col("segment").isNotNull())
        .groupBy("segment")
        .count()
        .orderBy(F.desc("count"), "segment")
        .limit(1)
        .select("segment")
        .scalar()
    )
    return (
        _totals(filtered)
        .withColumn("all", everyone)
        .select(
            "customers",
            _percent(F.col("customers"), F.col("all.customers")).alias("customer_share_pct"),
            dollars(F.col("micros")).alias("revenue"),
            _percent(F.col("micros"), F.col("all.micros")).alias("revenue_share_pct"),
            F.coalesce(mean_dollars(F.col("micros"), F.col("customers")), F.lit(0.0)).alias("avg_spend"),
            F.coalesce(
                F.when(F.col("customers") > 0, div_half_up(F.col("orders") * 10, F.col("customers")) / F.lit(10.0)),
                F.lit(0.0),
            ).alias("avg_orders"),
            F.coalesce(dominant, F.lit("N/A")).alias("dominant_segment"),
        )
    )


def segment_revenue(filtered: DataFrame) -> DataFrame:
    return (
        filtered.filter(F.col("segment").isNotNull())
        .groupBy("segment")
        .agg(dollars(wide_sum(_amount("monetary"))).alias("revenue"))
        .orderBy(F.desc("revenue"), "segment")
    )


def segment_matrix(filtered: DataFrame, base: DataFrame) -> DataFrame:
    """Segment metrics; the revenue share is of all customers, not the filtered ones."""
    total = base.agg(wide_sum(_amount("monetary"))).scalar()
    return (
        filtered.filter(F.col("segment").isNotNull())
        .groupBy("segment")
        .agg(
            F.count("*").alias("customer_count"),
            wide_sum(_amount("monetary")).alias("micros"),
            F.sum(_tenths("recency")).alias("recency_tenths"),
            F.sum("frequency").alias("orders"),
        )
        .withColumn("total", total)
        .select(
            "segment",
            "customer_count",
            dollars(F.col("micros")).alias("total_revenue"),
            mean_dollars(F.col("micros"), F.col("customer_count")).alias("avg_revenue"),
            (div_half_up(F.col("recency_tenths"), F.col("customer_count")) / F.lit(10.0)).alias("avg_recency"),
            (div_half_up(F.col("orders") * 10, F.col("customer_count")) / F.lit(10.0)).alias("avg_frequency"),
            _percent(F.col("micros"), F.col("total")).alias("revenue_share"),
        )
        .orderBy(F.desc("total_revenue"), "segment")
    )


def scatter(filtered: DataFrame) -> DataFrame:
    return filtered.select(*[c for c in SCATTER_COLUMNS if c in filtered.columns])


def detail_table(filtered: DataFrame, rows: int = 300) -> DataFrame:
    columns = [c for c in DETAIL_COLUMNS if c in filtered.columns]
    return filtered.select(*columns).orderBy("customer_id").limit(rows)


# --- customer page ----------------------------------------------------------


def customer_360(
    rfm: DataFrame,
    segments: DataFrame,
    churn: DataFrame,
    clv: DataFrame,
    recommendations: DataFrame,
    customer_id: int | None = None,
    top: int = MAX_RECOMMENDATIONS,
) -> DataFrame:
    """One row per customer from all outputs; `customer_id` filters every scan."""

    def only(df: DataFrame) -> DataFrame:
        return df if customer_id is None else df.filter(F.col("customer_id") == customer_id)

    profile_columns = [c for c in segments.columns if c not in rfm.columns and c not in clv.columns]
    entry = F.struct("rank", "product_name", "affinity_score")
    products = (
        only(recommendations)
        .filter(F.col("rank") <= top)
        .groupBy("customer_id")
        .agg(F.array_sort(F.collect_list(entry)).alias("recs"))
        .select(
            "customer_id",
            F.size("recs").cast("bigint").alias("recommendation_count"),
            F.array_join(F.transform("recs", lambda r: r["product_name"]), " | ").alias("recommended_products"),
        )
    )
    return (
        only(rfm)
        .join(only(segments).select("customer_id", *profile_columns), "customer_id", "left")
        .join(only(churn), "customer_id", "left")
        .join(only(clv), "customer_id", "left")
        .join(products, "customer_id", "left")
    )


# --- churn page -------------------------------------------------------------


def risk_breakdown(churn: DataFrame) -> DataFrame:
    return risk_counts(churn)


def probability_histogram(churn: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal bins over [0, 1]; a probability of 1 belongs to the last one."""
    bin_of = F.least(F.floor(F.col("churn_probability") * bins), F.lit(bins - 1)).cast("bigint")
    return (
        churn.groupBy(bin_of.alias("bin"))
        .agg(F.count("*").alias("customers"))
        .select("bin", (F.col("bin") / F.lit(float(bins))).alias("bin_start"), "customers")
        .orderBy("bin")
    )


def high_risk_top(churn: DataFrame, rows: int = 100) -> DataFrame:
    return (
        churn.filter(F.col("risk_level") == HIGH_RISK)
        .select("customer_id", "churn_probability", "risk_level")
        .orderBy(F.desc("churn_probability"), "customer_id")
        .limit(rows)
    )


def top_features(importance: DataFrame, rows: int = 10) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(rows)


# --- recommendation, category and cohort pages ------------------------------


def recommendation_categories(recommendations: DataFrame, rows: int = 15) -> DataFrame:
    return (
        recommendations.filter(F.col("category").isNotNull())
        .groupBy("category")
        .agg(F.count("*").alias("recommendations"))
        .orderBy(F.desc("recommendations"), "category")
        .limit(rows)
    )


def category_totals(categories: DataFrame) -> DataFrame:
    """`order_count_total` adds up per-category distinct orders."""
    return categories.agg(
        F.count("*").alias("categories"),
        dollars(wide_sum(_amount("total_revenue"))).alias("total_revenue"),
        F.sum("order_count").alias("order_count_total"),
    )


def category_top(categories: DataFrame, rows: int = 15) -> DataFrame:
    """Largest categories by revenue, shown by number of customers."""
    return (
        categories.orderBy(F.desc("total_revenue"), "category")
        .limit(rows)
        .select("category", "total_revenue", "unique_customers")
        .orderBy(F.desc("unique_customers"), "category")
    )


def cohort_heatmap(retention: DataFrame, months: int = 12) -> DataFrame:
    """First offsets of the wide retention table, in percent."""
    offsets = sorted((c for c in retention.columns if c.isdigit()), key=int)[:months]
    return retention.select("cohort_month", *[(F.col(c) * 100).alias(c) for c in offsets]).orderBy("cohort_month")


# --- diagnostics ------------------------------------------------------------


def score_counts(profile: DataFrame) -> DataFrame:
    """Customers per value of each score."""
    scores = ["r_score", "f_score", "m_score"]
    pairs = [F.struct(F.lit(s).alias("score_name"), F.col(s).cast("bigint").alias("score")) for s in scores]
    return (
        profile.select(F.inline(F.array(*pairs)))
        .groupBy("score_name", "score")
        .agg(F.count("*").alias("customers"))
        .orderBy("score_name", "score")
    )


def frequency_shares(profile: DataFrame, rows: int = 5) -> DataFrame:
    """The most common order counts and their share of all customers."""
    total = profile.agg(F.count("*")).scalar()
    return (
        profile.groupBy("frequency")
        .agg(F.count("*").alias("customers"))
        .withColumn("share", F.col("customers") / total)
        .orderBy(F.desc("customers"), "frequency")
        .limit(rows)
    )


def frequency_score_table(profile: DataFrame) -> DataFrame:
    """Customers by order count (rows) and frequency score (columns)."""
    scores = range(1, 6)
    return (
        profile.groupBy("frequency")
        .pivot("f_score", list(scores))
        .count()
        .select("frequency", *[F.coalesce(F.col(str(s)), F.lit(0)).alias(f"f_score_{s}") for s in scores])
        .orderBy("frequency")
    )


def score_pairs(profile: DataFrame, segment: str = "Other") -> DataFrame:
    """Score pairs inside one segment."""
    return (
        profile.filter(F.col("segment") == segment)
        .groupBy("r_score", "f_score")
        .agg(F.count("*").alias("customers"))
        .orderBy(F.desc("customers"), "r_score", "f_score")
    )


def segment_share(profile: DataFrame, segment: str) -> DataFrame:
    """Customer and revenue share of one segment, in percent."""
    member = F.col("segment") == segment
    return profile.agg(
        F.count_if(member).alias("customers"),
        F.count("*").alias("all_customers"),
        F.coalesce(wide_sum(F.when(member, _amount("monetary"))), F.lit(0)).alias("micros"),
        wide_sum(_amount("monetary")).alias("all_micros"),
    ).select(
        F.lit(segment).alias("segment"),
        "customers",
        (ratio(F.col("customers"), F.col("all_customers")) * 100).alias("customer_share_pct"),
        dollars(F.col("micros")).alias("revenue"),
        (ratio(F.col("micros"), F.col("all_micros")) * 100).alias("revenue_share_pct"),
    )
