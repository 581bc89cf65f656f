"""Recommendations from segment popularity, without what a customer owns.

0. The completed items are counted once per customer and product, and stored;
   everything below reads these counts.
1. Popularity per (segment, product).
2. The candidate pool: the most popular products of each segment and overall,
   with their metadata. It holds at most (#segments + 1) x pool size rows and is
   stored, so the planner knows its size when it decides how to join it.
3. Per customer, the set of pool products owned and of pool categories bought:
   bounded by the pool, combined on the map side.
4. The choice itself is row-local: each customer carries its set, its segment
   brings a candidate list, and array functions pick the best unowned ones. No
   customer x product pairs are ever built.

Ties in popularity go to the smaller product id.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shopsight.contracts import (
    MAX_RECOMMENDATIONS,
    MIN_POOL,
    POOL_PER_RECOMMENDATION,
    TEXT_NEW_CATEGORY,
    TEXT_SAME_CATEGORY,
    TEXT_TRENDING,
)
from shopsight.functions.money import ratio
from shopsight.operators.purchases import completed
from shopsight.sources.scratch import materialize

SEGMENT_SOURCE, OVERALL_SOURCE = "segment", "overall"
OUTPUT_COLUMNS = [
    "customer_id", "product_id", "product_name", "category", "brand", "affinity_score", "explanation", "rank",
]
_CHOICE = "array<struct<product_id:bigint,purchase_count:bigint,known:boolean,overall:boolean>>"


def default_pool(max_recs: int) -> int:
    return max(max_recs * POOL_PER_RECOMMENDATION, MIN_POOL)


def completed_purchases(items: DataFrame) -> DataFrame:
    """Purchases by item status; the item's own customer id counts here."""
    return completed(items).select(F.col("user_id").alias("customer_id"), "product_id")


def purchase_counts(items: DataFrame) -> DataFrame:
    """Stored item rows per (customer_id, product_id)."""
    counts = completed_purchases(items).groupBy("customer_id", "product_id").agg(F.count("*").alias("purchases"))
    return materialize(counts, "purchase-counts")


def customers_of(segments: DataFrame) -> DataFrame:
    return segments.select("customer_id", "segment").distinct()


def popularity(items: DataFrame, segments: DataFrame) -> DataFrame:
    """Item rows per (segment, product); segment is NULL for unsegmented buyers."""
    return (
        completed_purchases(items)
        .join(customers_of(segments), "customer_id", "left")
        .groupBy("segment", "product_id")
        .agg(F.count("*").alias("purchase_count"))
    )


def counted_popularity(purchases: DataFrame, customers: DataFrame) -> DataFrame:
    return (
        purchases.join(customers, "customer_id", "left")
        .groupBy("segment", "product_id")
        .agg(F.sum("purchases").alias("purchase_count"))
    )


def segment_popularity(counts: DataFrame) -> DataFrame:
    return counts.filter(F.col("segment").isNotNull())


def overall_popularity(counts: DataFrame) -> DataFrame:
    return counts.groupBy("product_id").agg(F.sum("purchase_count").alias("purchase_count"))


def candidate_pool(counts: DataFrame, segment_pool: int, overall_pool: int) -> DataFrame:
    """Most popular products: (segment, product_id, purchase_count), segment NULL overall."""
    order = [F.desc("purchase_count"), F.asc("product_id")]
    in_segment = W.partitionBy("segment").orderBy(*order)
    per_segment = (
        segment_popularity(counts)
        .withColumn("_place", F.row_number().over(in_segment))
        .filter(F.col("_place") <= segment_pool)
        .drop("_place")
    )
    overall = overall_popularity(counts).orderBy(*order).limit(overall_pool)
    return per_segment.unionByName(
        overall.select(F.lit(None).cast("string").alias("segment"), "product_id", "purchase_count")
    )


def described_pool(pool: DataFrame, products: DataFrame) -> DataFrame:
    metadata = products.select(
        F.col("id").alias("product_id"), F.col("name").alias("product_name"), "category", "brand"
    )
    return pool.join(metadata, "product_id", "left")


def _candidate_list() -> Column:
    entry = F.struct(
        (-F.col("purchase_count")).alias("_order"),
        "product_id",
        "purchase_count",
        F.col("product_name").isNotNull().alias("known"),
    )
    return F.array_sort(F.collect_list(entry)).alias("candidates")


def customer_history(items: DataFrame, products: DataFrame, pool: DataFrame) -> DataFrame:
    """Per customer: pool products owned and pool categories bought from."""
    return counted_history(purchase_counts(items), products, pool)


def counted_history(purchases: DataFrame, products: DataFrame, pool: DataFrame) -> DataFrame:
    owned = purchases.join(pool.select("product_id").distinct(), "product_id", "left_semi").select(
        "customer_id", "product_id", F.lit(None).cast("string").alias("category")
    )
    pool_categories = pool.select("category").filter(F.col("category").isNotNull()).distinct()
    categorized = products.select(F.col("id").alias("product_id"), "category").join(
        pool_categories, "category", "left_semi"
    )
    bought = purchases.join(categorized, "product_id").select(
        "customer_id", F.lit(None).cast("bigint").alias("product_id"), "category"
    )
    return (
        owned.unionByName(bought)
        .groupBy("customer_id")
        .agg(F.collect_set("product_id").alias("owned"), F.collect_set("category").alias("categories"))
    )


def _choose(candidates: Column, excluded: Column, count: Column | int, overall: bool) -> Column:
    open_choices = F.filter(candidates, lambda c: ~F.array_contains(excluded, c["product_id"]))
    best = F.slice(open_choices, 1, count)
    chosen = F.transform(
        best,
        lambda c: F.struct(
            c["product_id"].cast("bigint").alias("product_id"),
            c["purchase_count"].alias("purchase_count"),
            c["known"].alias("known"),
            F.lit(overall).alias("overall"),
        ),
    )
    return F.coalesce(chosen, F.array().cast(_CHOICE))


def ranked_choices(
    segments: DataFrame, history: DataFrame, pool: DataFrame, max_recs: int = MAX_RECOMMENDATIONS
) -> DataFrame:
    """One row per customer and chosen product, with rank and source.

    Customers whose segment list runs short are filled up from the overall
    list; their ranks continue.
    """
    return _ranked(customers_of(segments), history, pool, max_recs)


def _ranked(customers: DataFrame, history: DataFrame, pool: DataFrame, max_recs: int) -> DataFrame:
    by_segment = pool.filter(F.col("segment").isNotNull()).groupBy("segment").agg(_candidate_list())
    overall = pool.filter(F.col("segment").isNull()).agg(_candidate_list()).scalar()
    nothing = F.array().cast("array<bigint>")
    customers = (
        customers.join(history, "customer_id", "left")
        .join(by_segment, "segment", "left")
        .withColumn("owned", F.coalesce("owned", nothing))
        .withColumn("primary", _choose(F.col("candidates"), F.col("owned"), max_recs, overall=False))
        .withColumn("overall", overall)
    )
    taken = F.concat("owned", F.transform("primary", lambda c: c["product_id"]))
    missing = F.lit(max_recs) - F.size("primary")
    backfill = F.when(missing > 0, _choose(F.col("overall"), taken, missing, overall=True)).otherwise(
        F.array().cast(_CHOICE)
    )
    chosen = customers.withColumn("choices", F.concat("primary", backfill))
    top = F.array_max(
        F.transform(F.filter("choices", lambda c: c["known"]), lambda c: c["purchase_count"])
    )
    return chosen.select(
        "customer_id", "segment", "categories", top.alias("top_count"), F.posexplode("choices").alias("_at", "choice")
    ).select(
        "customer_id",
        "segment",
        "categories",
        "top_count",
        (F.col("_at") + 1).cast("bigint").alias("rank"),
        "choice.product_id",
        "choice.purchase_count",
        "choice.known",
        F.when(F.col("choice.overall"), OVERALL_SOURCE).otherwise(SEGMENT_SOURCE).alias("source"),
    )


def _fill(template: str, **columns: Column) -> Column:
    """Text template as one concat expression."""
    parts: list[Column] = []
    for text, field, _, _ in Formatter().parse(template):
        if text:
            parts.append(F.lit(text))
        if field:
            parts.append(columns[field])
    return F.concat(*parts)


def explanation() -> Column:
    names = {c: F.coalesce(F.col(c), F.lit("")) for c in ("segment", "category")}
    familiar = F.coalesce(F.array_contains("categories", F.col("category")), F.lit(False))
    return (
        F.when(F.col("source") == OVERALL_SOURCE, TEXT_TRENDING)
        .when(familiar, _fill(TEXT_SAME_CATEGORY, **names))
        .otherwise(_fill(TEXT_NEW_CATEGORY, **names))
    )


def describe_choices(choices: DataFrame, pool: DataFrame) -> DataFrame:
    """Metadata, affinity and explanation; products without metadata drop out."""
    metadata = pool.select("product_id", "product_name", "category", "brand").distinct()
    return (
        choices.filter("known")
        .join(metadata, "product_id")
        .withColumn("affinity_score", ratio(F.col("purchase_count"), F.col("top_count")))
        .withColumn("explanation", explanation())
        .select(*OUTPUT_COLUMNS)
    )


def build_pool(
    items: DataFrame, products: DataFrame, segments: DataFrame, segment_pool: int, overall_pool: int
) -> DataFrame:
    return counted_pool(purchase_counts(items), products, customers_of(segments), segment_pool, overall_pool)


def counted_pool(
    purchases: DataFrame, products: DataFrame, customers: DataFrame, segment_pool: int, overall_pool: int
) -> DataFrame:
    """The candidate pool, stored; so is the popularity, of which it takes two cuts."""
    counts = materialize(counted_popularity(purchases, customers), "popularity")
    return materialize(described_pool(candidate_pool(counts, segment_pool, overall_pool), products), "pool")


def build_recommendations(
    items: DataFrame,
    products: DataFrame,
    segments: DataFrame,
    max_recs: int = MAX_RECOMMENDATIONS,
    segment_pool: int | None = None,
    overall_pool: int | None = None,
) -> DataFrame:
    """At most `max_recs` products per customer of `segments`."""
    size = default_pool(max_recs)
    purchases, customers = purchase_counts(items), materialize(customers_of(segments), "segments")
    pool = counted_pool(purchases, products, customers, segment_pool or size, overall_pool or size)
    choices = _ranked(customers, counted_history(purchases, products, pool), pool, max_recs)
    return describe_choices(choices, pool)


def customer_recommendations(recommendations: DataFrame, customer_id: int, n: int = MAX_RECOMMENDATIONS) -> DataFrame:
    return recommendations.filter(F.col("customer_id") == customer_id).orderBy("rank").limit(n)
