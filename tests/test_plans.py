"""What the plans look like, and that skewed keys keep results whole."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from shopsight.operators import assortment, churn_features, kpis, purchases, quality, recommend, rfm
from shopsight.sources.scratch import materialize
from tests import tables

SKEW_SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def forced_skew(spark):
    before = {k: spark.conf.get(k, None) for k in SKEW_SETTINGS}
    for k, v in SKEW_SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def skewed(spark):
    """One order with half of all items, one customer with most orders, one hot product."""
    order_rows = [(o, 1 if o % 3 else o % 50, "2023-%02d-01" % (o % 12 + 1)) for o in range(1, 1001)]
    item_rows = [(7, 1, 1 + i % 40 if i % 2 else 5, 1 + i % 9) for i in range(3000)]
    item_rows += [(o, u, o % 40 + 1, 2.5) for o, u, _ in order_rows for _ in range(2)]
    orders = materialize(tables.orders(spark, order_rows).repartition(8), "orders")
    items = materialize(tables.items(spark, item_rows).repartition(8), "items")
    products = tables.products(spark, [(p, f"P{p}", f"C{p % 4}") for p in range(1, 41)])
    return order_rows, item_rows, orders, items, products


def test_scans_are_pruned_and_filtered(spark, skewed):
    _, _, orders, items, _ = skewed
    plan = plan_of(rfm.rfm_from_activity(purchases.customer_activity(orders, items), 0))
    assert "ReadSchema: struct<order_id:bigint,status:string,sale_price:double>" in plan
    assert plan.count("PushedFilters: [In(status") == 2


def test_no_nested_loops_and_no_global_window(spark, skewed):
    _, _, orders, items, products = skewed
    users = tables.raw_tables(spark)["users"]
    features = rfm.rfm_from_activity(purchases.customer_activity(orders, items), 0)
    segments = features.select("customer_id", F.when(F.col("customer_id") % 2 == 0, "A").otherwise("B").alias("segment"))
    plans = [
        rfm.compute_rfm_scores(features),
        rfm.average_ranks(features),
        kpis.compute_monthly_kpis(orders, items),
        kpis.cohort_activity(orders),
        assortment.compute_category_analytics(items, products),
        assortment.compute_product_analytics(items, products),
        churn_features.build_churn_features(orders, items, users),
        recommend.build_recommendations(items, products, segments),
        quality.quality_report({"orders": orders, "order_items": items, "products": products, "users": users}),
    ]
    for df in plans:
        plan = plan_of(df)
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        lines = plan.splitlines()
        for above, line in zip(lines, lines[1:]):
            if "Exchange SinglePartition" in line:
                assert "Aggregate" in above or "Scalar" in above or "Subquery" in above, above


def test_adaptive_execution_splits_hot_orders(spark, skewed, forced_skew):
    order_rows, item_rows, orders, items, _ = skewed
    variety = purchases.product_variety(orders, items)
    rows = {r.customer_id: r.n_unique_products for r in variety.collect()}
    assert "skew=true" in plan_of(variety)
    owner = {o: u for o, u, _ in order_rows}
    expected: dict[int, set] = {}
    for order, _, product, _ in item_rows:
        expected.setdefault(owner[order], set()).add(product)
    assert rows == {u: len(p) for u, p in expected.items()}


def test_adaptive_execution_splits_hot_customers(spark, skewed, forced_skew):
    order_rows, item_rows, _, items, _ = skewed
    segments = spark.createDataFrame([(u, "AB"[u % 2]) for u in range(0, 40)], "customer_id bigint, segment string")
    counts = recommend.popularity(items, segments)
    rows = {(r.segment, r.product_id): r.purchase_count for r in counts.collect()}
    assert "skew=true" in plan_of(counts)
    assert rows == dict(Counter(("AB"[u % 2] if u < 40 else None, p) for _, u, p, _ in item_rows))


def test_hot_order_is_split_among_completed_items(spark, skewed, forced_skew):
    _, item_rows, orders, items, _ = skewed
    found = purchases.completed_items(orders, items)
    assert found.select("order_id", "user_id", "product_id", "sale_price").collect()
    assert found.count() == len(item_rows)
    assert found.agg(F.sum("sale_price")).first()[0] == pytest.approx(sum(price for *_, price in item_rows))


def test_repeated_order_rows_do_not_multiply_items(spark, skewed):
    _, item_rows, orders, items, _ = skewed
    twice = orders.unionByName(orders.filter("order_id <= 100"))
    assert purchases.completed_items(twice, items).count() == len(item_rows)
