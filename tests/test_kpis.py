import pytest
from pyspark.sql import functions as F

from shopsight.operators import assortment, kpis
from shopsight.sources import catalog
from tests import tables


@pytest.fixture(scope="module")
def month_case(spark):
    orders = tables.orders(spark, [(1, 1, "2024-01-05"), (2, 1, "2024-02-05"), (3, 2, "2024-02-10")])
    items = tables.items(spark, [(1, 1, 1, 10), (1, 1, 2, 30), (2, 1, 1, 20), (3, 2, 2, 50)])
    products = tables.products(spark, [(1, "One", "A"), (2, "Two", "B")])
    catalog.register({"orders": orders, "order_items": items, "products": products})
    return orders, items, products


def test_monthly_kpis(month_case):
    rows = tables.keyed(kpis.compute_monthly_kpis(*month_case[:2]), "year_month")
    assert rows["2024-01"].total_orders == 1 and rows["2024-01"].total_revenue == 40.0
    february = rows["2024-02"]
    assert (february.avg_order_value, february.new_customers, february.repeat_customers) == (35.0, 1, 1)
    assert february.repeat_customer_rate == 0.5


def test_second_order_in_first_month_is_still_new(spark):
    orders = tables.orders(spark, [(1, 1, "2024-01-05"), (2, 1, "2024-01-25")])
    row = kpis.compute_monthly_kpis(orders, tables.items(spark, [(1, 1, 1, 10)])).first()
    assert (row.total_orders, row.new_customers, row.repeat_customers, row.avg_order_value) == (2, 1, 0, 5.0)


def test_sql_twins_agree(spark, month_case):
    orders, items, products = month_case
    for name, ours in (
        ("monthly_kpis", kpis.compute_monthly_kpis(orders, items)),
        ("cohort", kpis.cohort_activity(orders)),
        ("category_analytics", assortment.compute_category_analytics(items, products)),
    ):
        theirs = catalog.run_sql_file(spark, name).select(*ours.columns)
        assert sorted(map(tuple, theirs.collect())) == sorted(map(tuple, ours.collect())), name


def test_sql_rfm_golden_values(spark, month_case):
    rows = tables.keyed(catalog.run_sql_file(spark, "rfm"), "customer_id")
    assert (rows[1].frequency, rows[1].monetary, rows[1].recency) == (2, 60.0, 5)
    assert (rows[2].frequency, rows[2].monetary, rows[2].recency) == (1, 50.0, 0)


def test_cohorts(spark):
    orders = tables.orders(
        spark, [(1, 1, "2023-11-05"), (2, 1, "2024-01-05"), (3, 2, "2023-11-10"), (4, 3, "2024-01-01"), (5, 2, "2023-11-30")]
    )
    wide = kpis.compute_cohort_retention(orders)
    assert wide.columns == ["cohort_month", "0", "2"]
    assert [tuple(r) for r in wide.collect()] == [("2023-11", 1.0, 0.5), ("2024-01", 1.0, None)]
    assert kpis.compute_cohort_retention(orders, 4).columns == ["cohort_month", "0", "1", "2", "3"]


def test_categories_and_products(spark):
    items = tables.items(
        spark, [(1, 1, 1, 10), (1, 1, 2, 30), (2, 1, 1, 20.005), (3, 2, 3, 50), (4, 2, 1, 99, "returned"), (5, 9, 7, 1)]
    )
    products = tables.products(spark, [(1, "One", "A"), (2, "Two", "A"), (3, "Three", None)])
    row = assortment.compute_category_analytics(items, products).collect()
    assert [tuple(r) for r in row] == [("A", 60.01, 2, 1, 20.0, 2)]
    top = assortment.compute_product_analytics(items, products, 3).collect()
    assert [(r.product_id, r.total_revenue, r.order_count) for r in top] == [(3, 50.0, 1), (1, 30.01, 2), (2, 30.0, 1)]
    assert assortment.compute_product_analytics(items, products, 9).filter("name IS NULL").first().product_id == 7


def test_sums_do_not_depend_on_order(spark):
    prices = [0.1, 0.2, 0.3, 1e6 + 0.7] * 500
    for seed in (1, 2):
        items = tables.items(spark, [(1, 1, 1, p) for p in prices]).orderBy(F.rand(seed)).repartition(3)
        row = assortment.compute_category_analytics(items, tables.products(spark, [(1, "One", "A")])).first()
        assert row.total_revenue == 500000650.0
