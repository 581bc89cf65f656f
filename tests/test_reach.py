"""Distinct counts by bitmaps."""

import random

import pytest

from shopsight.operators import assortment, reach
from shopsight.sources import catalog
from tests import tables
from tests.test_plans import plan_of

RANDOM = random.Random(6)
# Products, orders and customers of all signs and sizes; an order of two customers, missing identifiers, a hot customer.
ROWS = [(RANDOM.randint(1, 9), RANDOM.choice([0, -5, 40_000, 2**40, 7, None, RANDOM.randint(1, 300)]), 1 + i % 3) for i in range(600)]
ROWS = [(p, o, 77 if i % 3 == 0 else None if i % 50 == 1 else u * 32_768) for i, (p, o, u) in enumerate(ROWS)]


def expected(key):
    found = {}
    for p, o, u in ROWS:
        orders, users = found.setdefault(key(p), (set(), set()))
        orders.add(o)
        users.add(u)
    return {k: (len(o - {None}), len(u - {None})) for k, (o, u) in found.items()}


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_orders_and_customers(spark, kind):
    """Text identifiers are counted by stored numbers."""
    rows = spark.createDataFrame(ROWS, "product_id long, order_id long, user_id long")
    rows = rows.selectExpr("product_id", f"cast(order_id as {kind}) as order_id", f"cast(user_id as {kind}) as user_id")
    found = reach.orders_and_customers(reach.numbered(rows, "user_id"), "product_id").collect()
    assert {r.product_id: (r.order_count, r.unique_customers) for r in found} == expected(lambda p: p)


def test_bitmaps_of_products_add_up_to_groups(spark):
    rows = spark.createDataFrame(ROWS, "product_id long, order_id long, user_id long")
    fine = reach.bitmaps(rows, ["product_id"], "user_id")
    coarse = reach.counted(reach.merged(fine.selectExpr("*", "product_id % 3 as grp"), ["grp"]), ["grp"], "n")
    assert {r.grp: r.n for r in coarse.collect()} == {k: v[1] for k, v in expected(lambda p: p % 3).items()}


def test_dense_numbers_have_no_gaps(spark):
    names = spark.createDataFrame([(f"k{i % 97:03d}",) for i in range(500)] + [(None,)], "name string")
    found = sorted((r.name, r.number) for r in reach.dense_numbers(names, "name").collect())
    assert found == [(f"k{i:03d}", i + 1) for i in range(97)]
    assert reach.dense_numbers(names.where("false"), "name").count() == 0


def test_items_are_shuffled_once_for_both_counts(spark):
    items = tables.items(spark, [(o, o % 7, o % 5, 2.5) for o in range(1, 50)])
    products = tables.products(spark, [(p, f"P{p}", f"C{p % 2}") for p in range(5)])
    plan = plan_of(assortment.compute_category_analytics(items, products))
    assert "Expand" not in plan
    assert sum("Exchange hashpartitioning" in x and "order_id" in x for x in plan.splitlines()) == 1


def test_sql_file_gives_the_same_counts(spark):
    items = tables.items(spark, [(o % 20, o % 7, o % 5, 2.5) for o in range(1, 80)])
    products = tables.products(spark, [(p, f"P{p}", f"C{p % 2}") for p in range(5)])
    catalog.register({"order_items": items, "products": products})
    assert catalog.run_sql_file(spark, "category_analytics").collect() == assortment.compute_category_analytics(items, products).collect()
