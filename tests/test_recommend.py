"""Recommendations against brute force, and their invariants."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shopsight.operators import recommend
from tests import tables

LABELS = ["Champions", "At Risk", "Promising", "Other"]


def brute_force(sold, segment_of, max_recs, pool_size):
    owned, seg_counts, all_counts = {}, {}, Counter(p for _, p in sold)
    for user, product in sold:
        owned.setdefault(user, set()).add(product)
        if segment_of.get(user) is not None:
            seg_counts.setdefault(segment_of[user], Counter())[product] += 1

    def best(counts):
        return sorted(counts.items(), key=lambda e: (-e[1], e[0]))[:pool_size]

    chosen = set()
    for user, segment in segment_of.items():
        have = owned.get(user, set())
        first = [(p, n, "segment") for p, n in best(seg_counts.get(segment, {})) if p not in have][:max_recs]
        taken = have | {p for p, _, _ in first}
        more = [(p, n, "overall") for p, n in best(all_counts) if p not in taken][: max_recs - len(first)]
        chosen |= {(user, p, n, rank, source) for rank, (p, n, source) in enumerate(first + more, 1)}
    return chosen


@pytest.fixture(scope="module", params=[3, 50])
def case(spark, request):
    rng = random.Random(99)
    sold = [(user, rng.randint(1, 20)) for user in range(1, 21) for _ in range(rng.randint(2, 9))]
    sold += [(1, p) for p in range(1, 21)]  # owns everything
    sold += [(77, 3)] * 60  # bought much, has no segment
    segment_of = {u: LABELS[u % 4] for u in range(1, 21)} | {50: "Champions", 51: None}
    items = tables.items(spark, [(i, u, p, 9.0) for i, (u, p) in enumerate(sold)])
    segments = spark.createDataFrame(list(segment_of.items()), "customer_id bigint, segment string")
    products = tables.products(spark, [(i, f"P{i}", f"C{i % 5}") for i in range(1, 21)])
    return dict(sold=sold, segment_of=segment_of, items=items, segments=segments, products=products, pool=request.param)


def test_choices_equal_brute_force(spark, case):
    pool = recommend.build_pool(case["items"], case["products"], case["segments"], case["pool"], case["pool"])
    history = recommend.customer_history(case["items"], case["products"], pool)
    choices = recommend.ranked_choices(case["segments"], history, pool, 5)
    got = {(r.customer_id, r.product_id, r.purchase_count, r.rank, r.source) for r in choices.collect()}
    assert got == brute_force(case["sold"], case["segment_of"], 5, case["pool"])


def test_invariants(spark, case):
    recs = recommend.build_recommendations(
        case["items"], case["products"], case["segments"], 5, case["pool"], case["pool"]
    )
    rows = recs.collect()
    bought = set(case["sold"])
    assert rows and all((r.customer_id, r.product_id) not in bought for r in rows)
    assert max(Counter(r.customer_id for r in rows).values()) <= 5
    assert all(0 < r.affinity_score <= 1 and r.explanation for r in rows)
    assert recs.columns == recommend.OUTPUT_COLUMNS
    top = recommend.customer_recommendations(recs, 50, 2).collect()
    assert [r["rank"] for r in top] == [1, 2]


def test_explanations_and_missing_metadata(spark):
    items = tables.items(
        spark, [(1, 1, 1, 5), (2, 2, 1, 5), (3, 2, 2, 5), (4, 2, 3, 5), (5, 3, 3, 5), (6, 3, 9, 5), (7, 2, 9, 5), (8, 4, 8, 5)]
    )
    products = tables.products(spark, [(1, "one", "A"), (2, "two", "A"), (3, "three", "B"), (8, "eight", "A")])
    segments = spark.createDataFrame([(1, "S"), (2, "S"), (3, "S"), (4, "T")], "customer_id bigint, segment string")
    rows = recommend.build_recommendations(items, products, segments).collect()
    first = {r.product_id: r for r in rows if r.customer_id == 1}
    # Product 9 has no metadata: it drops out after ranking and leaves a gap.
    assert {p: r["rank"] for p, r in first.items()} == {3: 1, 2: 3, 8: 4}
    assert first[2].explanation == (
        "Recommended because you've purchased from 'A' before, and this product is popular among S customers like you."
    )
    assert first[3].explanation == (
        "Recommended because customers in the 'S' segment frequently purchase from the 'B' category."
    )
    assert first[8].explanation == "Trending product: popular across all customers in our platform."
    assert (first[3].affinity_score, first[2].affinity_score) == (1.0, 0.5)


def test_empty_inputs(spark, case):
    none = case["items"].filter(F.lit(False))
    assert recommend.build_recommendations(none, case["products"], case["segments"]).count() == 0
    returned = case["items"].withColumn("status", F.lit("returned"))
    assert recommend.build_recommendations(returned, case["products"], case["segments"]).count() == 0
    nobody = case["segments"].filter(F.lit(False))
    empty = recommend.build_recommendations(case["items"], case["products"], nobody)
    assert empty.count() == 0 and empty.columns == recommend.OUTPUT_COLUMNS
