import itertools

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shopsight.contracts import SEGMENT_RULES, UNMATCHED_SEGMENT
from shopsight.operators import customers, purchases, rfm
from tests import tables

HISTORY = [
    (1, 1, "2023-11-01"), (2, 1, "2023-11-15"), (3, 2, "2023-01-01"), (4, 3, "2023-09-01"),
    (5, 3, "2023-10-01"), (6, 3, "2023-11-01"), (7, 4, "2023-06-01"), (8, 5, "2023-11-20"),
]
PRICES = {1: [120, 80], 2: [200], 3: [50, 75, 100], 4: [60], 5: [300], 6: [50], 7: [50], 8: [50]}


@pytest.fixture(scope="module")
def history(spark):
    owner = {o: u for o, u, _ in HISTORY}
    sold = [(o, owner[o], i % 5 + 1, p) for o, prices in PRICES.items() for i, p in enumerate(prices)]
    return tables.orders(spark, HISTORY), tables.items(spark, sold)


def test_features(spark, history):
    features = rfm.build_rfm_features(*history, observation_date="2023-12-01")
    rows = tables.keyed(features, "customer_id")
    assert len(rows) == 5
    assert rows[3].frequency == 3 and rows[3].monetary == 410.0
    assert rows[1].recency == 16.0 and rows[1].monetary == 400.0
    assert min(rows.values(), key=lambda r: r.recency).customer_id == 5


def test_observation_date_defaults_to_latest_order(spark, history):
    assert tables.keyed(rfm.build_rfm_features(*history), "customer_id")[5].recency == 0.0


def test_observation_date_before_latest_order(spark, history):
    with pytest.raises(ValueError, match="earlier"):
        rfm.build_rfm_features(*history, observation_date="2023-11-01")


def test_no_completed_orders(spark, history):
    cancelled = tables.orders(spark, HISTORY, status="cancelled")
    with pytest.raises(ValueError, match="No completed orders"):
        rfm.build_rfm_features(cancelled, history[1])


def test_order_owner_wins_and_status_counts(spark):
    orders = tables.orders(spark, [(1, 1, "2023-01-01"), (2, 2, "2023-01-02")])
    items = tables.items(spark, [(1, 2, 1, 10), (1, 1, 2, 5, "returned"), (2, 2, 1, 7), (99, 1, 1, 3)])
    got = {(r.order_id, r.user_id, r.sale_price) for r in purchases.completed_items(orders, items).collect()}
    assert got == {(1, 1, 10.0), (2, 2, 7.0)}
    rows = tables.keyed(rfm.build_rfm_features(orders, items), "customer_id")
    assert (rows[1].monetary, rows[2].monetary) == (10.0, 7.0)


def scores(spark, rows):
    df = spark.createDataFrame(rows, "customer_id bigint, recency double, frequency bigint, monetary double")
    return tables.keyed(rfm.compute_rfm_scores(df), "customer_id")


TIES = list(
    zip(
        range(1, 11),
        [1.0, 1.0, 1.0, 2.0, 2.0, 3.0, 3.0, 4.0, 4.0, 4.0],
        [1, 1, 2, 2, 3, 3, 4, 4, 5, 5],
        [100.0] * 3 + [200.0] * 2 + [300.0] * 2 + [400.0] * 3,
    )
)


def test_scores_ignore_input_order_and_equal_formula(spark):
    forward, backward = scores(spark, TIES), scores(spark, TIES[::-1])
    assert forward == backward
    frame = pd.DataFrame(TIES, columns=["id", "r", "f", "m"])
    for column, field, ascending in (("r", "r_score", False), ("f", "f_score", True), ("m", "m_score", True)):
        rank = frame[column].rank(method="average", ascending=ascending)
        expected = ((rank - 1) / 9 * 4).apply(int) + 1
        assert [getattr(forward[i], field) for i in frame["id"]] == list(expected)


def test_constant_and_single_row_score_three(spark):
    for rows in ([(i, 5.0, 2, 10.0) for i in range(3)], [(1, 5.0, 2, 10.0)]):
        for row in scores(spark, rows).values():
            assert (row.r_score, row.f_score, row.m_score, row.rfm_score) == (3, 3, 3, 9)


def test_empty_input_keeps_columns(spark):
    df = spark.createDataFrame([], "customer_id bigint, recency double, frequency bigint, monetary double")
    scored = rfm.assign_segments(rfm.compute_rfm_scores(df))
    assert scored.count() == 0 and {"r_score", "rfm_score", "segment"} <= set(scored.columns)


@pytest.mark.parametrize("bad", [None, float("nan"), float("inf")])
def test_non_finite_metric_fails(spark, bad):
    df = spark.createDataFrame(
        [(1, bad, 1, 1.0), (2, 1.0, 1, 1.0)], "customer_id bigint, recency double, frequency bigint, monetary double"
    )
    with pytest.raises(Exception, match="finite numeric"):
        rfm.compute_rfm_scores(df).collect()


def test_missing_column_fails(spark):
    with pytest.raises(ValueError, match="monetary"):
        rfm.compute_rfm_scores(spark.createDataFrame([(1, 1.0, 1)], "customer_id bigint, recency double, frequency bigint"))


def segments(spark, rows):
    df = spark.createDataFrame(rows, "customer_id bigint, frequency bigint, r_score bigint, f_score bigint, m_score bigint")
    return {r.customer_id: r.segment for r in rfm.assign_segments(df).collect()}


def test_segment_boundaries(spark):
    cases = [
        (1, 4, 2, 3, "New Customers"), (1, 4, 4, 5, "New Customers"), (1, 3, 2, 3, "Promising"),
        (1, 5, 2, 3, "New Customers"), (2, 4, 2, 3, "Potential Loyalists"), (2, 5, 5, 5, "Champions"),
        (2, 5, 5, 3, "Loyal Customers"), (2, 1, 3, 2, UNMATCHED_SEGMENT), (2, 4, 1, 2, UNMATCHED_SEGMENT),
    ]
    got = segments(spark, [(i, *c[:4]) for i, c in enumerate(cases)])
    assert [got[i] for i in range(len(cases))] == [c[4] for c in cases]


def test_every_score_combination_has_a_known_label(spark):
    grid = list(itertools.product(range(1, 6), repeat=3))
    got = segments(spark, [(i, 1, *scores_) for i, scores_ in enumerate(grid)])
    assert len(got) == 125
    assert set(got.values()) <= {rule.segment for rule in SEGMENT_RULES} | {UNMATCHED_SEGMENT}


def test_segment_counts_add_up(spark):
    df = spark.createDataFrame([(i, 1, i % 5 + 1, i % 4 + 1, 3) for i in range(60)],
                               "customer_id bigint, frequency bigint, r_score bigint, f_score bigint, m_score bigint")
    assert rfm.segment_counts(rfm.assign_segments(df)).agg(F.sum("customers")).first()[0] == 60


def clv(spark, rows):
    df = spark.createDataFrame(rows, "customer_id bigint, total_orders bigint, avg_order_value double, tenure_days double")
    return tables.keyed(customers.estimate_clv(df), "customer_id")


def test_lifetime_value(spark):
    rows = clv(spark, [(1, 10, 100.0, 365.0), (2, 2, 100.0, 365.0)])
    assert (rows[1].estimated_clv, rows[2].estimated_clv) == (2000.0, 400.0)


def test_short_tenure_takes_the_median_before_replacement(spark):
    rows = clv(spark, [(1, 10, 100.0, 365.0), (2, 2, 100.0, 365.0), (3, 1, 50.0, 0.0)])
    # Raw frequencies are 10, 2 and 1 / 0.0833; their median is 10.
    assert rows[3].annual_frequency == 10.0 and rows[3].estimated_clv == 1000.0


def test_customer_aggregates(spark, history):
    users = tables.raw_tables(spark)["users"]
    rows = tables.keyed(customers.build_customer_aggregates(*history, users), "customer_id")
    assert rows[1].total_orders == 2 and rows[1].total_revenue == 400.0 and rows[1].avg_order_value == 200.0
    assert rows[2].n_unique_products == 3 and rows[2].tenure_days == 0.0
    assert rows[3].tenure_days == 61.0 and rows[3].first_name == "First3"


def test_customer_without_items(spark):
    orders = tables.orders(spark, [(1, 1, "2023-01-01"), (2, 2, "2023-01-05")])
    items = tables.items(spark, [(2, 2, 1, 10)])
    row = tables.keyed(customers.build_customer_aggregates(orders, items, tables.raw_tables(spark)["users"]), "customer_id")[1]
    assert (row.total_revenue, row.avg_order_value, row.n_unique_products) == (0.0, 0.0, None)
