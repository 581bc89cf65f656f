"""From clean tables to the full customer profile, scanning the facts once.

`activity` is the only customer table computed from the fact tables. It is
stored, and scores, lifetime value and profile are narrow plans on top of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsight.operators.customers import (
    customer_profile,
    estimate_clv,
    purchase_statistics,
    with_profile,
)
from shopsight.operators.purchases import Facts, customer_activity, product_variety, stored_facts
from shopsight.operators.rfm import assign_segments, compute_rfm_scores, rfm_from_activity
from shopsight.sources.scratch import materialize


def stored_activity(
    orders: DataFrame, items: DataFrame, variety: bool = True, facts: Facts | None = None
) -> DataFrame:
    if variety and facts is None:
        facts = stored_facts(orders, items)
    activity = customer_activity(orders, items, facts)
    if variety:
        activity = activity.join(product_variety(orders, items, facts), "customer_id", "left")
    return materialize(activity, "activity")


def latest_order(activity: DataFrame) -> int:
    """Microseconds since the epoch of the latest completed order."""
    latest = activity.agg(F.max(F.unix_micros("last_order_date"))).first()[0]
    if latest is None:
        raise ValueError("No completed orders found.")
    return latest


def rfm_features(activity: DataFrame) -> DataFrame:
    return rfm_from_activity(activity, latest_order(activity))


def scored(activity: DataFrame) -> DataFrame:
    return compute_rfm_scores(rfm_features(activity))


def segmented(activity: DataFrame) -> DataFrame:
    return assign_segments(scored(activity))


def lifetime_value(activity: DataFrame, users: DataFrame) -> DataFrame:
    """CLV is estimated before the profile text is attached."""
    statistics = purchase_statistics(activity, latest_order(activity))
    return with_profile(estimate_clv(statistics), users)


def full_profile(activity: DataFrame, users: DataFrame, segments: DataFrame | None = None) -> DataFrame:
    return customer_profile(lifetime_value(activity, users), segments or segmented(activity))
