"""Recency, frequency, monetary: features, scores, segments."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsight.contracts import RFM_BINS, SEGMENT_RULES, UNMATCHED_SEGMENT, SegmentRule
from shopsight.functions import calendar
from shopsight.functions.money import dollars
from shopsight.functions.parsing import is_finite
from shopsight.operators import ranking
from shopsight.operators.purchases import customer_activity, order_span

METRICS = ["recency", "frequency", "monetary"]


def epoch_micros(moment: datetime | str) -> int:
    """Microseconds since the epoch; a moment without a zone is UTC."""
    if isinstance(moment, str):
        moment = datetime.fromisoformat(moment)
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    delta = moment - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds


def build_rfm_features(
    orders: DataFrame, items: DataFrame, observation_date: datetime | str | None = None
) -> DataFrame:
    """RFM features per customer as of `observation_date` (default: latest order)."""
    _, latest = order_span(orders)
    observed = latest if observation_date is None else epoch_micros(observation_date)
    if observed < latest:
        raise ValueError("observation_date cannot be earlier than the latest completed order.")
    return rfm_from_activity(customer_activity(orders, items), observed)


def rfm_from_activity(activity: DataFrame, observed_micros: int) -> DataFrame:
    observed = calendar.at_micros(observed_micros)
    return activity.select(
        "customer_id",
        F.col("last_order_date").alias("last_purchase_date"),
        calendar.elapsed_days_tenths(observed, F.col("last_order_date")).alias("recency"),
        F.col("total_orders").alias("frequency"),
        F.coalesce(dollars(F.col("revenue_micros")), F.lit(0.0)).alias("monetary"),
    )


def _checked(metric: str) -> Column:
    value = F.col(metric).try_cast("double")
    message = f"RFM column '{metric}' must contain only finite numeric values."
    return F.when(is_finite(value), value).otherwise(F.raise_error(F.lit(message)).cast("double"))


def _require(df: DataFrame, columns: list[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"RFM data is missing required columns: {', '.join(missing)}")


def metric_values() -> dict[str, Column]:
    """Values whose ascending order is the scoring order: a low recency is good."""
    return {m: -_checked(m) if m == "recency" else _checked(m) for m in METRICS}


def score_of_position() -> Column:
    """Score 1..RFM_BINS of a tie-averaged rank; a single row scores 3."""
    share = (ranking.average_rank() - 1) / (F.col(ranking.TOTAL) - 1) * (RFM_BINS - 1)
    score = F.least(F.greatest(F.floor(share) + 1, F.lit(1)), F.lit(RFM_BINS))
    return F.when(F.col(ranking.TOTAL) <= 1, F.lit(3)).otherwise(score)


def average_ranks(rfm: DataFrame) -> DataFrame:
    """`rfm` plus the tie-averaged rank of each metric, best last."""
    _require(rfm, ["customer_id", *METRICS])
    return ranking.average_ranks(rfm, metric_values())


def compute_rfm_scores(rfm: DataFrame) -> DataFrame:
    """`rfm` plus r_score, f_score, m_score and their sum.

    `rfm` is read twice (positions, result): pass a stored
    table at scale. A null or non-finite metric fails the job.
    """
    _require(rfm, ["customer_id", *METRICS])
    values = metric_values()
    levels = range(2, RFM_BINS + 1)
    cutoffs = ranking.level_cutoffs(ranking.stack(rfm, values), score_of_position(), METRICS, levels)

    def score(metric: str) -> Column:
        reached = [
            F.coalesce(values[metric] >= F.col("_cutoffs").getField(f"{metric}_{k}"), F.lit(False)).cast("bigint")
            for k in levels
        ]
        return reduce(lambda a, b: a + b, reached, F.lit(1).cast("bigint"))

    columns = [c for c in rfm.columns if c not in ("r_score", "f_score", "m_score", "rfm_score")]
    return (
        rfm.select(*columns)
        .withColumn("_cutoffs", cutoffs)
        .select(
            *columns,
            score("recency").alias("r_score"),
            score("frequency").alias("f_score"),
            score("monetary").alias("m_score"),
        )
        .withColumn("rfm_score", F.col("r_score") + F.col("f_score") + F.col("m_score"))
    )


def _matches(rule: SegmentRule) -> Column:
    condition = F.col("r_score").between(*rule.r) & F.col("m_score").between(*rule.m)
    if rule.f is not None:
        condition &= F.col("f_score").between(*rule.f)
    if rule.orders is not None:
        condition &= F.col("frequency") == rule.orders
    return condition


def segment_of(rules: list[SegmentRule] = SEGMENT_RULES) -> Column:
    """The rule table as one CASE expression, first match wins."""
    head, *rest = rules
    case = F.when(_matches(head), head.segment)
    for rule in rest:
        case = case.when(_matches(rule), rule.segment)
    return case.otherwise(UNMATCHED_SEGMENT)


def assign_segments(scored: DataFrame) -> DataFrame:
    return scored.withColumn("segment", segment_of())


def segment_counts(segmented: DataFrame) -> DataFrame:
    return (
        segmented.groupBy("segment")
        .agg(F.count("*").alias("customers"))
        .orderBy(F.desc("customers"), "segment")
    )
