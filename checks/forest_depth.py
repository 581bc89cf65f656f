"""How deep the churn forest needs to be: python -m checks.forest_depth [SF_DIR] [DEPTH...]

Labels of the test tables are close to random, so depth cannot show there. Here the
customers keep their features and get labels with a known signal: three levels of it,
linear parts, thresholds and a product of two features. Prints one row per level and
depth: ROC-AUC on the test part and the time of the fit.
"""

from __future__ import annotations

import sys
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.adapter import Model
from shopsight.contracts import CHURN_FEATURES
from shopsight.operators import churn_features, churn_model
from shopsight.session import local_session

DEPTHS = [6, 8, 10, 12, 16, 30]
SIGNALS = [0.5, 1.0, 2.0]


def with_signal(features: DataFrame, strength: float) -> DataFrame:
    """Labels drawn by a hash of the customer, with odds that follow from the features."""
    numbers = churn_model.prepared(features, CHURN_FEATURES)
    spread = numbers.agg(*[F.struct(F.mean(c).alias("m"), F.greatest(F.stddev(c), F.lit(1e-9)).alias("s")).alias(c) for c in CHURN_FEATURES])
    of = spread.first()
    z = {c: (F.col(c) - of[c]["m"]) / of[c]["s"] for c in CHURN_FEATURES}
    odds = 0.6 * z["recency"] - 0.4 * z["frequency"] + 0.5 * z["age"] * z["monetary"]
    odds = odds + F.when((z["tenure_days"] > 0.5) & (z["avg_order_value"] < 0), 1.0).otherwise(0.0)
    draw = F.pmod(F.xxhash64("user_id", F.lit(f"signal {strength}")), F.lit(1_000_003)) / 1_000_003.0
    return numbers.withColumn("churned", (draw < 1 / (1 + F.exp(-strength * odds))).cast("int"))


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    depths = [int(d) for d in sys.argv[2:]] or DEPTHS
    spark = local_session("forest-depth")
    m = Model(spark, folder)
    features = churn_model.training_table(churn_features.build_churn_features(m.orders, m.items, m.users))
    print("signal  depth  roc_auc  seconds")
    for strength in SIGNALS:
        labelled = churn_model.training_table(with_signal(features, strength))
        train, test = (part.persist() for part in churn_model.stratified_split(labelled))
        train.count(), test.count()
        for depth in depths:
            start = time.perf_counter()
            model = churn_model.fit_forest(train, CHURN_FEATURES, depth=depth)
            took = time.perf_counter() - start
            area = churn_model.evaluate(model, test)["roc_auc"]
            print(f"{strength:6.1f} {depth:6d} {area:8.4f} {took:8.1f}", flush=True)


if __name__ == "__main__":
    main()
