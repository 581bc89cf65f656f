"""Supplementary K-means clusters on standardized RFM features."""

from __future__ import annotations

from itertools import chain

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsight.contracts import CLUSTER_LABELS, KMEANS_CLUSTERS, KMEANS_RESTARTS, SEED
from shopsight.operators.churn_model import without_summary
from shopsight.operators.rfm import METRICS
from shopsight.sources.concurrent import run_all


def cluster_labels(centers: list[list[float]]) -> dict[int, str]:
    """Name the clusters by value: low recency, high frequency, high spend."""
    top_spend = max(c[2] for c in centers) or 1.0
    value = {i: -r + f + m / top_spend for i, (r, f, m) in enumerate(centers)}
    best_first = sorted(value, key=lambda i: (-value[i], i))
    names = CLUSTER_LABELS[: len(centers)]
    names += [f"Cluster {i}" for i in range(len(names), len(centers))]
    return dict(zip(best_first, names))


def run_kmeans_clustering(
    scored: DataFrame,
    n_clusters: int = KMEANS_CLUSTERS,
    seed: int = SEED,
    restarts: int = KMEANS_RESTARTS,
) -> DataFrame:
    """`scored` plus cluster and cluster_label; the best of several restarts."""
    numeric = scored.select(
        "*", *[F.coalesce(F.col(m).cast("double"), F.lit(0.0)).alias(f"_{m}") for m in METRICS]
    )
    scale = Pipeline(
        stages=[
            VectorAssembler(inputCols=[f"_{m}" for m in METRICS], outputCol="_raw"),
            StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True),
        ]
    ).fit(numeric)
    points = scale.transform(numeric).select("_scaled").persist()

    def fit(start: int) -> tuple[float, KMeansModel]:
        model = KMeans(k=n_clusters, seed=seed + start, featuresCol="_scaled", predictionCol="cluster").fit(points)
        return model.summary.trainingCost, model

    try:
        fits = run_all(scored.sparkSession, {str(i): lambda i=i: fit(i) for i in range(restarts)})
    finally:
        points.unpersist()
    _, best = min(fits.values(), key=lambda found: found[0])
    best = without_summary(best)

    scaler = scale.stages[1]
    centers = [
        [c * s + m for c, s, m in zip(center, scaler.std, scaler.mean)] for center in best.clusterCenters()
    ]
    naming = F.create_map(*chain.from_iterable((F.lit(i), F.lit(n)) for i, n in cluster_labels(centers).items()))
    clustered = best.transform(scale.transform(numeric))
    return clustered.select(*scored.columns, "cluster", naming[F.col("cluster")].alias("cluster_label"))
