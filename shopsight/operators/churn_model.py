"""Churn models on Spark ML: split, fit, evaluate, store, score."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsight.contracts import (
    CHURN_FEATURES,
    HIGH_RISK_FROM,
    LOW_RISK_BELOW,
    MIN_CUSTOMERS_PER_CLASS,
    MIN_TRAINING_CUSTOMERS,
    RISK_LEVELS,
    SEED,
    TEST_SHARE,
)
from shopsight.operators import ranking
from shopsight.sources.concurrent import run_all
from shopsight.sources.scratch import materialize

LOGISTIC = "Logistic Regression"
FOREST = "Random Forest"
# Depth beyond which measured ROC-AUC only falls (`checks.forest_depth`); at most 30. The usual number of bins.
FOREST_DEPTH = 10
FOREST_BINS = 32
METRIC_NAMES = ["accuracy", "precision", "recall", "f1", "roc_auc"]


@dataclass
class ChurnModels:
    """Fitted pipelines (assembler, scaler, classifier) with their test metrics."""

    models: dict[str, PipelineModel]
    metrics: dict[str, dict[str, float]]
    feature_columns: list[str]

    @property
    def best_name(self) -> str:
        """Highest ROC-AUC; the first model, logistic regression, wins a tie."""
        return max(self.metrics, key=lambda name: self.metrics[name]["roc_auc"])

    @property
    def best(self) -> PipelineModel:
        return self.models[self.best_name]


def training_table(features: DataFrame) -> DataFrame:
    """The features stored once, spread over all cores and in a fixed order."""
    return materialize(features, "churn-features", spread_by="user_id")


def split_key(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("user_id"))


def stratified_split(
    features: DataFrame, test_share: float = TEST_SHARE, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """(train, test): of each class the share with the lowest id hashes.

    Exact class counts and independent of partitioning. The class-wise hash
    cut-offs come from distributed positions, so no class passes through one
    task. A class too small to give a test row stays in training.
    """
    keyed = features.withColumn("_key", split_key(seed))
    stacked = keyed.select(
        F.when(F.col("churned") == 1, "churned").otherwise("active").alias(ranking.SERIES),
        F.col("_key").alias(ranking.VALUE),
    )
    test_rows = F.floor(F.col(ranking.TOTAL) * F.lit(test_share) + F.lit(0.5))
    in_train = (F.col(ranking.BEFORE) >= test_rows).cast("int")
    first_train = ranking.level_cutoffs(stacked, in_train, ["churned", "active"], range(1, 2))
    marked = keyed.withColumn("_first", first_train).withColumn(
        "_test",
        F.col("_key")
        < F.when(F.col("churned") == 1, F.col("_first.churned_1")).otherwise(F.col("_first.active_1")),
    )
    plain = marked.drop("_key", "_first")
    return plain.filter(~F.col("_test")).drop("_test"), plain.filter("_test").drop("_test")


def check_training_data(features: DataFrame) -> tuple[int, int]:
    """(churned, active) counts; raises when they are too few to train on."""
    row = features.agg(F.count_if(F.col("churned") == 1), F.count_if(F.col("churned") == 0)).first()
    churned, active = row[0], row[1]
    if churned + active < MIN_TRAINING_CUSTOMERS:
        raise ValueError(
            f"Insufficient data for churn modelling: {churned + active} customers, "
            f"at least {MIN_TRAINING_CUSTOMERS} needed."
        )
    if min(churned, active) < MIN_CUSTOMERS_PER_CLASS:
        raise ValueError(
            f"Insufficient class representation for churn modelling: {churned} churned, {active} active, "
            f"at least {MIN_CUSTOMERS_PER_CLASS} of each needed."
        )
    return churned, active


def prepared(features: DataFrame, columns: list[str]) -> DataFrame:
    """Model inputs as doubles without NULLs."""
    inputs = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns]
    others = [c for c in features.columns if c not in columns]
    return features.select(*others, *inputs)


def stored_part(part: DataFrame, columns: list[str]) -> DataFrame:
    """Model inputs of one part of a split, stored: every pass of a fit would settle the split anew."""
    return materialize(prepared(part, columns).select("user_id", "churned", *columns), "churn-part")


def dealt_evenly(train: DataFrame) -> DataFrame:
    """At most as many parts as cores: each sends the statistics of all nodes of all trees at every level."""
    return train.coalesce(train.sparkSession.sparkContext.defaultParallelism)


def balanced_weight(train: DataFrame) -> Column:
    """Weight that gives both classes the same total."""
    row = train.agg(F.count_if(F.col("churned") == 1), F.count_if(F.col("churned") == 0)).first()
    churned, active = row[0], row[1]
    total = churned + active
    return F.when(F.col("churned") == 1, total / (2.0 * max(churned, 1))).otherwise(total / (2.0 * max(active, 1)))


def without_summary(model: Model) -> Model:
    """The fitted model without its training summary, which would take the session along to every task.

    Tasks that score with the model cannot be sent once the session observes counts (`cleaning.Counts`).
    """
    for stage in getattr(model, "stages", [model]):
        if getattr(stage, "hasSummary", False):
            stage._call_java("setSummary", SparkSession.active()._jvm.scala.Option.empty())
    return model


def fit(columns: list[str], classifier, train: DataFrame) -> PipelineModel:
    stages = [
        VectorAssembler(inputCols=columns, outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
        classifier,
    ]
    return without_summary(Pipeline(stages=stages).fit(train))


def fit_logistic(train: DataFrame, columns: list[str]) -> PipelineModel:
    """L2-regularized logistic regression with C = 1, balanced classes."""
    weighted = train.withColumn("weight", balanced_weight(train))
    return fit(
        columns,
        LogisticRegression(
            labelCol="churned",
            weightCol="weight",
            regParam=1.0 / max(train.count(), 1),
            elasticNetParam=0.0,
            standardization=False,
            maxIter=1000,
        ),
        weighted,
    )


def fit_forest(
    train: DataFrame, columns: list[str], trees: int = 200, depth: int = FOREST_DEPTH, max_bins: int = FOREST_BINS
) -> PipelineModel:
    """Random forest of balanced classes; `depth` at most 30, `max_bins` split candidates per feature."""
    weighted = dealt_evenly(train).withColumn("weight", balanced_weight(train))
    return fit(
        columns,
        RandomForestClassifier(
            labelCol="churned",
            weightCol="weight",
            numTrees=trees,
            maxDepth=depth,
            maxBins=max_bins,
            featureSubsetStrategy="sqrt",
            maxMemoryInMB=1024,
            cacheNodeIds=True,
            seed=SEED,
        ),
        weighted,
    )


def confusion(scored: DataFrame) -> dict[str, int]:
    actual, predicted = F.col("churned") == 1, F.col("prediction") == 1
    row = scored.agg(
        F.count_if(actual & predicted).alias("true_positive"),
        F.count_if(~actual & predicted).alias("false_positive"),
        F.count_if(actual & ~predicted).alias("false_negative"),
        F.count_if(~actual & ~predicted).alias("true_negative"),
    ).first()
    return row.asDict()


def _share(part: float, whole: float) -> float:
    return part / whole if whole else 0.0


def evaluate(model: PipelineModel, test: DataFrame) -> dict[str, float]:
    """Accuracy, precision, recall, F1, ROC-AUC and the confusion counts."""
    scored = model.transform(test).select("churned", "prediction", "rawPrediction").persist()
    try:
        counts = confusion(scored)
        area = BinaryClassificationEvaluator(
            labelCol="churned", rawPredictionCol="rawPrediction", metricName="areaUnderROC", numBins=0
        ).evaluate(scored)
    finally:
        scored.unpersist()
    hits = counts["true_positive"]
    precision = _share(hits, hits + counts["false_positive"])
    recall = _share(hits, hits + counts["false_negative"])
    return {
        "accuracy": _share(hits + counts["true_negative"], sum(counts.values())),
        "precision": precision,
        "recall": recall,
        "f1": _share(2 * precision * recall, precision + recall),
        "roc_auc": area,
        **counts,
    }


def train_churn_models(
    features: DataFrame,
    columns: list[str] = CHURN_FEATURES,
    trees: int = 200,
    depth: int = FOREST_DEPTH,
    max_bins: int = FOREST_BINS,
) -> ChurnModels:
    """Fit both models on the training part and evaluate on the rest.

    `trees`, `depth` and `max_bins` are those of the forest. `features` is read by every stage: pass a `training_table`.
    """
    check_training_data(features)
    available = [c for c in columns if c in features.columns]
    train, test = (stored_part(part, available) for part in stratified_split(features))
    fits = {
        LOGISTIC: lambda: fit_logistic(train, available),
        FOREST: lambda: fit_forest(train, available, trees, depth, max_bins),
    }

    def fit_and_evaluate(name: str) -> tuple[PipelineModel, dict[str, float]]:
        model = fits[name]()
        return model, evaluate(model, test)

    done = run_all(features.sparkSession, {name: lambda n=name: fit_and_evaluate(n) for name in fits})
    models = {name: model for name, (model, _) in done.items()}
    metrics = {name: measured for name, (_, measured) in done.items()}
    return ChurnModels(models, metrics, available)


def metrics_table(trained: ChurnModels, like: DataFrame) -> DataFrame:
    fields = [*METRIC_NAMES, "true_positive", "false_positive", "false_negative", "true_negative"]
    rows = [
        (name, name == trained.best_name, *[float(m[f]) for f in METRIC_NAMES], *[int(m[f]) for f in fields[5:]])
        for name, m in trained.metrics.items()
    ]
    schema = "model string, best boolean, " + ", ".join(
        f"{f} {'double' if f in METRIC_NAMES else 'bigint'}" for f in fields
    )
    return like.sparkSession.createDataFrame(rows, schema)


def input_columns(model: PipelineModel) -> list[str]:
    """The ordered feature list, as stored in the model."""
    return model.stages[0].getInputCols()


def feature_importance(forest: PipelineModel, like: DataFrame) -> DataFrame:
    importances = [float(v) for v in forest.stages[-1].featureImportances.toArray()]
    rows = list(zip(input_columns(forest), importances))
    return like.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def risk_level(probability: Column) -> Column:
    low, medium, high = RISK_LEVELS
    return F.when(probability < LOW_RISK_BELOW, low).when(probability < HIGH_RISK_FROM, medium).otherwise(high)


def generate_churn_predictions(features: DataFrame, model: PipelineModel) -> DataFrame:
    """Score every customer, those the model was trained on included.

    The risk level uses the unrounded probability.
    """
    scored = model.transform(prepared(features, input_columns(model)))
    probability = F.col("_probability")
    return scored.select("user_id", "prediction", vector_to_array("probability")[1].alias("_probability")).select(
        F.col("user_id").alias("customer_id"),
        F.round(probability, 4).alias("churn_probability"),
        F.col("prediction").cast("bigint").alias("churn_prediction"),
        risk_level(probability).alias("risk_level"),
    )


def risk_counts(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("risk_level").agg(F.count("*").alias("customers")).orderBy(
        F.desc("customers"), "risk_level"
    )
