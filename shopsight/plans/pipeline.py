"""The full run: raw tables in, nine contract-checked outputs out.

    python -m shopsight.plans.pipeline RAW_DIR OUTPUT_DIR [MODEL_PATH]
    python -m shopsight.plans.pipeline --rebuild OUTPUT_DIR
"""

from __future__ import annotations

import argparse
import logging
import uuid
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from shopsight.operators import assortment, churn_features, churn_model, kpis, quality, recommend
from shopsight.operators.cleaning import audit_table, clean_all, store_cleaned
from shopsight.operators.customers import clv_table
from shopsight.operators.purchases import stored_facts
from shopsight.plans import customers
from shopsight.session import tune
from shopsight.sources import catalog, outputs, paths, tables
from shopsight.sources.concurrent import run_all
from shopsight.sources.scratch import materialize, run_folder

logger = logging.getLogger(__name__)

# Cleaned tables that several stages read.
STORED = ["users", "orders", "order_items", "products"]
MODEL = "churn_model"
TABLES = "tables"


class ValidationFailed(ValueError):
    """The raw tables failed a check; `report` has the check rows."""

    def __init__(self, report: DataFrame):
        super().__init__("Data validation failed; nothing was written.")
        self.report = report


class PipelineResult(NamedTuple):
    """Status rows of the published set, the fitted churn models, and the audit of the stored cleaned tables."""

    status: DataFrame
    models: churn_model.ChurnModels
    audit: DataFrame


def staged(spark: SparkSession, raw_dir: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Raw tables; CSV, which would be parsed anew by every check, is stored as Parquet, and its records counted."""
    raw = tables.load_all_tables(spark, raw_dir)
    csv = [t for t in raw if tables.detect_format(spark, t, raw_dir) == "csv"]
    stored = run_all(spark, {t: lambda t=t: tables.stored_csv(spark, paths.join(raw_dir, f"{t}.csv"), t) for t in csv})
    return raw | {t: df for t, (df, _) in stored.items()}, {t: counts for t, (_, counts) in stored.items()}


def clean_tables(raw: dict[str, DataFrame], folder: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Cleaned tables, those with several readers stored as Parquet in `folder`, and what their cleaning dropped."""
    clean = clean_all({t: df for t, df in raw.items() if t not in STORED})
    spark = next(iter(raw.values())).sparkSession

    def write(table: str, df: DataFrame) -> DataFrame:
        path = paths.join(folder, f"{table}.parquet")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    jobs = {t: lambda t=t: store_cleaned(t, raw[t], lambda df: write(t, df)) for t in STORED}
    done = run_all(spark, jobs)
    return clean | {t: df for t, (df, _) in done.items()}, audit_table({t: row for t, (_, row) in done.items()}, spark)


def validate(raw: dict[str, DataFrame], records: dict[str, DataFrame] | None = None) -> DataFrame:
    """The stored check rows; raises when one of them fails validation."""
    report = materialize(quality.quality_report(raw, records=records), "quality")
    if not quality.passed(report):
        raise ValidationFailed(report)
    return report


def compute_outputs(
    clean: dict[str, DataFrame],
    staging: outputs.Staging,
    trees: int = 200,
    depth: int = churn_model.FOREST_DEPTH,
    max_bins: int = churn_model.FOREST_BINS,
) -> churn_model.ChurnModels:
    """Stage all outputs; independent ones side by side. Returns the fitted models."""
    users, orders = clean["users"], clean["orders"]
    items, products = clean["order_items"], clean["products"]
    spark = orders.sparkSession
    facts = stored_facts(orders, items)

    def customer_outputs() -> None:
        activity = customers.stored_activity(orders, items, facts=facts)
        rfm = staging.write("customer_rfm", customers.segmented(activity))

        def profile_outputs() -> None:
            profile = staging.write("customer_segments", customers.full_profile(activity, users, rfm))
            staging.write("clv", clv_table(profile))

        def recommendations() -> None:
            staging.write("recommendations", recommend.build_recommendations(items, products, rfm))

        run_all(spark, {"profile": profile_outputs, "recommendations": recommendations})

    def churn_outputs() -> churn_model.ChurnModels:
        features = churn_model.training_table(churn_features.build_churn_features(orders, items, users, facts=facts))
        trained = churn_model.train_churn_models(features, trees=trees, depth=depth, max_bins=max_bins)
        importance = churn_model.feature_importance(trained.models[churn_model.FOREST], features)
        staging.write("churn_predictions", churn_model.generate_churn_predictions(features, trained.best))
        staging.write("churn_feature_importance", importance)
        return trained

    done = run_all(
        spark,
        {
            "churn": churn_outputs,
            "customers": customer_outputs,
            "kpis": lambda: staging.write("monthly_kpis", kpis.compute_monthly_kpis(orders, items, facts)),
            "cohorts": lambda: staging.write("cohort_retention", kpis.compute_cohort_retention(orders)),
            "categories": lambda: staging.write(
                "category_analytics", assortment.compute_category_analytics(items, products)
            ),
        },
    )
    return done["churn"]


def run(
    spark: SparkSession,
    raw_dir: str,
    output_dir: str,
    model_path: str | None = None,
    trees: int = 200,
    depth: int = churn_model.FOREST_DEPTH,
    max_bins: int = churn_model.FOREST_BINS,
) -> PipelineResult:
    """Load, validate, clean, compute, publish. Nothing is left on failure.

    The cleaned tables that others need are part of the published set (`tables`), so that later sessions can open
    them. The model is part of the published set, by default as `churn_model` beside the outputs.
    `trees`, `depth` (30 at most) and `max_bins` are those of the churn forest.
    """
    tune(spark)
    logger.info("Loading and validating %s", raw_dir)
    raw, records = staged(spark, raw_dir)
    logger.info("Cleaning beside validation")
    folder = f"{output_dir.rstrip('/')}.tables-{uuid.uuid4().hex}"
    try:
        checked = run_all(spark, {"report": lambda: validate(raw, records), "clean": lambda: clean_tables(raw, folder)})
    except BaseException:
        paths.delete(spark, folder)
        raise
    clean, audit = checked["clean"]
    logger.info("Computing outputs")
    with run_folder(spark), outputs.Staging(spark, output_dir) as staging:
        staging.attach(paths.join(output_dir, TABLES), folder)
        models = compute_outputs(clean, staging, trees, depth, max_bins)
        churn_model.save_model(models.best, staging.attach(model_path or paths.join(output_dir, MODEL)))
        status = staging.publish()
    catalog.register({t: df for t, df in clean.items() if t not in STORED})
    open_tables(spark, output_dir)
    logger.info("Published %d outputs to %s", len(staging.contracts), output_dir)
    return PipelineResult(status, models, audit)


def open_tables(spark: SparkSession, output_dir: str) -> list[str]:
    """Register the cleaned tables that belong to the published outputs, in any later session."""
    return catalog.open_tables(spark, outputs.located(spark, paths.join(output_dir, TABLES), output_dir))


def load_published_model(spark: SparkSession, output_dir: str, model_path: str | None = None) -> PipelineModel:
    """The model that belongs to the published outputs."""
    target = model_path or paths.join(output_dir, MODEL)
    return churn_model.load_model(outputs.located(spark, target, output_dir))


def regenerate_sql_outputs(spark: SparkSession, output_dir: str) -> dict[str, Exception]:
    """Rebuild the outputs that are plain SQL over the registered tables."""
    return outputs.regenerate(
        {
            "monthly_kpis": lambda: catalog.run_sql_file(spark, "monthly_kpis"),
            "category_analytics": lambda: catalog.run_sql_file(spark, "category_analytics"),
        },
        output_dir,
    )


def rebuild(spark: SparkSession, output_dir: str) -> dict[str, Exception]:
    """In a session of its own: open the published tables and rebuild the SQL outputs from them."""
    session = tune(spark.newSession())
    outputs.finish(session, output_dir)
    open_tables(session, output_dir)
    return regenerate_sql_outputs(session, output_dir)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("raw_dir", nargs="?")
    parser.add_argument("output_dir")
    parser.add_argument("model_path", nargs="?")
    parser.add_argument("--rebuild", action="store_true", help="only rebuild the SQL outputs from the published tables")
    args = parser.parse_args()
    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName("shopsight").getOrCreate()
    if args.rebuild:
        failures = rebuild(spark, args.output_dir)
        for name, error in failures.items():
            logger.error("Could not rebuild %s: %s", name, error)
        raise SystemExit(1 if failures else 0)
    if args.raw_dir is None:
        parser.error("a raw folder and an output folder are needed")
    run(spark, args.raw_dir, args.output_dir, args.model_path).status.show(truncate=False)


if __name__ == "__main__":
    main()
