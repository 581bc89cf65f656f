"""One query per operator, over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.adapter import Model
from shopsight.contracts import CLUSTER_LABELS, OUTPUTS
from shopsight.operators import (
    assortment,
    churn_features,
    churn_model,
    cleaning,
    clusters,
    customers,
    kpis,
    purchases,
    quality,
    ranking,
    recommend,
    reports,
    rfm,
)
from shopsight.plans import customers as customer_plan
from shopsight.plans import pipeline
from shopsight.sources import catalog, outputs, paths, tables
from shopsight.sources.scratch import materialize, new_path

Query = Callable[[Model], DataFrame]
QUERIES: dict[str, Query] = {}

# Five products per segment leave customers short of recommendations, so that the
# backfill from the overall pool is reached; the default pools are large enough.
SMALL_SEGMENT_POOL = 5
OVERALL_POOL = 50
SAMPLE_FILTER = dict(
    segments=["Champions", "Loyal Customers", "At Risk", "Hibernating"],
    genders=["M"],
    recency=(0.0, 900.0),
    frequency=(2, 12),
    monetary=(1000.0, 2_000_000.0),
)


def query(function: Query, name: str | None = None) -> Query:
    QUERIES[name or function.__name__] = function
    return function


def _stored_raw(m: Model, csv: tuple[str, ...] = ()) -> str:
    """The model tables as a raw folder, the named ones as CSV."""
    folder = new_path(m.spark, "raw")
    for name, df in m.tables.items():
        if name in csv:
            df.write.option("header", True).csv(paths.join(folder, f"{name}.csv"))
        else:
            df.write.parquet(paths.join(folder, f"{name}.parquet"))
    return folder


# --- sources, sinks, catalog ------------------------------------------------


@query
def src_parquet_scan(m: Model) -> DataFrame:
    folder = new_path(m.spark, "raw")
    m.products.write.parquet(paths.join(folder, "products.parquet"))
    return tables.load_table(m.spark, "products", folder)


@query
def src_csv_scan(m: Model) -> DataFrame:
    folder = new_path(m.spark, "raw")
    m.orders.write.option("header", True).csv(paths.join(folder, "orders.csv"))
    return cleaning.clean_orders(tables.load_table(m.spark, "orders", folder)).select(
        "order_id", "user_id", "status", "created_at"
    )


@query
def src_malformed_records(m: Model) -> DataFrame:
    """Orders as text, every 50th without its last field and every 70th with one too many."""
    folder = new_path(m.spark, "raw")
    key = F.col("order_id").cast("string")
    fields = F.when(F.col("order_id") % 50 == 0, key).when(F.col("order_id") % 70 == 0, F.concat(key, F.lit(",x,y")))
    lines = m.orders.select(F.coalesce(fields, F.concat(key, F.lit(",complete"))).alias("order_id,status"))
    lines.write.option("header", True).option("quote", "").csv(paths.join(folder, "orders.csv"))
    _, counts = tables.stored_csv(m.spark, paths.join(folder, "orders.csv"), "orders")
    return quality.finish(quality.record_checks({"orders": counts}))


@query
def src_load_all(m: Model) -> DataFrame:
    loaded = tables.load_all_tables(m.spark, _stored_raw(m, csv=("users", "events")))
    return quality.row_counts(loaded).select("table_name", "row_count")


@query
def src_input_inventory(m: Model) -> DataFrame:
    return tables.input_inventory(m.spark, _stored_raw(m, csv=("users", "events")))


@query
def cat_register(m: Model) -> DataFrame:
    catalog.register(m.tables)
    return catalog.run_query(
        m.spark,
        "SELECT status, COUNT(*) AS orders FROM orders WHERE created_at >= :since GROUP BY status",
        {"since": "1998-01-01"},
    )


@query
def cat_row_counts(m: Model) -> DataFrame:
    return catalog.row_counts(m.spark, catalog.register(m.tables))


@query
def sink_parquet_roundtrip(m: Model) -> DataFrame:
    path = new_path(m.spark, "out")
    outputs.save_parquet(m.users, path)
    outputs.save_parquet(m.users, path)  # replaces the first
    return outputs.load_parquet(m.spark, path)


@query
def sink_publish(m: Model) -> DataFrame:
    # Stored, as the full run stores the cleaned tables that several stages read: the items are a join.
    items = materialize(m.items, "order-items")
    clean = {"users": m.users, "orders": m.orders, "order_items": items, "products": m.products}
    with outputs.Staging(m.spark, new_path(m.spark, "published")) as staging:
        pipeline.compute_outputs(clean, staging)
        return staging.publish()


@query
def sink_contract_status(m: Model) -> DataFrame:
    """A folder with two good outputs, one of the wrong type, one empty, the rest missing."""
    folder = new_path(m.spark, "outputs")
    monthly = kpis.compute_monthly_kpis(m.orders, m.bare_items)
    categories = assortment.compute_category_analytics(m.items, m.products)
    stored = {
        "monthly_kpis": monthly,
        "category_analytics": categories,
        "customer_rfm": m.segmented.withColumn("recency", F.col("recency").cast("string")),
        "clv": customers.clv_table(m.profile).filter(F.lit(False)),
    }
    for name, df in stored.items():
        outputs.save_parquet(df, paths.join(folder, OUTPUTS[name].path))
    return outputs.validate_outputs(m.spark, folder)


@query
def sink_regenerate(m: Model) -> DataFrame:
    catalog.register(m.tables)
    folder = new_path(m.spark, "outputs")
    failures = pipeline.regenerate_sql_outputs(m.spark, folder)
    if failures:
        raise RuntimeError(failures)
    status = outputs.validate_outputs(m.spark, folder)
    return status.filter(F.col("status") != "missing")


@query
def sink_rebuild_later(m: Model) -> DataFrame:
    """Tables stored with an output set, opened by another session, which rebuilds the SQL outputs."""
    folder = new_path(m.spark, "rebuilt")
    for name, df in (("orders", m.orders), ("order_items", m.items), ("products", m.products)):
        outputs.save_parquet(df, paths.join(folder, pipeline.TABLES, f"{name}.parquet"))
    failures = pipeline.rebuild(m.spark, folder)
    if failures:
        raise RuntimeError(failures)
    return outputs.load_parquet(m.spark, paths.join(folder, OUTPUTS["monthly_kpis"].path))


@query
def sink_csv_export(m: Model) -> DataFrame:
    path = new_path(m.spark, "export")
    base = reports.segment_base(m.profile, m.segmented)
    outputs.export_csv(reports.filter_customers(base, **SAMPLE_FILTER), path, reports.DETAIL_COLUMNS)
    back = tables.read_csv(m.spark, path)
    return back.select(
        F.col("customer_id").cast("bigint").alias("customer_id"),
        "first_name", "last_name", "segment",
        F.col("monetary").cast("double").alias("monetary"),
        F.col("rfm_score").cast("bigint").alias("rfm_score"),
        "country", "gender",
    )


# --- data quality -----------------------------------------------------------


@query
def dq_report(m: Model) -> DataFrame:
    return quality.quality_report(m.dirty)


def _narrowed(m: Model) -> dict[str, DataFrame]:
    return m.dirty | {"users": m.dirty["users"].drop("email"), "products": m.dirty["products"].drop("brand", "cost")}


@query
def dq_missing_tables(m: Model) -> DataFrame:
    """The report of a set that lacks two tables: these are issues, references to them are not checked."""
    present = {t: df for t, df in m.dirty.items() if t not in ("events", "inventory_items")}
    checks = quality.all_checks(present)
    return quality.finish(checks.filter(F.col("check_name").isin("missing_table", "empty_table", "orphan_key")))


@query
def dq_required_columns(m: Model) -> DataFrame:
    return quality.required_columns(_narrowed(m))


@query
def dq_row_counts(m: Model) -> DataFrame:
    return quality.row_counts(m.dirty)


@query
def dq_duplicate_keys(m: Model) -> DataFrame:
    return quality.only(quality.table_checks(m.dirty), "duplicate_key")


@query
def dq_conflicting_keys(m: Model) -> DataFrame:
    return quality.only(quality.table_checks(m.dirty), "conflicting_key")


def _column_report(m: Model, check: str) -> DataFrame:
    return quality.only(quality.table_checks(m.dirty), check)


@query
def dq_null_rates(m: Model) -> DataFrame:
    return _column_report(m, "null_key")


@query
def dq_bad_dates(m: Model) -> DataFrame:
    return _column_report(m, "bad_date")


@query
def dq_negative_values(m: Model) -> DataFrame:
    return _column_report(m, "negative_value")


@query
def dq_orphan_keys(m: Model) -> DataFrame:
    return quality.finish(quality.orphans(m.dirty))


@query
def dq_owner_mismatch(m: Model) -> DataFrame:
    return quality.finish(quality.owner_mismatch(m.dirty["order_items"], m.dirty["orders"]))


@query
def dq_summary(m: Model) -> DataFrame:
    return quality.summary(m.dirty)


# --- cleaning ---------------------------------------------------------------


@query
def clean_users(m: Model) -> DataFrame:
    return cleaning.clean_users(m.dirty["users"])


@query
def clean_orders(m: Model) -> DataFrame:
    return cleaning.clean_orders(m.dirty["orders"])


@query
def clean_order_items(m: Model) -> DataFrame:
    return cleaning.clean_order_items(m.dirty["order_items"])


@query
def clean_products(m: Model) -> DataFrame:
    return cleaning.clean_products(m.dirty["products"])


@query
def clean_events(m: Model) -> DataFrame:
    return cleaning.clean_events(m.dirty["events"])


@query
def clean_inventory(m: Model) -> DataFrame:
    return cleaning.clean_inventory_items(m.dirty["inventory_items"])


@query
def clean_centers(m: Model) -> DataFrame:
    return cleaning.clean_centers(m.dirty["distribution_centers"])


@query
def clean_dedupe_first(m: Model) -> DataFrame:
    items = m.items.select("order_id", "id", "product_id", "sale_price")
    return ranking.first_per_key(items, "order_id", ["sale_price", "product_id", "id"])


@query
def clean_audit(m: Model) -> DataFrame:
    return cleaning.cleaning_audit(m.dirty)


# --- customers, RFM, lifetime value -----------------------------------------


@query
def feat_completed_items(m: Model) -> DataFrame:
    return purchases.completed_items(m.orders, m.bare_items).select("order_id", "user_id", "product_id", "sale_price")


@query
def rfm_features(m: Model) -> DataFrame:
    return rfm.build_rfm_features(m.orders, m.bare_items)


@query
def sql_rfm(m: Model) -> DataFrame:
    catalog.register({"orders": m.orders, "order_items": m.bare_items})
    return catalog.run_sql_file(m.spark, "rfm")


@query
def rfm_avg_rank(m: Model) -> DataFrame:
    return rfm.average_ranks(m.rfm).select("customer_id", "recency_rank", "frequency_rank", "monetary_rank")


@query
def rfm_scores(m: Model) -> DataFrame:
    return rfm.compute_rfm_scores(m.rfm)


@query
def rfm_segments(m: Model) -> DataFrame:
    return rfm.assign_segments(rfm.compute_rfm_scores(m.rfm))


@query
def segment_counts(m: Model) -> DataFrame:
    return rfm.segment_counts(rfm.assign_segments(rfm.compute_rfm_scores(m.rfm)))


@query
def customer_aggregates(m: Model) -> DataFrame:
    return customers.build_customer_aggregates(m.orders, m.bare_items, m.users)


@query
def customer_clv(m: Model) -> DataFrame:
    statistics = customers.purchase_statistics(m.activity, customer_plan.latest_order(m.activity))
    return customers.estimate_clv(statistics)


@query
def customer_full(m: Model) -> DataFrame:
    return customer_plan.full_profile(m.activity, m.users)


@query
def clv_output(m: Model) -> DataFrame:
    return customers.clv_table(customer_plan.full_profile(m.activity, m.users))


@query
def customer_kmeans(m: Model) -> DataFrame:
    return clusters.run_kmeans_clustering(m.segmented)


# --- churn ------------------------------------------------------------------


@query
def churn_windows(m: Model) -> DataFrame:
    """Completed orders in history and label window."""
    window = churn_features.churn_window(m.orders)
    at = F.unix_micros("created_at")
    period = F.when(at < window.cutoff, "history").when(at <= window.end, "label")
    return (
        purchases.completed(m.orders)
        .groupBy(period.alias("period"))
        .agg(
            F.count("*").alias("orders"),
            F.count_distinct("user_id").alias("customers"),
            F.min("created_at").alias("first_order"),
            F.max("created_at").alias("last_order"),
        )
    )


def _features(m: Model) -> DataFrame:
    return churn_features.build_churn_features(m.orders, m.bare_items, m.users)


def _stored_features(m: Model) -> DataFrame:
    return churn_model.training_table(_features(m))


query(_features, "churn_features")


@query
def churn_rate(m: Model) -> DataFrame:
    return churn_features.churn_rate(_features(m))


@query
def churn_split_counts(m: Model) -> DataFrame:
    train, test = churn_model.stratified_split(_stored_features(m))
    parts = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return parts.groupBy("part", F.col("churned").cast("bigint").alias("churned")).agg(F.count("*").alias("customers"))


def _train_part(m: Model) -> tuple[DataFrame, DataFrame]:
    features = _stored_features(m)
    train, _ = churn_model.stratified_split(features)
    return features, churn_model.stored_part(train, churn_model.CHURN_FEATURES)


@query
def churn_train_lr(m: Model) -> DataFrame:
    features, train = _train_part(m)
    return churn_model.generate_churn_predictions(features, churn_model.fit_logistic(train, churn_model.CHURN_FEATURES))


@query
def churn_train_rf(m: Model) -> DataFrame:
    features, train = _train_part(m)
    return churn_model.generate_churn_predictions(features, churn_model.fit_forest(train, churn_model.CHURN_FEATURES))


@query
def churn_metrics(m: Model) -> DataFrame:
    features = _stored_features(m)
    return churn_model.metrics_table(churn_model.train_churn_models(features), features)


@query
def churn_feature_importance(m: Model) -> DataFrame:
    features, train = _train_part(m)
    return churn_model.feature_importance(churn_model.fit_forest(train, churn_model.CHURN_FEATURES), features)


@query
def churn_model_roundtrip(m: Model) -> DataFrame:
    features, train = _train_part(m)
    path = new_path(m.spark, "model")
    churn_model.save_model(churn_model.fit_logistic(train, churn_model.CHURN_FEATURES), path)
    return churn_model.generate_churn_predictions(features, churn_model.load_model(path))


@query
def churn_predictions(m: Model) -> DataFrame:
    features = _stored_features(m)
    return churn_model.generate_churn_predictions(features, churn_model.train_churn_models(features).best)


# Facts that hold for any fitted model, so that SQL can state them.


def _prediction_facts(predictions: DataFrame) -> DataFrame:
    """Per customer; probabilities are rounded to four digits, so a limit may be met from either side."""
    p = F.col("churn_probability")

    def fits(limit: float, above: Column) -> Column:
        return (F.abs(p - limit) < 0.0001) | ((p > limit) == above)

    level = F.col("risk_level")
    return predictions.select(
        "customer_id",
        p.between(0, 1).alias("probability_in_range"),
        fits(0.5, F.col("churn_prediction") == 1).alias("prediction_fits"),
        (fits(0.3, level != "Low Risk") & fits(0.6, level == "High Risk")).alias("level_fits"),
    )


@query
def churn_train_lr_facts(m: Model) -> DataFrame:
    return _prediction_facts(churn_train_lr(m))


@query
def churn_train_rf_facts(m: Model) -> DataFrame:
    return _prediction_facts(churn_train_rf(m))


@query
def churn_predictions_facts(m: Model) -> DataFrame:
    return _prediction_facts(churn_predictions(m))


@query
def churn_model_roundtrip_facts(m: Model) -> DataFrame:
    return _prediction_facts(churn_model_roundtrip(m))


@query
def churn_reload_differences(m: Model) -> DataFrame:
    """Customers whose prediction changes when the model is saved and loaded."""
    features, train = _train_part(m)
    path = new_path(m.spark, "model")
    model = churn_model.fit_logistic(train, churn_model.CHURN_FEATURES)
    churn_model.save_model(model, path)
    before = churn_model.generate_churn_predictions(features, model)
    after = churn_model.generate_churn_predictions(features, churn_model.load_model(path))
    rows = before.withColumn("side", F.lit(1)).unionByName(after.withColumn("side", F.lit(2)))
    per_customer = rows.groupBy("customer_id").agg(
        F.count_distinct("churn_probability", "churn_prediction", "risk_level").alias("versions")
    )
    return per_customer.agg(F.count_if(F.col("versions") > 1).alias("different"), F.count("*").alias("customers"))


@query
def churn_metrics_facts(m: Model) -> DataFrame:
    hit, false = F.col("true_positive"), F.col("false_positive")
    missed, passed = F.col("false_negative"), F.col("true_negative")

    def near(left: Column, right: Column) -> Column:
        return F.abs(left - F.coalesce(right, F.lit(0.0))) < 1e-9

    f1 = F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    table = churn_metrics(m)
    best = table.agg(F.count_if("best").alias("n_best"), F.max("roc_auc").alias("top")).first()
    return table.select(
        "model",
        (hit + false + missed + passed).alias("test_rows"),
        (hit + missed).alias("churned_rows"),
        (
            near(F.col("accuracy"), F.try_divide(hit + passed, hit + false + missed + passed))
            & near(F.col("precision"), F.try_divide(hit, hit + false))
            & near(F.col("recall"), F.try_divide(hit, hit + missed))
            & near(F.col("f1"), f1)
        ).alias("rates_fit"),
        F.col("roc_auc").between(0, 1).alias("area_in_range"),
        (F.lit(best["n_best"] == 1) & (~F.col("best") | (F.col("roc_auc") == best["top"]))).alias("one_best"),
    )


@query
def churn_feature_importance_facts(m: Model) -> DataFrame:
    found = churn_feature_importance(m)
    total = found.agg(F.sum("importance")).first()[0]
    return found.select(
        "feature", F.col("importance").between(0, 1).alias("in_range"), F.lit(abs(total - 1) < 1e-9).alias("adds_up")
    )


@query
def customer_kmeans_facts(m: Model) -> DataFrame:
    found = customer_kmeans(m)
    labels = found.groupBy("cluster").agg(F.count_distinct("cluster_label").alias("labels"))
    return found.join(F.broadcast(labels), "cluster").select(
        "customer_id",
        F.col("cluster_label").isin(*CLUSTER_LABELS).alias("label_known"),
        (F.col("labels") == 1).alias("one_label_per_cluster"),
    )


def _stand_in_scores(m: Model) -> DataFrame:
    """Scores that SQL can reproduce, in the shape of the churn predictions."""
    probability = F.col("recency") / (F.col("recency") + 90.0)
    return m.rfm.select(
        "customer_id",
        probability.alias("churn_probability"),
        (probability >= 0.5).cast("bigint").alias("churn_prediction"),
        churn_model.risk_level(probability).alias("risk_level"),
    )


@query
def churn_risk_bands(m: Model) -> DataFrame:
    return _stand_in_scores(m)


@query
def churn_risk_counts(m: Model) -> DataFrame:
    return churn_model.risk_counts(_stand_in_scores(m))


# --- recommendations --------------------------------------------------------


def _counts(m: Model) -> DataFrame:
    return recommend.popularity(m.items, m.segmented)


def _choices(m: Model, segment_pool: int) -> DataFrame:
    pool = recommend.build_pool(m.items, m.products, m.segmented, segment_pool, OVERALL_POOL)
    return recommend.ranked_choices(m.segmented, recommend.customer_history(m.items, m.products, pool), pool)


@query
def rec_purchases(m: Model) -> DataFrame:
    return recommend.completed_purchases(m.items)


@query
def rec_segment_popularity(m: Model) -> DataFrame:
    return recommend.segment_popularity(_counts(m))


@query
def rec_overall_popularity(m: Model) -> DataFrame:
    return recommend.overall_popularity(_counts(m))


@query
def rec_candidate_pool(m: Model) -> DataFrame:
    return recommend.candidate_pool(_counts(m), recommend.default_pool(5), recommend.default_pool(5))


@query
def rec_primary(m: Model) -> DataFrame:
    chosen = _choices(m, recommend.default_pool(5))
    return chosen.filter(F.col("source") == recommend.SEGMENT_SOURCE).select(
        "customer_id", "product_id", "purchase_count", "rank"
    )


@query
def rec_backfill(m: Model) -> DataFrame:
    chosen = _choices(m, SMALL_SEGMENT_POOL)
    return chosen.filter(F.col("source") == recommend.OVERALL_SOURCE).select(
        "customer_id", "product_id", "purchase_count", "rank"
    )


@query
def rec_explanations(m: Model) -> DataFrame:
    """Every recommendation with its text, from the default pools and from the small one."""
    default = recommend.build_recommendations(m.items, m.products, m.segmented)
    small = recommend.build_recommendations(
        m.items, m.products, m.segmented, segment_pool=SMALL_SEGMENT_POOL, overall_pool=OVERALL_POOL
    )
    parts = default.withColumn("pool", F.lit("default")).unionByName(small.withColumn("pool", F.lit("small")))
    return parts.select("pool", "customer_id", "product_id", "rank", "explanation")


@query
def recommendations(m: Model) -> DataFrame:
    return recommend.build_recommendations(m.items, m.products, m.segmented)


@query
def rec_for_customer(m: Model) -> DataFrame:
    recs = recommend.build_recommendations(m.items, m.products, m.segmented)
    return recommend.customer_recommendations(recs, 42, 3)


# --- repeated order rows ------------------------------------------------------


@query
def feat_completed_items_repeated(m: Model) -> DataFrame:
    found = purchases.completed_items(m.repeated_orders, m.bare_items)
    return found.select("order_id", "user_id", "product_id", "sale_price")


@query
def rfm_features_repeated(m: Model) -> DataFrame:
    return rfm.build_rfm_features(m.same_owner_orders, m.bare_items)


@query
def customer_aggregates_repeated(m: Model) -> DataFrame:
    return customers.build_customer_aggregates(m.same_owner_orders, m.bare_items, m.users)


@query
def churn_features_repeated(m: Model) -> DataFrame:
    return churn_features.build_churn_features(m.same_owner_orders, m.bare_items, m.users)


@query
def kpi_monthly_repeated(m: Model) -> DataFrame:
    return kpis.compute_monthly_kpis(m.repeated_orders, m.bare_items)


@query
def sql_rfm_repeated(m: Model) -> DataFrame:
    catalog.register({"orders": m.same_owner_orders, "order_items": m.bare_items})
    return catalog.run_sql_file(m.spark, "rfm")


@query
def sql_monthly_kpis_repeated(m: Model) -> DataFrame:
    catalog.register({"orders": m.repeated_orders, "order_items": m.bare_items})
    return catalog.run_sql_file(m.spark, "monthly_kpis")


# --- KPIs, cohorts, categories ----------------------------------------------


@query
def kpi_monthly(m: Model) -> DataFrame:
    return kpis.compute_monthly_kpis(m.orders, m.bare_items)


@query
def sql_monthly_kpis(m: Model) -> DataFrame:
    catalog.register({"orders": m.orders, "order_items": m.bare_items})
    return catalog.run_sql_file(m.spark, "monthly_kpis")


@query
def cohort_long(m: Model) -> DataFrame:
    return kpis.cohort_activity(m.orders)


@query
def sql_cohort(m: Model) -> DataFrame:
    catalog.register({"orders": m.orders})
    return catalog.run_sql_file(m.spark, "cohort")


@query
def cohort_wide(m: Model) -> DataFrame:
    return kpis.compute_cohort_retention(m.orders)


@query
def cohort_wide_cells(m: Model) -> DataFrame:
    """Every cell of the wide table. SQL states the cells for any offsets, columns only for a fixed list of them."""
    wide = kpis.compute_cohort_retention(m.orders)
    offsets = [c for c in wide.columns if c != "cohort_month"]
    cells = wide.unpivot("cohort_month", offsets, "months_since", "retention_rate")
    return cells.withColumn("months_since", F.col("months_since").cast("bigint"))


@query
def category_analytics(m: Model) -> DataFrame:
    return assortment.compute_category_analytics(m.items, m.products)


@query
def sql_category_analytics(m: Model) -> DataFrame:
    catalog.register({"order_items": m.items, "products": m.products})
    return catalog.run_sql_file(m.spark, "category_analytics")


@query
def product_top_n(m: Model) -> DataFrame:
    return assortment.compute_product_analytics(m.items, m.products, 50)


# --- reports ----------------------------------------------------------------


def _base(m: Model) -> DataFrame:
    return reports.segment_base(m.profile, m.segmented)


def _filtered(m: Model) -> DataFrame:
    return reports.filter_customers(_base(m), **SAMPLE_FILTER)


@query
def dash_overview(m: Model) -> DataFrame:
    monthly = kpis.compute_monthly_kpis(m.orders, m.bare_items)
    profile = m.profile
    return reports.overview(m.segmented, profile, _stand_in_scores(m), monthly)


@query
def dash_monthly_series(m: Model) -> DataFrame:
    return reports.monthly_series(kpis.compute_monthly_kpis(m.orders, m.bare_items))


@query
def dash_segment_base(m: Model) -> DataFrame:
    slim = m.profile.drop("recency", "frequency", "monetary", "segment")
    return reports.segment_base(slim, m.segmented.drop("monetary")).select(
        "customer_id", "segment", "recency", "frequency", "monetary", "country"
    )


@query
def dash_filter_options(m: Model) -> DataFrame:
    return reports.filter_options(_base(m))


@query
def dash_filtered_customers(m: Model) -> DataFrame:
    found = reports.filter_customers(_base(m), **SAMPLE_FILTER, search="00000012")
    return found.select("customer_id", "last_name", "segment", "recency", "frequency", "monetary", "gender")


@query
def dash_filter_summary(m: Model) -> DataFrame:
    return reports.filter_summary(_base(m), _filtered(m))


@query
def dash_segment_revenue(m: Model) -> DataFrame:
    return reports.segment_revenue(_base(m))


@query
def dash_segment_matrix(m: Model) -> DataFrame:
    return reports.segment_matrix(_filtered(m), _base(m))


@query
def dash_scatter(m: Model) -> DataFrame:
    return reports.scatter(_filtered(m))


@query
def dash_detail_table(m: Model) -> DataFrame:
    return reports.detail_table(_base(m))


@query
def customer_360(m: Model) -> DataFrame:
    profile = m.profile
    recs = recommend.build_recommendations(m.items, m.products, m.segmented)
    flat = reports.customer_360(m.segmented, profile, _stand_in_scores(m), customers.clv_table(profile), recs)
    return flat.select(
        "customer_id", "first_name", "last_name", "country", "segment", "rfm_score", "monetary",
        "total_orders", "risk_level", "churn_probability", "estimated_clv",
        "recommendation_count", "recommended_products",
    )


@query
def dash_probability_histogram(m: Model) -> DataFrame:
    return reports.probability_histogram(_stand_in_scores(m))


@query
def dash_high_risk_top(m: Model) -> DataFrame:
    return reports.high_risk_top(_stand_in_scores(m))


@query
def dash_top_features(m: Model) -> DataFrame:
    features, train = _train_part(m)
    forest = churn_model.fit_forest(train, churn_model.CHURN_FEATURES)
    return reports.top_features(churn_model.feature_importance(forest, features))


@query
def dash_top_features_facts(m: Model) -> DataFrame:
    rows = dash_top_features(m).collect()  # ten at most
    known = {r["feature"] for r in rows} <= set(churn_model.CHURN_FEATURES)
    values = [r["importance"] for r in rows]
    facts = (len(rows), known, values == sorted(values, reverse=True))
    return m.spark.createDataFrame([facts], "features bigint, known boolean, in_order boolean")


@query
def dash_rec_categories(m: Model) -> DataFrame:
    return reports.recommendation_categories(recommend.build_recommendations(m.items, m.products, m.segmented))


@query
def dash_category_totals(m: Model) -> DataFrame:
    return reports.category_totals(assortment.compute_category_analytics(m.items, m.products))


@query
def dash_category_top(m: Model) -> DataFrame:
    return reports.category_top(assortment.compute_category_analytics(m.items, m.products))


@query
def dash_cohort_heatmap(m: Model) -> DataFrame:
    return reports.cohort_heatmap(kpis.compute_cohort_retention(m.orders))


@query
def diag_score_counts(m: Model) -> DataFrame:
    return reports.score_counts(m.segmented)


@query
def diag_frequency_share(m: Model) -> DataFrame:
    return reports.frequency_shares(m.segmented)


@query
def diag_crosstab(m: Model) -> DataFrame:
    return reports.frequency_score_table(m.segmented)


@query
def diag_other_pairs(m: Model) -> DataFrame:
    return reports.score_pairs(m.segmented)


@query
def diag_segment_share(m: Model) -> DataFrame:
    return reports.segment_share(m.segmented, "Champions")


def build(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: QUERIES[name](Model(spark, sf_dir))
