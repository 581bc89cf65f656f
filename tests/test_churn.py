import pytest
from pyspark.sql import functions as F

from shopsight.operators import churn_features, churn_model, clusters, customers, rfm
from shopsight.operators.cleaning import clean_all
from tests import tables


@pytest.fixture(scope="module")
def shop(spark):
    return clean_all(tables.shop(spark, 150))


@pytest.fixture(scope="module")
def features(spark, shop):
    built = churn_features.build_churn_features(shop["orders"], shop["order_items"], shop["users"])
    return churn_model.training_table(built)


def test_hand_computed_window(spark):
    orders = tables.orders(
        spark, [(1, 1, "2022-12-01"), (2, 2, "2022-12-01"), (3, 1, "2023-04-02"), (4, 2, "2023-02-01")]
    )
    items = tables.items(
        spark, [(1, 1, 1, 10), (1, 1, 2, 30), (1, 1, 3, 900, "cancelled"), (2, 2, 1, 100), (3, 1, 1, 100), (4, 2, 1, 50)]
    )
    users = tables.raw_tables(spark)["users"].withColumn("gender", F.when(F.col("id") == 2, "M").otherwise("F"))
    built = churn_features.build_churn_features(orders, items, users, 90, "2023-01-01")
    rows = tables.keyed(built, "user_id")
    assert (rows[1].churned, rows[2].churned) == (1, 0)
    assert (rows[1].monetary, rows[1].avg_order_value, rows[1].recency) == (40.0, 40.0, 31.0)
    assert (rows[1].is_male, rows[2].is_male) == (0, 1)
    totals = tables.keyed(customers.build_customer_aggregates(orders, items, users), "customer_id")
    assert (totals[1].total_revenue, totals[1].avg_order_value, totals[2].avg_order_value) == (140.0, 70.0, 75.0)


def test_label_window_includes_both_ends(spark):
    orders = tables.orders(
        spark,
        [(1, 1, "2022-01-01"), (2, 1, "2023-01-01"), (3, 2, "2022-01-01"), (4, 2, "2023-04-01"),
         (5, 3, "2022-01-01"), (6, 3, "2023-04-02")],
    )
    items = tables.items(spark, [(o, 1, 1, 5) for o in range(1, 7)])
    built = churn_features.build_churn_features(orders, items, tables.raw_tables(spark)["users"], 90, "2023-01-01")
    assert {r.user_id: r.churned for r in built.collect()} == {1: 0, 2: 0, 3: 1}


def test_input_errors(spark):
    orders = tables.orders(spark, [(1, 1, "2023-01-01"), (2, 1, "2023-12-31")])
    with pytest.raises(ValueError, match="positive"):
        churn_features.churn_window(orders, 0)
    with pytest.raises(ValueError, match="label window"):
        churn_features.churn_window(orders, 90, "2023-12-01")
    with pytest.raises(ValueError, match="No historical"):
        churn_features.churn_window(orders, 90, "2022-12-31")
    with pytest.raises(ValueError, match="No completed"):
        churn_features.churn_window(tables.orders(spark, [(1, 1, "2023-01-01")], "cancelled"))


def test_no_leakage(features):
    assert features.filter("recency < 0 OR tenure_days < 0").count() == 0
    row = churn_features.churn_rate(features).first()
    assert row.customers == row.churned + row.active


def test_split_is_exact_disjoint_and_stable(features):
    train, test = churn_model.stratified_split(features)
    train_ids = {r.user_id for r in train.select("user_id").collect()}
    test_ids = {r.user_id for r in test.select("user_id").collect()}
    assert not train_ids & test_ids and len(train_ids | test_ids) == features.count()
    for churned in (0, 1):
        total = features.filter(F.col("churned") == churned).count()
        assert test.filter(F.col("churned") == churned).count() == int(total * 0.2 + 0.5)
    again = churn_model.stratified_split(features.repartition(7))[1]
    assert {r.user_id for r in again.select("user_id").collect()} == test_ids


def test_split_of_a_one_class_table(features):
    train, test = churn_model.stratified_split(features.withColumn("churned", F.lit(1)))
    assert train.count() + test.count() == features.count()


@pytest.fixture(scope="module")
def trained(features):
    return churn_model.train_churn_models(features, trees=5)


def test_metrics(trained, features):
    for metrics in trained.metrics.values():
        assert 0 <= metrics["roc_auc"] <= 1 and 0 <= metrics["f1"] <= 1
    table = churn_model.metrics_table(trained, features)
    assert [r.model for r in table.filter("best").collect()] == [trained.best_name]


def test_forest_limits_are_parameters(trained, features):
    forest = trained.models[churn_model.FOREST].stages[-1]
    assert forest.getMaxDepth() == churn_model.FOREST_DEPTH == 10
    small = churn_model.train_churn_models(features, trees=2, depth=3, max_bins=16).models[churn_model.FOREST].stages[-1]
    assert (small.getMaxDepth(), small.getMaxBins()) == (3, 16)
    assert max(tree.depth for tree in small.trees) <= 3


def test_tie_goes_to_logistic_regression():
    same = {"roc_auc": 0.5}
    assert churn_model.ChurnModels({}, {churn_model.LOGISTIC: same, churn_model.FOREST: same}, []).best_name == churn_model.LOGISTIC


def test_importance(trained, features):
    rows = churn_model.feature_importance(trained.models[churn_model.FOREST], features).collect()
    assert [r.feature for r in rows] and all(r.importance >= 0 for r in rows)
    assert [r.importance for r in rows] == sorted((r.importance for r in rows), reverse=True)


def test_model_round_trip_and_predictions(spark, trained, features, tmp_path):
    path = str(tmp_path / "model")
    churn_model.save_model(trained.best, path)
    loaded = churn_model.load_model(path)
    assert churn_model.input_columns(loaded) == trained.feature_columns
    ours = tables.keyed(churn_model.generate_churn_predictions(features, loaded), "customer_id")
    assert ours == tables.keyed(churn_model.generate_churn_predictions(features, trained.best), "customer_id")
    assert len(ours) == features.count()
    assert {r.risk_level for r in ours.values()} <= {"Low Risk", "Medium Risk", "High Risk"}


def test_risk_bands(spark):
    df = spark.createDataFrame([(0.2999,), (0.3,), (0.5999,), (0.6,)], "p double")
    assert [r[0] for r in df.select(churn_model.risk_level(F.col("p"))).collect()] == [
        "Low Risk", "Medium Risk", "Medium Risk", "High Risk",
    ]


def test_training_guards(spark, features):
    with pytest.raises(ValueError, match="Insufficient data"):
        churn_model.train_churn_models(features.limit(5))
    with pytest.raises(ValueError, match="class representation"):
        churn_model.check_training_data(features.withColumn("churned", F.lit(1)))


def test_kmeans(spark, shop):
    scored = rfm.compute_rfm_scores(rfm.build_rfm_features(shop["orders"], shop["order_items"]))
    rows = clusters.run_kmeans_clustering(scored, n_clusters=3, restarts=2).collect()
    assert len(rows) == 150 and {r.cluster_label for r in rows} == {"High Value", "Loyal Active", "Moderate Buyers"}


def test_cluster_names_follow_value():
    names = clusters.cluster_labels([[100.0, 1.0, 10.0], [5.0, 9.0, 900.0]])
    assert names == {1: "High Value", 0: "Loyal Active"}
