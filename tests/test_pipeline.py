import os

import pytest

from shopsight.contracts import OUTPUTS
from shopsight.operators import reports
from shopsight.plans import pipeline
from shopsight.sources import paths, scratch
from tests import tables


def write_raw(raw, folder, csv=()):
    for name, df in raw.items():
        if name in csv:
            df.coalesce(1).write.option("header", True).csv(f"{folder}/{name}.csv")
        else:
            df.coalesce(1).write.parquet(f"{folder}/{name}.parquet")


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("run")
    write_raw(tables.shop(spark, 250), folder / "raw", csv=("orders", "order_items"))
    result = pipeline.run(spark, str(folder / "raw"), str(folder / "out"), str(folder / "model"), trees=5)
    return result, folder


def test_all_outputs_are_ready(spark, published):
    result, folder = published
    status = tables.keyed(result.status, "output")
    assert set(status) == set(OUTPUTS) and {r.status for r in status.values()} == {"ready"}
    assert status["customer_rfm"].row_count == status["clv"].row_count == 250
    assert sorted(os.listdir(folder / "out"))[0] in ("_staging", "category_analytics.parquet")
    assert os.path.exists(folder / "model" / "metadata")


def test_audit_comes_with_the_stored_tables(spark, published):
    result, folder = published
    audit = tables.keyed(result.audit, "table_name")
    assert set(audit) == set(pipeline.STORED)
    for table, row in audit.items():
        assert row.rows_out == spark.read.parquet(f"{folder}/out/tables/{table}.parquet").count()
        assert row.rows_in - sum(v for k, v in row.asDict().items() if k.startswith("dropped")) == row.rows_out


def test_intermediate_tables_of_a_run_are_deleted(spark, published):
    assert [n for n, _ in paths.children(spark, scratch.root(spark)) if n.startswith("run-")] == []


def test_recommendations_respect_history(spark, published):
    _, folder = published
    recs = spark.read.parquet(str(folder / "out" / "recommendations.parquet"))
    assert recs.groupBy("customer_id").count().filter("count > 5").count() == 0


def test_regenerate_sql_outputs(spark, published):
    _, folder = published
    before = spark.read.parquet(str(folder / "out" / "monthly_kpis.parquet")).select("year_month", "total_orders").collect()
    assert pipeline.regenerate_sql_outputs(spark, str(folder / "out")) == {}
    after = spark.read.parquet(str(folder / "out" / "monthly_kpis.parquet")).select("year_month", "total_orders").collect()
    assert sorted(before) == sorted(after)


def test_another_session_rebuilds_from_the_published_tables(spark, published):
    _, folder = published
    out = str(folder / "out")
    before = {n: sorted(spark.read.parquet(f"{out}/{n}.parquet").collect()) for n in ("monthly_kpis", "category_analytics")}
    later = spark.newSession()
    assert sorted(pipeline.open_tables(later, out)) == ["order_items", "orders", "products", "users"]
    assert later.table("orders").count() == spark.read.parquet(f"{out}/tables/orders.parquet").count() > 0
    assert pipeline.rebuild(spark, out) == {}
    assert {n: sorted(spark.read.parquet(f"{out}/{n}.parquet").collect()) for n in before} == before
    with pytest.raises(FileNotFoundError):
        pipeline.open_tables(later, str(folder / "nothing"))


def test_model_belongs_to_the_outputs(spark, published):
    result, folder = published
    model = pipeline.load_published_model(spark, str(folder / "out"), str(folder / "model"))
    assert model.stages[0].getInputCols() == result.models.best.stages[0].getInputCols()
    assert [n for n in os.listdir(folder) if ".staged-" in n or ".tables-" in n] == []


def test_failed_validation_writes_nothing(spark, tmp_path):
    raw = tables.raw_tables(spark)
    raw["users"] = raw["users"].drop("email")
    write_raw(raw, tmp_path / "raw")
    with pytest.raises(pipeline.ValidationFailed) as error:
        pipeline.run(spark, str(tmp_path / "raw"), str(tmp_path / "out"))
    assert error.value.report.filter("check_name = 'missing_column' AND n_bad > 0").count() == 1
    assert not os.path.exists(tmp_path / "out")
    assert os.listdir(tmp_path) == ["raw"]


def test_reports_on_published_outputs(spark, published):
    _, folder = published
    out = {n: spark.read.parquet(str(folder / "out" / c.path)) for n, c in OUTPUTS.items()}
    base = reports.segment_base(out["customer_segments"], out["customer_rfm"])
    assert base.count() == 250
    head = reports.overview(out["customer_rfm"], out["customer_segments"], out["churn_predictions"], out["monthly_kpis"]).first()
    assert head.total_customers == 250 and head.total_revenue > 0
    one = reports.customer_360(
        out["customer_rfm"], out["customer_segments"], out["churn_predictions"], out["clv"], out["recommendations"], 7
    ).collect()
    assert len(one) == 1 and one[0].customer_id == 7 and one[0].recommendation_count <= 5
    heat = reports.cohort_heatmap(out["cohort_retention"])
    assert len(heat.columns) <= 13 and heat.first()["0"] == 100.0


def test_empty_filter_and_search(spark, published):
    _, folder = published
    base = spark.read.parquet(str(folder / "out" / "customer_segments.parquet"))
    assert reports.filter_customers(base).count() == 250
    assert reports.filter_customers(base, search=" F24 ").count() == base.filter("first_name LIKE '%F24%'").count()
    assert reports.filter_customers(base, search="(").count() == 0
    none = reports.filter_customers(base, countries=["Nowhere"])
    row = reports.filter_summary(base, none).first()
    assert (row.customers, row.revenue, row.avg_spend, row.dominant_segment) == (0, 0.0, 0.0, "N/A")


def test_segment_base_falls_back(spark, published):
    _, folder = published
    base = spark.read.parquet(str(folder / "out" / "customer_segments.parquet")).drop("monetary", "frequency", "recency")
    row = reports.segment_base(base, None).orderBy("customer_id").first()
    assert (row.monetary, row.frequency, row.recency) == (row.total_revenue, row.total_orders, 0.0)
    with pytest.raises(ValueError):
        reports.segment_base(None, None)


def test_histogram_puts_one_into_the_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (0.024,), (0.025,), (1.0,)], "churn_probability double")
    assert [(r.bin, r.customers) for r in reports.probability_histogram(df).collect()] == [(0, 2), (1, 1), (39, 1)]
