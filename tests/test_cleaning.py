import pandas as pd
import pytest
from pyspark.sql import functions as F

from shopsight.operators import cleaning
from tests import tables

TEXT_ORDERS = "order_id string, user_id string, status string, created_at string, note string"


def test_orders(spark):
    raw = spark.createDataFrame(
        [
            ("1", "10", " Complete ", "2023-01-02", "late copy"),
            ("1", "10", "complete", "2023-01-01 10:00:00 UTC", "first"),
            ("2", None, "complete", "2023-01-01", None),
            (None, "10", "complete", "2023-01-01", None),
            ("3", "11", "SHIPPED", "not a date", None),
            ("4", "11", None, "2023-01-01T00:00:00+02:00", None),
        ],
        TEXT_ORDERS,
    )
    rows = tables.keyed(cleaning.clean_orders(raw).withColumn("at", F.unix_timestamp("created_at")), "order_id")
    assert set(rows) == {1, 4}
    assert rows[1].note == "first" and rows[1].status == "complete"
    assert rows[4].status is None
    assert pd.to_datetime(rows[4].at, unit="s") == pd.Timestamp("2022-12-31 22:00:00")
    audit = cleaning.cleaning_audit({"orders": raw}).first()
    assert tuple(audit)[1:] == (6, 2, 1, 0, 1, 2)


def test_users(spark):
    raw = tables.raw_tables(spark)["users"].withColumn(
        "age", F.expr("CASE id WHEN 1 THEN '-5' WHEN 2 THEN '130' WHEN 3 THEN 'old' WHEN 4 THEN 'NaN' ELSE '120' END")
    ).withColumn("gender", F.expr("CASE WHEN id = 5 THEN NULL ELSE concat(' ', gender, ' ') END"))
    rows = tables.keyed(cleaning.clean_users(raw), "id")
    assert [rows[i].age for i in (1, 2, 3, 4, 5)] == [None, None, None, None, 120.0]
    assert rows[5].gender is None and rows[6].gender == "M"


def test_items_keep_duplicates_and_drop_bad_prices(spark):
    rows = [(1, 1, 1, 1, "Complete ", "2023-01-01", p) for p in (5.0, 5.0, -1.0, None, float("nan"))]
    raw = tables.table(spark, "order_items", rows)
    clean = cleaning.clean_order_items(raw)
    assert clean.count() == 2 and {r.status for r in clean.collect()} == {"complete"}
    assert tuple(cleaning.cleaning_audit({"order_items": raw}).first())[1:] == (5, 0, 0, 3, 0, 2)


def test_products_events_inventory(spark):
    raw = tables.raw_tables(spark)
    products = raw["products"].withColumn("name", F.concat(F.lit(" "), "name", F.lit("  ")))
    assert cleaning.clean_products(products.unionByName(products)).count() == 10
    assert tables.keyed(cleaning.clean_products(products), "id")[1]["name"] == "Product 1"
    events = raw["events"].withColumn("user_id", F.when(F.col("id") > 5, F.col("user_id")))
    assert cleaning.clean_events(events).count() == 25
    inventory = cleaning.clean_inventory_items(raw["inventory_items"].withColumn("sold_at", F.lit("?")))
    assert inventory.filter("sold_at IS NULL").count() == 10


def test_all_tables_pass_through(spark):
    raw = tables.raw_tables(spark)
    clean = cleaning.clean_all(raw)
    assert set(clean) == set(raw)
    assert {t: df.count() for t, df in clean.items()} == {t: df.count() for t, df in raw.items()}


@pytest.mark.parametrize("column", ["created_at", "shipped_at", "delivered_at", "returned_at"])
def test_optional_dates(spark, column):
    raw = tables.raw_tables(spark)["orders"]
    raw = raw.withColumn(column, F.lit("2021-01-01"))
    assert dict(cleaning.clean_orders(raw).dtypes)[column] == "timestamp"


@pytest.mark.parametrize(
    "text,day",
    [("2022/05/01", "2022-05-01"), ("05/01/2022 10:00", "2022-05-01"), ("12/31/2022", "2022-12-31"), ("31/31/2022", None)],
)
def test_dates_written_otherwise(spark, text, day):
    raw = spark.createDataFrame([("1", "1", "complete", text, None)], TEXT_ORDERS)
    rows = cleaning.clean_orders(raw).select(F.date_format("created_at", "yyyy-MM-dd").alias("d")).collect()
    assert [r.d for r in rows] == ([day] if day else [])


def test_numbers_and_centers_are_typed(spark):
    orders = tables.raw_tables(spark)["orders"].withColumn("num_of_item", F.lit("3"))
    assert dict(cleaning.clean_orders(orders).dtypes)["num_of_item"] == "bigint"
    text = tables.raw_tables(spark)["distribution_centers"].select(*[F.col(c).cast("string").alias(c) for c in ("id", "name", "latitude", "longitude")])
    assert dict(cleaning.clean_centers(text).dtypes) == {"id": "bigint", "name": "string", "latitude": "double", "longitude": "double"}


def test_audit_reads_the_table_once(spark, tmp_path):
    """The counts come from the pass that writes: one scan of the raw table, one write."""
    tables.raw_tables(spark)["orders"].write.parquet(str(tmp_path / "orders"))
    raw = spark.read.parquet(str(tmp_path / "orders"))
    counts = cleaning.Counts()
    clean = cleaning.clean_orders(raw, counts)
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("CollectMetrics") == 4
    clean.write.parquet(str(tmp_path / "clean"))
    assert counts.row()["rows_out"] == spark.read.parquet(str(tmp_path / "clean")).count()


def test_audit_is_counted_again_when_tasks_were_observed_twice(spark, monkeypatch):
    raw = tables.raw_tables(spark)["orders"]
    real, calls = cleaning.Counts.row, []

    def doubled(self):
        calls.append(1)
        row = real(self)
        return {k: 2 * v for k, v in row.items()} if len(calls) == 1 else row

    monkeypatch.setattr(cleaning.Counts, "row", doubled)
    stored, row = cleaning.store_cleaned("orders", raw, lambda df: cleaning.materialize(df, "t"))
    assert row["rows_out"] == stored.count() and len(calls) == 2
