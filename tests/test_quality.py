import pytest
from pyspark.sql import functions as F

from shopsight.operators import quality
from tests import tables


@pytest.fixture(scope="module")
def raw(spark):
    return tables.raw_tables(spark)


def failing(spark, raw_set):
    report = quality.quality_report(raw_set)
    return {
        (r.table_name, r.check_name, r.column_name): r
        for r in report.filter("n_bad > 0").collect()
    }


def test_valid_set_passes(spark, raw):
    report = quality.quality_report(raw)
    assert quality.passed(report)
    assert report.filter("n_bad > 0").count() == 0


def test_empty_table_is_an_issue(spark, raw):
    bad = failing(spark, raw | {"users": raw["users"].limit(0)})
    assert bad["users", "empty_table", None].severity == "issue"


def test_missing_column_is_an_issue(spark, raw):
    broken = raw | {"users": raw["users"].drop("email")}
    assert failing(spark, broken)["users", "missing_column", "email"].severity == "issue"
    assert [tuple(r) for r in quality.required_columns(broken).collect()] == [("users", "email", 10)]
    assert quality.required_columns(raw).count() == 0


def test_missing_table_is_an_issue(spark, raw):
    partial = {t: df for t, df in raw.items() if t != "events"}
    assert ("events", "missing_table", None) in failing(spark, partial)
    assert not quality.passed(quality.quality_report(partial))


def test_orphans_and_owner_mismatch(spark, raw):
    orphan = raw["order_items"].withColumn("order_id", F.when(F.col("id") == 1, 9999).otherwise(F.col("order_id")))
    assert failing(spark, raw | {"order_items": orphan})["references", "orphan_key", "order_items.order_id"].n_bad == 1
    moved = raw["order_items"].withColumn("user_id", F.when(F.col("id") == 1, 2).otherwise(F.col("user_id")))
    assert failing(spark, raw | {"order_items": moved})["references", "owner_mismatch", "order_items.user_id"].n_bad == 1


def test_null_child_key_needs_a_null_parent(spark, raw):
    nulls = raw["orders"].withColumn("user_id", F.when(F.col("order_id") > 2, F.col("user_id")))
    key = ("references", "orphan_key", "orders.user_id")
    assert failing(spark, raw | {"orders": nulls})[key].n_bad == 2
    users = raw["users"].withColumn("id", F.when(F.col("id") != 10, F.col("id")))
    both = failing(spark, raw | {"orders": nulls, "users": users})
    assert both[key].n_bad == 2  # the orders of user 10; the NULL ones meet a NULL user


def test_duplicates_and_conflicts(spark, raw):
    twice = raw["users"].unionByName(raw["users"].filter("id <= 3"))
    bad = failing(spark, raw | {"users": twice})
    assert bad["users", "duplicate_key", "id"].n_bad == 3
    assert ("users", "conflicting_key", "id") not in bad
    other = raw["users"].filter("id = 1").withColumn("city", F.lit(None).cast("string"))
    bad = failing(spark, raw | {"users": twice.unionByName(other)})
    assert bad["users", "conflicting_key", "id"].n_bad == 1


def test_swapped_nulls_conflict(spark, raw):
    """Hashing must tell (NULL, x) from (x, NULL)."""
    row = raw["distribution_centers"].filter("id = 1")
    left = row.withColumn("latitude", F.lit(None).cast("double")).withColumn("longitude", F.lit(7.0))
    right = row.withColumn("latitude", F.lit(7.0)).withColumn("longitude", F.lit(None).cast("double"))
    bad = failing(spark, raw | {"distribution_centers": left.unionByName(right)})
    assert bad["distribution_centers", "conflicting_key", "id"].n_bad == 1


def test_warnings_do_not_fail(spark, raw):
    dirty = raw["order_items"].withColumn("sale_price", F.when(F.col("id") == 1, -10.0).otherwise(F.col("sale_price")))
    dates = raw["users"].withColumn("created_at", F.when(F.col("id") == 1, "soon").otherwise(F.col("created_at")))
    dirty_set = raw | {"order_items": dirty, "users": dates}
    bad = failing(spark, dirty_set)
    assert bad["order_items", "negative_value", "sale_price"].severity == "warning"
    assert bad["users", "bad_date", "created_at"].pct == 10.0
    assert quality.passed(quality.quality_report(dirty_set))


def test_summary(spark, raw):
    twice = raw["users"].unionByName(raw["users"].filter("id <= 3"))
    rows = tables.keyed(quality.summary(raw | {"users": twice}), "table_name")
    assert (rows["users"].row_count, rows["users"].column_count) == (13, 10)
    assert (rows["users"].issues, rows["users"].warnings, rows["users"].status) == (0, 1, "PASS")


def test_one_scan_per_table_outside_the_references(spark, tmp_path):
    raw = tables.raw_tables(spark)
    for name, df in raw.items():
        df.write.parquet(str(tmp_path / name))
    stored = {name: spark.read.parquet(str(tmp_path / name)) for name in raw}
    plan = quality.table_checks(stored)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == len(raw)


def test_hot_and_null_keys_are_combined(spark):
    """A third of the rows share one key; null keys count as one key that repeats."""
    rows = [(7 if i % 3 == 0 else None if i % 50 == 1 else i, "x" if i else "y") for i in range(900)]
    users = spark.createDataFrame(rows, "id long, email string")
    found = {(r.check_name, r.column_name): r.n_bad for r in quality.table_checks({"users": users}).collect()}
    keys = [k for k, _ in rows]
    assert found["duplicate_key", "id"] == len(keys) - len(set(keys))
    assert found["conflicting_key", "id"] == 1 and found["empty_table", None] == 0
    empty = {(r.check_name): r.n_bad for r in quality.table_checks({"users": users.limit(0)}).collect()}
    assert empty["empty_table"] == 1 and "duplicate_key" not in empty
