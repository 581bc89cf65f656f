"""The driver contract on the smallest test tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from checks import oracles, queries
from checks.compare import compare, oracle_connection

SF = "/root/testdata/sf0.001"


def test_every_oracle_has_a_query():
    queries = contract.queries()
    assert set(contract.oracle_sql()) <= set(queries)
    without = set(queries) - set(contract.oracle_sql())
    assert all(n.startswith(("churn_", "customer_kmeans", "sink_publish", "dash_top_features", "op", "pipeline")) for n in without)


def test_oracle_fragments_resolve():
    for name in oracles.ORACLES:
        assert "{" not in oracles.compose(name)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize(
    "name", ["category_analytics", "sql_rfm", "rfm_segments", "churn_features", "rec_backfill", "dq_report", "clean_orders"]
)
def test_query_equals_oracle(spark, name):
    good, detail = compare(spark, oracle_connection(SF), name, SF)
    assert good, detail


def test_wide_cohorts_keep_offsets_beyond_the_listed_ones(spark, tmp_path):
    """Orders from January 1995 to August 2001 span the offsets 0 to 79; the SQL of `cohort_wide` lists 79 of these 80."""
    connection = duckdb.connect()
    dated = "(1, 1, '1995-01-31'), (2, 1, '2001-08-01'), (3, 2, '1995-01-02'), (4, 3, '2001-07-31'), (5, 3, '2001-08-01')"
    for table, sql in {
        "orders": f"""SELECT k::BIGINT AS o_orderkey, u::BIGINT AS o_custkey, 'F' AS o_orderstatus, d::TIMESTAMP AS o_orderdate
                      FROM (VALUES {dated}) t(k, u, d)""",
        "lineitem": f"""SELECT k::BIGINT AS l_orderkey, 1 AS l_linenumber, 1::BIGINT AS l_partkey, 'A' AS l_returnflag,
                        9.5::DOUBLE AS l_extendedprice FROM (VALUES {dated}) t(k, u, d)""",
    }.items():
        connection.execute(f"COPY ({sql}) TO '{tmp_path}/{table}.parquet' (FORMAT parquet)")
    good, detail = compare(spark, oracle_connection(str(tmp_path)), "cohort_wide_cells", str(tmp_path))
    assert good, detail
    assert contract.queries()["cohort_wide"](spark, str(tmp_path)).columns == ["cohort_month", "0", "1", "79"]
    rows = queries.build("cohort_wide_cells")(spark, str(tmp_path)).collect()
    assert {(r.cohort_month, r.months_since): r.retention_rate for r in rows} == {
        ("1995-01", 0): 1.0, ("1995-01", 1): None, ("1995-01", 79): 0.5,
        ("2001-07", 0): 1.0, ("2001-07", 1): 1.0, ("2001-07", 79): None,
    }


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_entry(spark):
    assert contract.entry(spark).count() > 0
