"""Data-quality checks.

Every check yields rows (table_name, check_name, column_name, severity, n_bad,
pct). An `issue` fails validation when n_bad is positive; a `warning` does not.

Checks of single tables are one aggregation over one scan of each: rows carry flags
for their columns and hashes, summed by key and then by table. References are settled
by grouping child and parent keys together. Everything is combined on the map side, so
a repeated key or a heavily referenced parent does not gather in one task.
"""

from __future__ import annotations

from functools import reduce
from itertools import chain
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsight.contracts import (
    DATES,
    FOREIGN_KEYS,
    NON_NEGATIVE,
    NOT_NULL,
    PRIMARY_KEYS,
    RAW_COLUMNS,
    RAW_TABLES,
    ForeignKey,
)
from shopsight.functions import parsing
from shopsight.functions.money import ratio
from shopsight.operators.ranking import first_per_key

ISSUE, WARNING = "issue", "warning"
CHECK_COLUMNS = ["table_name", "check_name", "column_name", "severity", "n_bad"]
RELATIONS = "references"

Tables = dict[str, DataFrame]


class ColumnCheck(NamedTuple):
    check: str
    column: str
    severity: str
    bad: Column


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _types(df: DataFrame) -> dict:
    return {f.name: f.dataType for f in df.schema}


def _common_type(*columns: tuple[DataFrame, str]) -> str:
    """Type to compare key columns in: their own if all are equal, else text."""
    types = {df.schema[c].dataType.simpleString() for df, c in columns}
    return types.pop() if len(types) == 1 else "string"


def _check(name: str, column: Column, severity: str, n_bad: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"),
        column.cast("string").alias("column_name"),
        F.lit(severity).alias("severity"),
        n_bad.cast("bigint").alias("n_bad"),
    )


def finish(checks: DataFrame) -> DataFrame:
    """Check rows with the share of bad rows in percent."""
    return checks.select(*CHECK_COLUMNS, (ratio(F.col("n_bad"), F.col("rows"), 3) * 100).alias("pct"))


# --- columns ----------------------------------------------------------------


def missing_columns(table: str, df: DataFrame) -> list[str]:
    return [c for c in RAW_COLUMNS.get(table, []) if c not in df.columns]


def planned_column_checks(table: str, df: DataFrame) -> list[ColumnCheck]:
    types = _types(df)

    def present(columns: dict[str, list[str]]) -> list[str]:
        return [c for c in columns.get(table, []) if c in types]

    checks = [ColumnCheck("null_key", c, WARNING, F.col(c).isNull()) for c in present(NOT_NULL)]
    checks += [
        ColumnCheck("bad_date", c, WARNING, F.col(c).isNotNull() & parsing.timestamp(c, types[c]).isNull())
        for c in present(DATES)
    ]
    checks += [
        ColumnCheck("negative_value", c, WARNING, F.coalesce(parsing.number(c, types[c]) < 0, F.lit(False)))
        for c in present(NON_NEGATIVE)
    ]
    return checks


def _measured(tables: Tables, planned: dict[str, list[ColumnCheck]], slots: list[str]) -> Column:
    """Check structs of a counted table row (table_name, rows, one sum per slot)."""
    names = F.create_map(
        *chain.from_iterable(
            (
                F.lit(t),
                F.array(*[F.struct(F.lit(c.check).alias("check"), F.lit(c.column).alias("column")) for c in checks])
                if checks
                else F.array().cast("array<struct<check:string,column:string>>"),
            )
            for t, checks in planned.items()
        )
    )
    absent = F.create_map(
        *chain.from_iterable(
            (F.lit(t), F.array(*[F.lit(c) for c in missing_columns(t, df)]).cast("array<string>"))
            for t, df in tables.items()
        )
    )
    sums = F.array(*[F.col(s) for s in slots])
    measured = F.transform(
        names[F.col("table_name")],
        lambda c, i: F.struct(
            c["check"].alias("check_name"),
            c["column"].alias("column_name"),
            F.lit(WARNING).alias("severity"),
            F.get(sums, i).alias("n_bad"),
        ),
    )
    missing = F.transform(
        absent[F.col("table_name")], lambda c: _check("missing_column", c, ISSUE, F.lit(1))
    )
    empty = F.array(_check("empty_table", F.lit(None), ISSUE, F.col("rows") == 0))
    return F.concat(empty, missing, measured)


def table_checks(tables: Tables) -> DataFrame:
    """All checks of single tables, from one scan of each.

    Columns: missing ones, emptiness, null keys, bad dates and negative numbers. Keys: repeated rows, and keys
    whose rows disagree, by the smallest and largest of 128 bits of row hash; when any key conflicts, the repeats
    are part of that issue. Every row leaves its scan as its key, its hashes and a flag per column check; flags
    are summed along with the rows of each key.
    """
    spark = next(iter(tables.values())).sparkSession
    planned = {t: planned_column_checks(t, df) for t, df in tables.items()}
    keyed = {t: PRIMARY_KEYS[t] for t, df in tables.items() if PRIMARY_KEYS.get(t) in df.columns}
    dtype = _common_type(*[(tables[t], key) for t, key in keyed.items()]) if keyed else "string"
    slots = [f"f{i}" for i in range(max(len(checks) for checks in planned.values()))]

    def row(table: Column, rows: int, key: Column, hashes: list[Column], checks: list[ColumnCheck]) -> list[Column]:
        flags = [c.bad.cast("int") for c in checks] + [F.lit(0)] * (len(slots) - len(checks))
        return [
            table.alias("table_name"), F.lit(rows).alias("row"), key.cast(dtype).alias("key"),
            *[h.cast("bigint").alias(n) for n, h in zip(("h1", "h2"), hashes)], *[f.alias(s) for f, s in zip(flags, slots)],
        ]

    nothing = [F.lit(None), F.lit(None)]
    scanned = [
        df.select(
            row(F.lit(t), 1, F.col(keyed[t]), [_fingerprint(df, keyed[t], salt) for salt in (1, 2)], planned[t])
            if t in keyed
            else row(F.lit(t), 1, F.lit(None), nothing, planned[t])
        )
        for t, df in tables.items()
    ]
    # A table without rows still gets its result rows.
    names = F.explode(F.array(*[F.lit(t) for t in tables]))
    present = spark.range(1).select(names.alias("name")).select(row(F.col("name"), 0, F.lit(None), nothing, []))
    groups = (
        _union([*scanned, present])
        .groupBy("table_name", "key")
        .agg(
            F.sum("row").alias("copies"),
            *[f(h).alias(f"{n}_{h}") for h in ("h1", "h2") for n, f in (("least", F.min), ("most", F.max))],
            *[F.sum(s).alias(s) for s in slots],
        )
    )
    conflicting = (F.col("least_h1") != F.col("most_h1")) | (F.col("least_h2") != F.col("most_h2"))
    counted = groups.groupBy("table_name").agg(
        F.sum("copies").alias("rows"),
        F.sum(F.greatest(F.col("copies") - 1, F.lit(0))).alias("repeats"),
        F.count_if(conflicting).alias("conflicts"),
        *[F.sum(s).alias(s) for s in slots],
    )
    key_name = F.create_map(*chain.from_iterable((F.lit(t), F.lit(k)) for t, k in keyed.items())) if keyed else None
    checks = _measured(tables, planned, slots)
    if key_name is not None:
        of_key = F.array(
            _check("duplicate_key", F.try_element_at(key_name, F.col("table_name")), WARNING, F.col("repeats")),
            _check("conflicting_key", F.try_element_at(key_name, F.col("table_name")), ISSUE, F.col("conflicts")),
        )
        checked = (F.col("rows") > 0) & F.col("table_name").isin(*keyed)
        checks = F.concat(checks, F.filter(of_key, lambda _: checked))
    return counted.select("table_name", "rows", F.inline(checks))


# --- keys -------------------------------------------------------------------


def _fingerprint(df: DataFrame, key: str, salt: int) -> Column:
    """64-bit hash of the other columns, with NULL told apart from absence."""
    others = [c for c in df.columns if c != key]
    parts = [part for c in others for part in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(F.lit(salt), *parts)


# --- references -------------------------------------------------------------


def orphans(tables: Tables, keys: list[ForeignKey] = FOREIGN_KEYS) -> DataFrame:
    """Child rows without a parent, by grouping child and parent keys together.

    A NULL child key has a parent only if some parent key is NULL.
    """
    sides = [(tables[fk.child], fk.child_column) for fk in keys] + [(tables[fk.parent], fk.parent_column) for fk in keys]
    dtype = _common_type(*sides)

    def side(df: DataFrame, column: str, label: str, is_child: int) -> DataFrame:
        return df.select(
            F.lit(label).alias("label"),
            F.col(column).cast(dtype).alias("key"),
            F.lit(is_child).alias("child"),
            F.lit(1 - is_child).alias("parent"),
        )

    both = []
    for fk in keys:
        label = f"{fk.child}.{fk.child_column}"
        both.append(side(tables[fk.child], fk.child_column, label, 1))
        both.append(side(tables[fk.parent], fk.parent_column, label, 0))
    met = _union(both).groupBy("label", "key").agg(F.sum("child").alias("children"), F.max("parent").alias("parent"))
    counted = met.groupBy("label").agg(
        F.sum("children").alias("rows"),
        F.sum(F.when(F.col("parent") == 0, F.col("children")).otherwise(0)).alias("bad"),
    )
    return counted.select(
        F.lit(RELATIONS).alias("table_name"),
        "rows",
        F.inline(F.array(_check("orphan_key", F.col("label"), ISSUE, F.col("bad")))),
    )


def owner_mismatch(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Item rows whose customer is not the customer of their order."""
    order_type = _common_type((items, "order_id"), (orders, "order_id"))
    user_type = _common_type((items, "user_id"), (orders, "user_id"))
    tie_break = ["created_at", "user_id"] if "created_at" in orders.columns else ["user_id"]
    owners = first_per_key(orders.select("order_id", *tie_break), "order_id", tie_break).select(
        F.col("order_id").cast(order_type), F.col("user_id").cast(user_type).alias("owner")
    )
    claims = items.groupBy(
        F.col("order_id").cast(order_type).alias("order_id"), F.col("user_id").cast(user_type).alias("user_id")
    ).agg(F.count("*").alias("n"))
    counted = claims.join(owners, "order_id", "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(F.col("owner") != F.col("user_id"), F.col("n"))), F.lit(0)).alias("bad"),
    )
    return counted.select(
        F.lit(RELATIONS).alias("table_name"),
        "rows",
        F.inline(F.array(_check("owner_mismatch", F.lit("order_items.user_id"), ISSUE, F.col("bad")))),
    )


def reference_checks(tables: Tables) -> list[DataFrame]:
    def has(table: str, *columns: str) -> bool:
        return table in tables and all(c in tables[table].columns for c in columns)

    checkable = [fk for fk in FOREIGN_KEYS if has(fk.child, fk.child_column) and has(fk.parent, fk.parent_column)]
    checks = [orphans(tables, checkable)] if checkable else []
    if has("order_items", "order_id", "user_id") and has("orders", "order_id", "user_id"):
        checks.append(owner_mismatch(tables["order_items"], tables["orders"]))
    return checks


# --- records ----------------------------------------------------------------


def record_checks(counts: dict[str, DataFrame]) -> DataFrame:
    """Records that do not fit their table's columns, from (rows, n_bad) per table that was read as text."""
    checks = F.array(_check("malformed_record", F.lit(None), WARNING, F.col("n_bad")))
    return _union([df.select(F.lit(t).alias("table_name"), "rows", F.inline(checks)) for t, df in counts.items()])


# --- reports ----------------------------------------------------------------


def missing_tables(tables: Tables, required: list[str] = RAW_TABLES) -> list[str]:
    return [t for t in required if t not in tables]


def all_checks(tables: Tables, required: list[str] = RAW_TABLES) -> DataFrame:
    """Check rows with the row count they refer to."""
    spark = next(iter(tables.values())).sparkSession
    frames = [table_checks(tables), *reference_checks(tables)]
    frames += [
        spark.range(1).select(
            F.lit(t).alias("table_name"),
            F.lit(0).cast("bigint").alias("rows"),
            F.inline(F.array(_check("missing_table", F.lit(None), ISSUE, F.lit(1)))),
        )
        for t in missing_tables(tables, required)
    ]
    return _union(frames)


def quality_report(
    tables: Tables, required: list[str] = RAW_TABLES, records: dict[str, DataFrame] | None = None
) -> DataFrame:
    """All check rows of a table set; `records` as in `record_checks`."""
    checks = all_checks(tables, required)
    return finish(checks.unionByName(record_checks(records)) if records else checks)


def passed(report: DataFrame) -> bool:
    return report.filter((F.col("severity") == ISSUE) & (F.col("n_bad") > 0)).isEmpty()


def only(checks: DataFrame, *names: str) -> DataFrame:
    return finish(checks.filter(F.col("check_name").isin(*names)))


def row_counts(tables: Tables) -> DataFrame:
    return _union(
        [
            df.agg(F.count("*").alias("row_count")).select(
                F.lit(t).alias("table_name"), "row_count", (F.col("row_count") == 0).alias("is_empty")
            )
            for t, df in tables.items()
        ]
    )


def required_columns(tables: Tables) -> DataFrame:
    """One row per missing required column, with the rows it concerns."""
    frames = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(t).alias("table_name"), F.explode(F.array(*[F.lit(c) for c in missing])).alias("column_name"), "row_count"
        )
        for t, df in tables.items()
        if (missing := missing_columns(t, df))
    ]
    if not frames:
        spark = next(iter(tables.values())).sparkSession
        return spark.createDataFrame([], "table_name string, column_name string, row_count bigint")
    return _union(frames)


def summary(tables: Tables, required: list[str] = RAW_TABLES) -> DataFrame:
    """Per table: rows, columns, failed issues, raised warnings, status."""
    failed = F.col("n_bad") > 0
    conflicts = F.max((F.col("check_name") == "conflicting_key") & failed)
    repeated = F.count_if((F.col("check_name") == "duplicate_key") & failed)
    widths = F.create_map(*chain.from_iterable((F.lit(t), F.lit(len(df.columns))) for t, df in tables.items()))
    return (
        all_checks(tables, required)
        .groupBy("table_name")
        .agg(
            F.max(F.when(F.col("table_name") == RELATIONS, 0).otherwise(F.col("rows"))).alias("row_count"),
            F.count_if(failed & (F.col("severity") == ISSUE)).alias("issues"),
            # Repeats of conflicting keys are part of that issue, not a warning of their own.
            (
                F.count_if(failed & (F.col("severity") == WARNING)) - F.when(conflicts, repeated).otherwise(F.lit(0))
            ).alias("warnings"),
        )
        .select(
            "table_name",
            "row_count",
            F.coalesce(F.try_element_at(widths, F.col("table_name")), F.lit(0)).cast("bigint").alias("column_count"),
            "issues",
            "warnings",
            F.when(F.col("issues") == 0, "PASS").otherwise("FAIL").alias("status"),
        )
    )
