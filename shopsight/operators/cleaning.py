"""Cleaning of the raw tables.

Text that should be a date or a number becomes NULL when it does not parse.
NULL stays NULL: a missing label never turns into a word. Extra columns pass
through. Where a key repeats, the row with the earliest `created_at` stays, ties
going to the smallest row (`ranking.first_per_key`).

Cleaners call `tally` after each step that drops rows. By default it does nothing;
`Counts` observes the rows there, so that writing the cleaned table also says what was
dropped and why, by the cleaner's own predicates and without another read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shopsight.contracts import MAX_AGE
from shopsight.functions import parsing
from shopsight.operators.ranking import first_per_key
from shopsight.sources.concurrent import run_all
from shopsight.sources.scratch import materialize

ORDER_DATES = ["created_at", "returned_at", "shipped_at", "delivered_at"]
ITEM_DATES = ["created_at", "shipped_at", "delivered_at", "returned_at"]
ID_COLUMNS = ["id", "order_id", "user_id", "product_id"]
# Steps after which rows are counted; all but the first may drop some.
READ = "rows_in"
NULL_KEY, DUPLICATE, BAD_PRICE, BAD_DATE = REASONS = (
    "dropped_null_key", "dropped_duplicate", "dropped_bad_price", "dropped_bad_date",
)
AUDIT_COLUMNS = [READ, *REASONS, "rows_out"]


def _replace(df: DataFrame, changes: dict[str, Column]) -> DataFrame:
    return df.withColumns({c: e for c, e in changes.items() if c in df.columns})


def _typed(
    df: DataFrame, dates: list[str] = (), numbers: list[str] = (), labels: list[str] = (), lowered: list[str] = ()
) -> DataFrame:
    """Parse and trim in one projection; ids read as text become BIGINT."""
    types = {f.name: f.dataType for f in df.schema}
    changes: dict[str, Column] = {
        c: F.col(c).try_cast("bigint") for c in ID_COLUMNS if c in types and types[c].simpleString() == "string"
    }
    changes |= {c: parsing.timestamp(c, types[c]) for c in dates if c in types}
    changes |= {c: parsing.number(c, types[c]) for c in numbers if c in types}
    changes |= {c: parsing.label(c) for c in labels}
    changes |= {c: F.lower(parsing.label(c)) for c in lowered}
    return _replace(df, changes)


def drop_missing_key(df: DataFrame, *keys: str) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))


Tally = Callable[[DataFrame, str], DataFrame]


def untold(df: DataFrame, step: str) -> DataFrame:
    return df


def clean_users(df: DataFrame, tally: Tally = untold) -> DataFrame:
    typed = _typed(df, dates=["created_at"], numbers=["age"], labels=["gender", "country", "state", "city"])
    if "age" in typed.columns:
        typed = typed.withColumn("age", F.when(F.col("age").between(0, MAX_AGE), F.col("age")))
    keyed = tally(drop_missing_key(tally(typed, READ), "id"), NULL_KEY)
    return tally(first_per_key(keyed, "id"), DUPLICATE)


def clean_orders(df: DataFrame, tally: Tally = untold) -> DataFrame:
    typed = _typed(df, dates=ORDER_DATES, lowered=["status"])
    if dict(typed.dtypes).get("num_of_item") == "string":
        typed = typed.withColumn("num_of_item", F.col("num_of_item").try_cast("bigint"))
    keyed = tally(drop_missing_key(tally(typed, READ), "order_id", "user_id"), NULL_KEY)
    unique = tally(first_per_key(keyed, "order_id"), DUPLICATE)
    return tally(unique.filter(F.col("created_at").isNotNull()), BAD_DATE)


def clean_order_items(df: DataFrame, tally: Tally = untold) -> DataFrame:
    """Items are not deduplicated."""
    typed = _typed(df, dates=ITEM_DATES, numbers=["sale_price"], lowered=["status"])
    priced = tally(tally(typed, READ).filter(F.col("sale_price") >= 0), BAD_PRICE)
    return tally(drop_missing_key(priced, "order_id", "user_id", "product_id"), NULL_KEY)


def clean_products(df: DataFrame, tally: Tally = untold) -> DataFrame:
    typed = _typed(df, numbers=["cost", "retail_price"], labels=["name", "category", "brand", "department"])
    keyed = tally(drop_missing_key(tally(typed, READ), "id"), NULL_KEY)
    return tally(first_per_key(keyed, "id"), DUPLICATE)


def clean_events(df: DataFrame, tally: Tally = untold) -> DataFrame:
    typed = _typed(df, dates=["created_at"], lowered=["event_type"])
    return tally(drop_missing_key(tally(typed, READ), "user_id"), NULL_KEY)


def clean_inventory_items(df: DataFrame, tally: Tally = untold) -> DataFrame:
    return tally(_typed(df, dates=["created_at", "sold_at"], numbers=["cost"]), READ)


def clean_centers(df: DataFrame, tally: Tally = untold) -> DataFrame:
    return tally(_typed(df, numbers=["latitude", "longitude"]), READ)


CLEANERS: dict[str, Callable[[DataFrame, Tally], DataFrame]] = {
    "users": clean_users,
    "orders": clean_orders,
    "order_items": clean_order_items,
    "products": clean_products,
    "events": clean_events,
    "inventory_items": clean_inventory_items,
    "distribution_centers": clean_centers,
}


def clean_all(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Clean every table that has a cleaner; the others pass through."""
    return {t: CLEANERS[t](df) if t in CLEANERS else df for t, df in tables.items()}


# --- audit ------------------------------------------------------------------


class Counts:
    """A tally: row counts after each step, taken while the cleaned table is written."""

    def __init__(self) -> None:
        self.steps: list[str] = []
        self.observations: list[Observation] = []

    def __call__(self, df: DataFrame, step: str) -> DataFrame:
        self.steps.append(step)
        self.observations.append(Observation(f"{step}-{uuid.uuid4().hex}"))
        return df.observe(self.observations[-1], F.count(F.lit(1)).alias("n"))

    def row(self) -> dict[str, int]:
        """The audit columns; waits for the write. Each step's loss is its count less that of the step before."""
        counts = [o.get["n"] for o in self.observations]
        lost = {step: before - after for step, before, after in zip(self.steps[1:], counts, counts[1:])}
        return {READ: counts[0], **{reason: lost.get(reason, 0) for reason in REASONS}, "rows_out": counts[-1]}


def store_cleaned(
    table: str, df: DataFrame, write: Callable[[DataFrame], DataFrame]
) -> tuple[DataFrame, dict[str, int]]:
    """Clean a table and `write` it, which returns the stored table; with its audit columns, from the same pass.

    Tasks repeated after a lost executor can be observed twice. The rows stored say whether that has happened, and
    the counts are then taken from a pass of their own.
    """
    counts = Counts()
    stored = write(CLEANERS[table](df, counts))
    row = counts.row()
    if row["rows_out"] != stored.count():
        counts = Counts()
        CLEANERS[table](df, counts).write.format("noop").mode("overwrite").save()
        row = counts.row()
    return stored, row


def audit_table(rows: dict[str, dict[str, int]], spark: SparkSession) -> DataFrame:
    """Rows in, rows dropped per reason and rows out, per table."""
    schema = "table_name string, " + ", ".join(f"{c} bigint" for c in AUDIT_COLUMNS)
    return spark.createDataFrame([(t, *[row[c] for c in AUDIT_COLUMNS]) for t, row in rows.items()], schema)


def cleaning_audit(raw: dict[str, DataFrame]) -> DataFrame:
    """The audit of all tables, each cleaned and written once."""
    spark = next(iter(raw.values())).sparkSession
    jobs = {t: lambda t=t: store_cleaned(t, raw[t], lambda df: materialize(df, t)) for t in raw if t in CLEANERS}
    return audit_table({t: row for t, (_, row) in run_all(spark, jobs).items()}, spark)
