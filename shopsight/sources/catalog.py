"""Named tables and SQL text."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsight.sources import paths

SQL_DIR = Path(__file__).resolve().parent.parent / "sql"


def register(tables: dict[str, DataFrame], persistent: bool = False) -> list[str]:
    """Register every table under its name, replacing old ones.

    All plans are resolved before the first name changes, so a bad table leaves
    the catalog as it was. Persistent tables, which later sessions of the same
    catalog can read, are all written under other names first and then exchanged;
    a failure on the way restores the old ones.
    """
    for df in tables.values():
        df.schema  # noqa: B018 - resolves the plan
    if persistent:
        _register_persistent(tables)
    else:
        for name, df in tables.items():
            df.createOrReplaceTempView(quoted(name))
    return list(tables)


def _register_persistent(tables: dict[str, DataFrame]) -> None:
    """Write all tables, then exchange names; a failure gives every name its old table back."""
    token = uuid.uuid4().hex
    names = {name: (f"{name}_{token}_new", f"{name}_{token}_old") for name in tables}
    spark = next(iter(tables.values())).sparkSession
    undo: list[Callable[[], None]] = []

    def rename(old: str, new: str) -> None:
        spark.sql(f"ALTER TABLE {quoted(old)} RENAME TO {quoted(new)}")
        undo.append(lambda: spark.sql(f"ALTER TABLE {quoted(new)} RENAME TO {quoted(old)}"))

    try:
        for name, df in tables.items():
            df.write.saveAsTable(quoted(names[name][0]))
        held = {t.name for t in spark.catalog.listTables() if not t.isTemporary}
        for name, (new, old) in names.items():
            if name.lower() in held:
                rename(name, old)
            rename(new, name)
    except BaseException:
        for step in reversed(undo):
            step()
        for new, _ in names.values():
            spark.sql(f"DROP TABLE IF EXISTS {quoted(new)}")
        raise
    for _, old in names.values():
        spark.sql(f"DROP TABLE IF EXISTS {quoted(old)}")


def open_tables(spark: SparkSession, folder: str) -> list[str]:
    """Register the tables stored in a folder, one Parquet table per name, in this session.

    All are resolved before the first view changes, so a broken folder leaves the session as it was.
    """
    names = [name.removesuffix(".parquet") for name, _ in paths.children(spark, folder) if name.endswith(".parquet")]
    if not names:
        raise FileNotFoundError(f"No stored tables in {folder}.")
    return register({name: spark.read.parquet(paths.join(folder, f"{name}.parquet")) for name in names})


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def run_query(spark: SparkSession, text: str, args: dict | None = None) -> DataFrame:
    return spark.sql(text, args=args) if args else spark.sql(text)


def sql_text(name: str, folder: str | Path = SQL_DIR) -> str:
    path = Path(folder) / (name if name.endswith(".sql") else f"{name}.sql")
    if not path.exists():
        raise FileNotFoundError(f"SQL file not found: {path}")
    return path.read_text()


def run_sql_file(spark: SparkSession, name: str, folder: str | Path = SQL_DIR) -> DataFrame:
    return run_query(spark, sql_text(name, folder))


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(quoted(name))


def row_count(spark: SparkSession, name: str) -> int:
    return spark.table(quoted(name)).count()


def row_counts(spark: SparkSession, names: list[str]) -> DataFrame:
    counted = [
        spark.table(quoted(n)).agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
        for n in names
    ]
    return reduce(DataFrame.unionByName, counted)
