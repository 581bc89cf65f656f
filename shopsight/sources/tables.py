"""Reading raw tables: Parquet if present, else CSV."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopsight.contracts import NULL_WORDS, RAW_TABLES
from shopsight.sources import catalog, paths
from shopsight.sources.scratch import materialize

FORMATS = ("parquet", "csv")
MALFORMED = "_malformed"


def detect_format(spark: SparkSession, table: str, raw_dir: str) -> str | None:
    for fmt in FORMATS:
        if paths.exists(spark, paths.join(raw_dir, f"{table}.{fmt}")):
            return fmt
    return None


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, multi_line: bool = False, malformed: str | None = None) -> DataFrame:
    """Every column as text: no inference pass, the cleaners parse. NULL_WORDS become NULL.

    `multi_line` reads quoted line breaks; files can then not be split over tasks. `malformed` names a further
    column with the text of a record that has too few or too many fields, else NULL. Such a record is read as
    far as it goes: missing fields are NULL, surplus ones are left out.
    """
    options = {"header": True, "inferSchema": False, "escape": '"', "multiLine": multi_line}
    names = spark.read.options(**options).csv(path).columns
    reader = spark.read.options(**options)
    if malformed:
        schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, malformed]])
        # Without this only the columns that a query asks for would be parsed, and no field would be missed.
        reader = reader.schema(schema).options(columnNameOfCorruptRecord=malformed, mode="PERMISSIVE", columnPruning=False)
    text = reader.csv(path)
    plain = [F.when(~F.col(c).isin(*NULL_WORDS), F.col(c)) for c in (catalog.quoted(n) for n in names)]
    return text.select(*plain, *([F.col(catalog.quoted(malformed))] if malformed else [])).toDF(*text.columns)


def stored_csv(spark: SparkSession, path: str, label: str) -> tuple[DataFrame, DataFrame]:
    """A CSV table parsed once and stored: its rows, and (rows, n_bad), the records with too few or too many fields."""
    stored = materialize(read_csv(spark, path, malformed=MALFORMED), label)
    return stored.drop(MALFORMED), stored.agg(F.count("*").alias("rows"), F.count(MALFORMED).alias("n_bad"))


def load_table(spark: SparkSession, table: str, raw_dir: str, multi_line: bool = False) -> DataFrame:
    fmt = detect_format(spark, table, raw_dir)
    if fmt is None:
        raise FileNotFoundError(f"Table '{table}' not found in {raw_dir} as Parquet or CSV.")
    path = paths.join(raw_dir, f"{table}.{fmt}")
    return read_parquet(spark, path) if fmt == "parquet" else read_csv(spark, path, multi_line)


def load_all_tables(
    spark: SparkSession, raw_dir: str, required: list[str] = RAW_TABLES, multi_line: bool = False
) -> dict[str, DataFrame]:
    """All required tables; one error names every missing one. `multi_line` as in `read_csv`."""
    if not paths.exists(spark, raw_dir):
        raise FileNotFoundError(f"Raw data directory does not exist: {raw_dir}")
    missing = [t for t in required if detect_format(spark, t, raw_dir) is None]
    if missing:
        raise FileNotFoundError(f"Required tables missing in {raw_dir}: {', '.join(missing)}")
    return {t: load_table(spark, t, raw_dir, multi_line) for t in required}


def has_complete_inputs(spark: SparkSession, raw_dir: str, required: list[str] = RAW_TABLES) -> bool:
    return all(detect_format(spark, t, raw_dir) is not None for t in required)


def input_inventory(spark: SparkSession, raw_dir: str, required: list[str] = RAW_TABLES) -> DataFrame:
    """Per required table: stored format, row count, and whether the set is complete."""
    complete = has_complete_inputs(spark, raw_dir, required)

    def entry(table: str) -> DataFrame:
        fmt = detect_format(spark, table, raw_dir)
        if fmt is None:
            counted = spark.range(1).select(F.lit(0).cast("bigint").alias("row_count"))
        else:
            counted = load_table(spark, table, raw_dir).agg(F.count("*").alias("row_count"))
        return counted.select(
            F.lit(table).alias("table_name"),
            F.lit(fmt or "none").alias("format"),
            "row_count",
            F.lit(complete).alias("complete"),
        )

    return reduce(DataFrame.unionByName, [entry(t) for t in required])
