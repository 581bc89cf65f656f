"""Small tables for the training-data tests, stored as Parquet so that rows have places."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

from shopsight.sources.scratch import materialize

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Columns whose names clash with those that operators use inside.
EXTRA = "node bigint, key string, row_index bigint, file_path string, `range` int, score double"


def documents(spark: SparkSession, texts: list, extra: bool = False, repeat: bool = False) -> DataFrame:
    """Documents from texts or (doc_id, text) pairs, languages and sources by turns."""
    pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    rows = [(d, t, ("en", "fr", None)[i % 3], f"s{i % 2}" if i % 5 else None, len(t or "")) for i, (d, t) in enumerate(pairs)]
    df = spark.createDataFrame(rows * (2 if repeat else 1), DOCUMENT)
    if extra:
        names = [f.strip().split() for f in EXTRA.split(", ")]
        df = df.selectExpr("*", *[f"cast('7' as {kind}) as {name}" for name, kind in names])
    return materialize(df.coalesce(1), "test-documents")


def sentence(random_: random.Random, n: int) -> str:
    return " ".join("".join(random_.choice("abcdefghij") for _ in range(random_.randint(1, 4))) for _ in range(n))


# Null, empty, blank, one word, non-ASCII, control characters, very long.
ODD = [None, "", " ", "\n\t \x0b", "Word", "É à ß 日本語 ÀB", "a\x00b\x7fc", "x" * 5000, "word " * 20000, "tie tie tie", "tie tie tie"]


def rows(df: DataFrame) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.collect()]


def by_id(df: DataFrame) -> dict:
    return {r["doc_id"]: r for r in rows(df)}
