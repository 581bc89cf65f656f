"""Pieces shared by the training-data operators."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shopsight.sources.scratch import materialize

# Word bytes: digits, lower-case letters and every byte of a non-ASCII character.
_SEPARATORS = [b for b in range(0x80) if chr(b) not in string.digits + string.ascii_letters]
WORD_TABLE = bytes.maketrans(
    string.ascii_uppercase.encode() + bytes(_SEPARATORS), string.ascii_lowercase.encode() + b" " * len(_SEPARATORS)
)


def word_line(text: bytes | None) -> bytes:
    """Lower-cased words (letters, digits, non-ASCII) joined by single spaces; null is empty."""
    return b" ".join(text.translate(WORD_TABLE).split()) if text else b""


def token_line(text: bytes | None) -> bytes:
    """Lower-cased (A-Z) tokens between blanks, joined by single spaces; null is empty."""
    return b" ".join(text.lower().split()) if text else b""


def word_starts(line: bytes) -> np.ndarray:
    """Start of every word of a single-spaced line, and the end of the line plus one."""
    if not line:
        return np.zeros(1, np.int64)
    at = np.flatnonzero(np.frombuffer(line, np.uint8) == 32) + 1
    return np.concatenate([[0], at, [len(line) + 1]])


def utf8(column: str) -> Column:
    """A text column as bytes, so that Python never decodes it."""
    return F.col(column).cast("binary").alias(column)


def map_arrow(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | StructType
) -> DataFrame:
    """`mapInArrow` over single batches; None or an empty batch yields nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = function(batch)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores added while a column of `df` has it (whatever its case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_PLACE = ("file_path", "row_index")


def file_backed(df: DataFrame) -> DataFrame:
    """`df` if its rows have places in files, else a stored copy."""
    try:
        df.select(*[F.col(f"_metadata.{name}") for name in _PLACE])
        return df
    except AnalysisException:
        return materialize(df, "file-backed")


def located(df: DataFrame, *columns: str) -> DataFrame:
    """The columns and each row's place (file_path, row_index) of a file-backed table."""
    return df.select(*columns, *[F.col(f"_metadata.{name}").alias(name) for name in _PLACE])


def without(df: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of a file-backed table, all columns, but those at the places (file_path, row_index) in `gone`."""
    gone = materialize(gone.select(F.struct(*_PLACE).alias("_gone_place")), "gone")  # the planner sees its size
    here = df.select("*", F.struct(*[F.col(f"_metadata.{name}").alias(name) for name in _PLACE]).alias("_own_place"))
    left = here.join(gone, here["_own_place"] == gone["_gone_place"], "left_anti")
    return left.select(*[here[f"`{c}`"] for c in df.columns])


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of `edges` (a, b): rows (node, component), component = smallest node.

    Every round maps each node to its smallest neighbour, follows that mapping
    twice more, and contracts the graph; a component is done when it has shrunk
    to its smallest node. Rounds are stored, so nothing is recomputed and nothing
    is held on the driver. Nodes without an edge to another node are absent.
    Null ends and self links are ignored; repeated links count once.
    """
    edges = edges.select("a", "b").where("a <> b").distinct()
    edges = materialize(edges, label)
    mapping: DataFrame | None = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        smallest = both.groupBy("a").agg(F.min("b").alias("b"))
        step = materialize(smallest.select(F.col("a").alias("node"), F.least("a", "b").alias("to")), label)
        for _ in range(2):
            jump = step.select(F.col("node").alias("to"), F.col("to").alias("next"))
            step = materialize(step.join(jump, "to").select("node", F.col("next").alias("to")), label)
        first = step.select(F.col("node").alias("a"), F.col("to").alias("new_a"))
        second = step.select(F.col("node").alias("b"), F.col("to").alias("new_b"))
        moved = edges.join(first, "a").join(second, "b").where("new_a <> new_b")
        edges = materialize(
            moved.select(F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b")).distinct(), label
        )
        if mapping is None:
            mapping = step
        else:
            later = step.select(F.col("node").alias("to"), F.col("to").alias("later"))
            mapping = mapping.join(later, "to", "left").select("node", F.coalesce("later", "to").alias("to"))
            mapping = materialize(mapping, label)
    if mapping is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return mapping.select("node", F.col("to").alias("component"))
