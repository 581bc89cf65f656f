"""Intermediate tables that outlive executors.

Where a plan reads one intermediate result several times it is written once, as
Parquet, below the shared folder named by `spark.checkpoint.dir`. Readers then
prune columns, the planner knows its true size (so a broadcast is chosen only
when it fits), and a lost executor costs no recomputation.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsight.sources import paths

CHECKPOINT_DIR = "spark.checkpoint.dir"
RUN_FOLDER = "shopsight.run.folder"  # a property of the threads that work in it


def root(spark: SparkSession) -> str:
    """The shared folder; a private one only on a local session that names none."""
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError(f"Set {CHECKPOINT_DIR} to a folder that all executors share.")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="shopsight-"))
    return context.getCheckpointDir()


def new_path(spark: SparkSession, label: str) -> str:
    folder = spark.sparkContext.getLocalProperty(RUN_FOLDER) or root(spark)
    return paths.join(folder, f"{label}-{uuid.uuid4().hex}")


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """Intermediate tables of this block, of its threads too, go to one folder, deleted at its end.

    For work whose results are stored elsewhere or small: tables made inside cannot be read afterwards.
    """
    context, before = spark.sparkContext, spark.sparkContext.getLocalProperty(RUN_FOLDER)
    folder = new_path(spark, "run")
    context.setLocalProperty(RUN_FOLDER, folder)
    try:
        yield folder
    finally:
        context.setLocalProperty(RUN_FOLDER, before)
        paths.delete(spark, folder)


ROWS_PER_PART = 100_000


def materialize(df: DataFrame, label: str, spread_by: str | None = None) -> DataFrame:
    """Write `df` once and return the stored table.

    `spread_by` spreads the rows in key order over tasks of at most about
    ROWS_PER_PART rows, and over all cores at least, for readers that compute much
    per row (model training and scoring): a small table would otherwise end up in
    one file and one task. Their number is a multiple of the cores, so that no core
    waits for the last few.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    if spread_by is None:
        return stored
    cores = spark.sparkContext.defaultParallelism
    parts = cores * max(1, -(-stored.count() // (ROWS_PER_PART * cores)))
    # Hashing the key keeps the exchange where the plan is already partitioned by it.
    spread = stored.repartition(parts, F.xxhash64(spread_by)).sortWithinPartitions(spread_by)
    return materialize(spread, label)
