"""Session settings the operators rely on."""

from __future__ import annotations

import os
import re

from pyspark.sql import SparkSession

# Calendar logic is UTC, arithmetic overflow is an error, and skewed shuffle
# partitions of a join are split at run time even where that costs another
# exchange.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Most bytes that one task reads, from a shuffle or from files: what it sorts or holds in hash tables follows from
# them, whatever the size of the tables. Compressed keys take some twenty times their bytes there.
MOST_BYTES = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20,
    "spark.sql.files.maxPartitionBytes": 16 << 20,
}
_UNITS = {"": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def _bytes(size: str) -> int:
    """A size as Spark writes it: 64MB, 16m, 67108864b."""
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)i?b?", size.strip().lower()).groups()
    return int(number) * _UNITS[unit]


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session someone else created; sizes are only lowered."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    for key, most in MOST_BYTES.items():
        if _bytes(spark.conf.get(key)) > most:
            spark.conf.set(key, f"{most}b")
    return spark


def local_session(app: str = "shopsight", cpus: str | int | None = None) -> SparkSession:
    """Single-machine session for tests and the benchmark."""
    cpus = cpus or os.cpu_count() or 4
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
