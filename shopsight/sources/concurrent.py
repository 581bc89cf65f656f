"""Independent Spark jobs side by side.

A single job of a run rarely fills a cluster, and never the time the driver
spends planning. Independent ones are submitted from threads.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import SparkSession
from pyspark.util import inheritable_thread_target

T = TypeVar("T")


def run_all(spark: SparkSession, tasks: Mapping[str, Callable[[], T]], threads: int = 8) -> dict[str, T]:
    """Results by name; the first failure is raised once all have ended."""
    with ThreadPoolExecutor(max_workers=threads) as pool:
        futures = {name: pool.submit(inheritable_thread_target(spark)(task)) for name, task in tasks.items()}
    return {name: future.result() for name, future in futures.items()}
