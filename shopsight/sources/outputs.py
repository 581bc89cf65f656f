"""Writing results so that readers see either the old set or the new one.

A set (outputs, and what belongs to them, such as a model) is written and checked in
a staging folder. The small file `COMMIT`, which appears in one step, then names every
staged path and its target: from that moment the new set holds. Moving the paths into
place is only housekeeping. Until it is done, readers find a path where the commit
says that it is (`located`), and whoever opens the folder next finishes a move that a
lost process has left (`finish`). A failed move takes everything back, the commit
last. Readers of this module see the old set or the new one at any time; programs that
read the paths on their own can meet both while a publisher is moving them.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from shopsight.contracts import OUTPUTS, OutputContract
from shopsight.sources import paths
from shopsight.sources.concurrent import run_all

STATUS_SCHEMA = "output string, status string, row_count bigint"
READ_ERRORS = (PySparkException, Py4JJavaError)
COMMIT = "_commit.json"
LOOKUP_KEY = "customer_id"
STAGING = "_staging"
STALE_DAYS = 7  # staging folders this old belong to nobody


def save_parquet(df: DataFrame, path: str) -> None:
    """Write beside the target, then swap: a failed job leaves the old data."""
    spark = df.sparkSession
    staged = f"{path}.staged-{uuid.uuid4().hex}"
    df.write.parquet(staged)
    swap(spark, staged, path)


def save_for_lookups(df: DataFrame, path: str, key: str = LOOKUP_KEY) -> None:
    """Write a table from which single keys are read.

    All rows of a key lie together in one sorted file, whose row groups carry bloom filters of the key: a reader
    who asks for one key opens the row group that has it, and from the others only their filters.
    """
    laid_out = df.repartition(key).sortWithinPartitions(key)
    options = {f"parquet.bloom.filter.enabled#{key}": "true", "parquet.bloom.filter.adaptive.enabled": "true"}
    laid_out.write.options(**options).parquet(path)


def load_parquet(spark: SparkSession, path: str) -> DataFrame:
    path = located(spark, path)
    if not paths.exists(spark, path):
        raise FileNotFoundError(f"Parquet data not found: {path}")
    return spark.read.parquet(path)


def load_output(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored table, or None if it is missing, unreadable or empty."""
    try:
        df = load_parquet(spark, path)
        return None if df.isEmpty() else df
    except (FileNotFoundError, *READ_ERRORS):
        return None


def swap(spark: SparkSession, staged: str, target: str) -> None:
    """Put a staged path in place of its target; a failure leaves the target as it was."""
    backup = f"{target}.backup-{uuid.uuid4().hex}"
    held = paths.exists(spark, target)
    if held:
        paths.rename(spark, target, backup)
    try:
        paths.rename(spark, staged, target)
    except Exception:
        if held:
            paths.rename(spark, backup, target)
        raise
    paths.delete(spark, backup)


class Move(NamedTuple):
    """A path of a committed set: where it was staged, where it goes, where the old one waits."""

    staged: str
    target: str
    backup: str


def pending(spark: SparkSession, folder: str) -> list[Move]:
    """The moves of a commit that is not finished."""
    text = paths.read_text(spark, paths.join(folder, COMMIT))
    return [Move(*move) for move in json.loads(text)] if text else []


def located(spark: SparkSession, path: str, folder: str | None = None) -> str:
    """Where the current content of `path` is; `folder` holds the commit, by default the path's own folder."""
    for move in pending(spark, folder or paths.parent(path)):
        if move.target == path and paths.exists(spark, move.staged):
            return move.staged
    return path


def commit(spark: SparkSession, folder: str, moves: list[Move]) -> None:
    """Make the staged paths the current ones; on a failure the old ones are current again."""
    finish(spark, folder)
    paths.write_new(spark, paths.join(folder, COMMIT), json.dumps(moves))
    try:
        finish(spark, folder)
    except Exception:
        _take_back(spark, folder, moves)
        raise


def finish(spark: SparkSession, folder: str) -> None:
    """Carry out what is left of a commit; every step can be repeated."""
    moves = pending(spark, folder)
    if not moves:
        return
    for move in moves:
        if paths.exists(spark, move.staged):
            if paths.exists(spark, move.target):
                paths.rename(spark, move.target, move.backup)
            paths.rename(spark, move.staged, move.target)
    paths.delete(spark, paths.join(folder, COMMIT))
    for move in moves:
        paths.delete(spark, move.backup)


def _take_back(spark: SparkSession, folder: str, moves: list[Move]) -> None:
    """The new set stays current, wherever its paths are, until the old one is whole again and the commit goes."""
    for move in reversed(moves):
        if not paths.exists(spark, move.staged):
            paths.rename(spark, move.target, move.staged)
        if paths.exists(spark, move.backup):
            paths.rename(spark, move.backup, move.target)
    paths.delete(spark, paths.join(folder, COMMIT))


def schema_problems(name: str, schema: T.StructType, contract: OutputContract) -> list[str]:
    types = {f.name: f.dataType for f in schema}
    problems = [f"missing column {c}" for c in contract.required if c not in types]
    numeric = list(contract.numeric)
    if name == "cohort_retention":
        months = [c for c in types if c.isdigit()]
        if not months:
            problems.append("no numeric retention-month column")
        numeric += months
    problems += [
        f"column {c} is not numeric" for c in numeric if c in types and not isinstance(types[c], T.NumericType)
    ]
    return problems


def output_status(
    spark: SparkSession, name: str, path: str, contract: OutputContract
) -> tuple[str, str, int | None]:
    path = located(spark, path)
    if not paths.exists(spark, path):
        return name, "missing", None
    try:
        df = spark.read.parquet(path)
        rows = df.count()
    except READ_ERRORS:
        return name, "unreadable", None
    if rows == 0:
        return name, "empty", 0
    return name, "schema_mismatch" if schema_problems(name, df.schema, contract) else "ready", rows


def validate_outputs(
    spark: SparkSession, output_dir: str, contracts: Mapping[str, OutputContract] = OUTPUTS
) -> DataFrame:
    """One row per output: missing, unreadable, empty, schema_mismatch or ready."""
    rows = [output_status(spark, n, paths.join(output_dir, c.path), c) for n, c in contracts.items()]
    return spark.createDataFrame(rows, STATUS_SCHEMA)


class Staging:
    """A complete output set on its way to `output_dir`.

    Each output is written once, when it is ready, and can be read back by later
    stages. `publish` checks the whole set against its contracts and commits it;
    until then, and after any failure, readers see the previous set. `attach` adds
    paths outside the set, written beside their targets, to the same commit.
    """

    def __init__(self, spark: SparkSession, output_dir: str, contracts: Mapping[str, OutputContract] = OUTPUTS):
        self.spark = spark
        self.output_dir = output_dir
        self.contracts = contracts
        self.path = paths.join(output_dir, STAGING, uuid.uuid4().hex)
        self.written: set[str] = set()
        self.attached: dict[str, str] = {}

    def __enter__(self) -> Staging:
        finish(self.spark, self.output_dir)
        paths.make_dirs(self.spark, self.path)
        oldest = (time.time() - STALE_DAYS * 86400) * 1000
        for name, changed in paths.children(self.spark, paths.parent(self.path)):
            if changed < oldest:
                paths.delete(self.spark, paths.join(paths.parent(self.path), name))
        return self

    def __exit__(self, *_: object) -> None:
        """Leaves nothing behind, unless it is committed and not yet moved."""
        if not any(move.staged.startswith(self.path) for move in pending(self.spark, self.output_dir)):
            for path in [self.path, *self.attached.values()]:
                paths.delete(self.spark, path)

    def attach(self, target: str, staged: str | None = None) -> str:
        """A path, by default beside `target`, that `publish` puts in the target's place; written before."""
        return self.attached.setdefault(target, staged or f"{target}.staged-{uuid.uuid4().hex}")

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """Stage one output and return the stored table."""
        if name not in self.contracts:
            raise ValueError(f"Output set does not match its contract: unexpected={[name]}")
        path = paths.join(self.path, self.contracts[name].path)
        save_for_lookups(df, path) if LOOKUP_KEY in df.columns else df.write.parquet(path)
        self.written.add(name)
        return self.spark.read.schema(df.schema).parquet(path)

    def publish(self) -> DataFrame:
        """Check and commit the set; returns its status rows."""
        missing = sorted(set(self.contracts) - self.written)
        if missing:
            raise ValueError(f"Output set does not match its contract: missing={missing}")
        checked = run_all(
            self.spark,
            {
                n: lambda n=n, c=c: output_status(self.spark, n, paths.join(self.path, c.path), c)
                for n, c in self.contracts.items()
            },
        )
        statuses = list(checked.values())
        empty = [name for name, status, _ in statuses if status == "empty"]
        if empty:
            raise ValueError(f"Refusing to publish empty outputs: {', '.join(empty)}")
        invalid = [f"{name} ({status})" for name, status, _ in statuses if status != "ready"]
        if invalid:
            raise ValueError(f"Staged outputs failed validation: {', '.join(invalid)}")
        places = {paths.join(self.output_dir, c.path): paths.join(self.path, c.path) for c in self.contracts.values()}
        token = uuid.uuid4().hex
        moves = [Move(staged, target, f"{target}.backup-{token}") for target, staged in (places | self.attached).items()]
        commit(self.spark, self.output_dir, moves)
        return self.spark.createDataFrame(statuses, STATUS_SCHEMA)


def publish_outputs(
    outputs: Mapping[str, DataFrame], output_dir: str, contracts: Mapping[str, OutputContract] = OUTPUTS
) -> DataFrame:
    """Stage, check and commit a complete set of DataFrames."""
    if set(outputs) != set(contracts):
        raise ValueError(
            f"Output set does not match its contract: missing={sorted(set(contracts) - set(outputs))}, "
            f"unexpected={sorted(set(outputs) - set(contracts))}"
        )
    spark = next(iter(outputs.values())).sparkSession
    with Staging(spark, output_dir, contracts) as staging:
        run_all(spark, {n: lambda n=n, df=df: staging.write(n, df) for n, df in outputs.items()})
        return staging.publish()


def regenerate(
    builders: Mapping[str, Callable[[], DataFrame]],
    output_dir: str,
    contracts: Mapping[str, OutputContract] = OUTPUTS,
) -> dict[str, Exception]:
    """Rebuild single outputs; a failure is collected and the rest still runs."""
    failures: dict[str, Exception] = {}
    for name, build in builders.items():
        try:
            built = build()
            finish(built.sparkSession, output_dir)
            save_parquet(built, paths.join(output_dir, contracts[name].path))
        except Exception as error:
            failures[name] = error
    return failures


def export_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    present = [c for c in columns if c in df.columns]
    df.select(*present).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
