"""Exact deduplication as a stateful stream, in DataFrame operations only.

Each text is reduced to a fingerprint row: digest, length, stable identifier and
content locator (file and row number). Fingerprints are appended to a folder that
a streaming aggregation follows; its state is keyed by digest, kept on disk
(RocksDB), checkpointed in the shared folder and never expires, so batches that
arrive later meet everything seen before. State per digest: the smallest
identifier, its locator, and a count. Rows that hit an existing digest are then
compared byte for byte with the text behind the locator; should two texts ever
share a digest, they are told apart by their bytes.

Skew: the aggregation combines before its shuffle, and the joins on digest are
plain sort-merge joins that adaptive execution splits.

Defined cases: a null text is the empty text; a null identifier counts as larger
than any other; among rows with equal identifiers the first by locator stays, so
one row of every group stays; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsight.llm.common import file_backed, located, without
from shopsight.sources import paths
from shopsight.sources.scratch import materialize, new_path

# A run of two or more blanks, or one blank other than a space: what has to change.
BLANKS = r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]"
DISK_STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
KEY = ["text_sha256", "n_bytes"]


def normalised(text: str) -> Column:
    """The text with every run of blanks as one space; null is empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), BLANKS, " ")


def fingerprints(rows: DataFrame) -> DataFrame:
    clean = normalised("text")
    return rows.select(
        "doc_id",
        F.sha2(clean, 256).alias("text_sha256"),
        F.octet_length(clean).cast("long").alias("n_bytes"),
        "file_path",
        "row_index",
    )


def advance(spark: SparkSession, arrivals: str, state: str) -> DataFrame:
    """Feed the fingerprint files that are new in `arrivals` to the state; return the state.

    Rows: text_sha256, n_bytes, keep (unnamed, doc_id, file_path, row_index), group_size.
    """
    session = spark.newSession()  # its settings end with it
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", DISK_STATE)
    # Without this every state partition reserves several MB of disk ahead of need.
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    schema = spark.read.parquet(arrivals).schema
    identifier = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "file_path", "row_index")
    stream = session.readStream.schema(schema).parquet(arrivals)
    query = (
        stream.groupBy(*KEY)
        .agg(F.min(identifier).alias("keep"), F.count(F.lit(1)).alias("group_size"))
        .writeStream.outputMode("update")
        .format("noop")
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    kept = spark.read.format("statestore").load(state)
    return kept.select("key.*", F.col("value.min").alias("keep"), F.col("value.count").alias("group_size"))


def _is_keeper() -> Column:
    return (F.col("file_path") == F.col("keep.file_path")) & (F.col("row_index") == F.col("keep.row_index"))


def _different_bytes(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """Rows of a group whose bytes are not those of the row that the state points to."""
    shared = decided.where("group_size > 1").select(*KEY, "file_path", "row_index", _is_keeper().alias("keeper"))
    texts = rows.select("doc_id", "file_path", "row_index", normalised("text").alias("clean"))
    hits = materialize(texts.join(shared, ["file_path", "row_index"]), "exact-hits")
    kept = hits.where("keeper").select(*KEY, F.col("clean").alias("kept_clean"))
    return hits.where("not keeper").join(kept, KEY).where("clean <> kept_clean").drop("kept_clean", "keeper")


def _told_apart(decided: DataFrame, different: DataFrame) -> DataFrame:
    """Decisions with the rows of `different` grouped by their own bytes."""
    identifier = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "file_path", "row_index")
    groups = different.groupBy(*KEY, "clean").agg(F.min(identifier).alias("own"), F.count(F.lit(1)).alias("own_size"))
    own = different.join(groups, [*KEY, "clean"]).select("file_path", "row_index", "own", "own_size")
    less = different.groupBy(*KEY).agg(F.count(F.lit(1)).alias("less"))
    both = decided.join(own, ["file_path", "row_index"], "left").join(less, KEY, "left")
    rest = F.col("group_size") - F.coalesce("less", F.lit(0))
    return both.withColumns({"keep": F.coalesce("own", "keep"), "group_size": F.coalesce("own_size", rest)}).drop(
        "own", "own_size", "less"
    )


def find_copies(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, file_path, row_index."""
    spark = docs.sparkSession
    rows = located(file_backed(docs), "doc_id", "text")
    arrivals = new_path(spark, "exact-arrivals")
    fingerprints(rows).write.parquet(arrivals)
    seen = advance(spark, arrivals, new_path(spark, "exact-state"))
    decided = spark.read.parquet(arrivals).join(seen, KEY)
    different = materialize(_different_bytes(rows, decided), "exact-different")
    if not different.isEmpty():
        decided = _told_apart(decided, different)
    return decided.select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        _is_keeper().alias("kept"),
        "text_sha256",
        "file_path",
        "row_index",
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    docs = file_backed(docs)
    return without(docs, find_copies(docs).where("not kept"))


class Deduplicator:
    """The same state across batches: `add` each new folder of documents, in any number of runs."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.arrivals = paths.join(folder, "arrivals")
        self.state = paths.join(folder, "state")

    def add(self, docs: DataFrame, batch: str | None = None) -> DataFrame:
        """Take in a batch and return the state over everything added so far.

        A batch counts once, however often it is added, so that a run that failed can be repeated. It is known by
        its name, by default a hash of its rows and their places.
        """
        rows = fingerprints(located(file_backed(docs), "doc_id", "text"))
        if batch is None:
            row = rows.agg(F.count("*").alias("n"), *[F.bit_xor(F.xxhash64(F.lit(i), *rows.columns)).alias(f"h{i}") for i in (1, 2)])
            batch = "-".join(str(v or 0) for v in row.first()).replace("--", "-n")
        folder = paths.join(self.arrivals, f"batch={batch}")
        if not paths.exists(self.spark, paths.join(folder, "_SUCCESS")):
            rows.write.mode("overwrite").parquet(folder)
        return advance(self.spark, self.arrivals, self.state)

    def decide(self, docs: DataFrame, everything: DataFrame) -> DataFrame:
        """The decisions on a batch that was added, as `find_copies` gives them.

        `everything` is a file-backed table of all documents added so far: the text behind the locator of a row's
        group is compared byte for byte, and rows that only share the digest are grouped by their own bytes.
        """
        seen = self.spark.read.format("statestore").load(self.state)
        seen = seen.select("key.*", F.col("value.min").alias("keep"), F.col("value.count").alias("group_size"))
        rows = located(file_backed(docs), "doc_id", "text")
        decided = materialize(fingerprints(rows).join(seen, KEY), "exact-decided")
        copies = decided.where(~_is_keeper()).select(*KEY, "file_path", "row_index", "keep")
        texts = rows.select("doc_id", "file_path", "row_index", normalised("text").alias("clean"))
        kept = located(everything, "text").select(
            F.struct("file_path", "row_index").alias("place"), normalised("text").alias("kept_clean")
        )
        hits = copies.join(texts, ["file_path", "row_index"])
        hits = hits.join(kept, F.struct("keep.file_path", "keep.row_index") == F.col("place"))
        different = materialize(hits.where("clean <> kept_clean").drop("kept_clean", "place", "keep"), "exact-different")
        if not different.isEmpty():
            decided = _told_apart(decided, different)
        return decided.select(
            "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size", _is_keeper().alias("kept"), "text_sha256", "file_path", "row_index"
        )
