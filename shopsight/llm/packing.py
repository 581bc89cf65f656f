"""Conflict-constrained best-fit packing of documents into training sequences.

A sequence (bin) holds `CAPACITY` tokens, at most one document of any source and
at most one of any duplicate cluster. Documents are placed by falling length. Bins
are kept in order of what they have left and carry bitmaps of the sources and
clusters they hold; the search starts at the tightest bin that is large enough and
goes on to its successors until one without a conflict is found; without one, a bin
is opened. Longer documents are cut into full pieces and a rest; all are placed.

The cluster of a document is that of its text up to blanks, or the one given for its
place in `clusters`, for example its component of near duplicates.

Documents are dealt into groups of about `GROUP_PIECES` pieces by a hash, packed
independently: memory and time per task are bounded whatever the table's size, a
hot source or cluster is spread over all groups, and only narrow rows (no text) are
shuffled. Bins do not cross groups.

Defined cases: a document of no words is one piece of the end marker alone; a null
source is in conflict with nothing; ties go to the smaller identifier (null last),
then piece; repeated rows are documents of one cluster; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsight.llm.common import file_backed, located
from shopsight.llm.exact_dedup import normalised
from shopsight.sources.scratch import materialize

CAPACITY = 2048
GROUP_PIECES = 4096
TOKEN = r"[^\x20\x09-\x0D]+"

PACKED = (
    "doc_id long, piece long, n_pieces long, first_token long, n_tokens long, bin_id long, bin_offset long, "
    "file_path string, row_index long"
)


def token_count(text: str = "text") -> Column:
    """Words of the text and an end marker."""
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(TOKEN)).cast("long") + 1


def pack(lengths: list[int], sources: list, clusters: list, capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each item; items come in the order in which they are to be placed.

    None as source or cluster is in conflict with nothing. No length exceeds the capacity.
    """
    numbers: dict[tuple[str, object], int] = {}

    def bit(kind: str, value: object) -> int:
        return 0 if value is None else 1 << numbers.setdefault((kind, value), len(numbers))

    left: list[tuple[int, int]] = []  # (tokens left, bin), ascending
    held: list[int] = []  # by bin: bitmap of its sources and clusters
    placed = []
    for length, source, cluster in zip(lengths, sources, clusters):
        mask = bit("source", source) | bit("cluster", cluster)
        at = bisect_left(left, (length, -1))
        while at < len(left) and held[left[at][1]] & mask:
            at += 1
        if at < len(left):
            room, number = left.pop(at)
            held[number] |= mask
        else:
            room, number = capacity, len(held)
            held.append(mask)
        placed.append((number, capacity - room))
        if room > length:
            insort(left, (room - length, number))
    return placed


def pieces(
    docs: DataFrame, capacity: int = CAPACITY, length: Column | None = None, clusters: DataFrame | None = None
) -> DataFrame:
    """One narrow row per piece of every document, stored."""
    rows = located(file_backed(docs), "doc_id", "text", "source")
    narrow = rows.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.xxhash64(normalised("text")).alias("cluster"),
        (token_count() if length is None else length).alias("total"),
        "file_path",
        "row_index",
    )
    if clusters is not None:
        given = clusters.select("file_path", "row_index", F.xxhash64(F.lit("given"), "cluster").alias("given"))
        narrow = narrow.join(given, ["file_path", "row_index"], "left")
        narrow = narrow.withColumn("cluster", F.coalesce("given", "cluster")).drop("given")
    last = F.expr(f"greatest(cast((total - 1) div {capacity} as bigint), 0L)")
    cut = narrow.withColumn("n_pieces", last + 1).withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    size = F.least(F.lit(capacity).cast("long"), F.col("total") - F.col("piece") * capacity)
    return materialize(
        cut.withColumn("first_token", F.col("piece") * capacity).withColumn("n_tokens", size).drop("total"), "packing-pieces"
    )


def _packer(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        rows.sort(
            key=lambda r: (
                -r["n_tokens"], r["doc_id"] is None, r["doc_id"] or 0, r["piece"], r["file_path"], r["row_index"]
            )
        )
        places = pack([r["n_tokens"] for r in rows], [r["source"] for r in rows], [r["cluster"] for r in rows], capacity)
        for row, (number, offset) in zip(rows, places):
            row["bin_id"], row["bin_offset"] = (row["group"] << 24) + number, offset
        kinds = {"string": pa.string(), "long": pa.int64()}
        fields = [f.split() for f in PACKED.split(", ")]
        return pa.Table.from_pylist(rows, pa.schema([(name, kinds[kind]) for name, kind in fields]))

    return run


def pack_documents(
    docs: DataFrame,
    capacity: int = CAPACITY,
    group_pieces: int = GROUP_PIECES,
    length: Column | None = None,
    clusters: DataFrame | None = None,
) -> DataFrame:
    """One row per piece: its document, its tokens, its bin and its place there; see PACKED.

    `clusters` (file_path, row_index, cluster) names the clusters of rows of `docs`, which must be file-backed
    then, at most one row a place; a document without one is in the cluster of its exact copies.
    """
    cut = pieces(docs, capacity, length, clusters)
    groups = max(1, -(-cut.count() // group_pieces))
    dealt = cut.withColumn("group", F.pmod(F.xxhash64("doc_id", "file_path", "row_index", "piece"), F.lit(groups)))
    return dealt.groupBy("group").applyInArrow(_packer(capacity), PACKED)


def assemble(docs: DataFrame, packed: DataFrame) -> DataFrame:
    """The sequences: bin_id, n_tokens, doc_ids, text (pieces in order of place, joined by line breaks).

    `docs` must be the file-backed table that was packed.
    """
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    texts = located(docs, "text").select("file_path", "row_index", words.alias("words"))
    own = packed.join(texts, ["file_path", "row_index"]).withColumn(
        "part", F.array_join(F.slice("words", F.col("first_token").cast("int") + 1, F.col("n_tokens").cast("int")), " ")
    )
    bins = own.groupBy("bin_id").agg(
        F.sum("n_tokens").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("bin_offset", "doc_id", "part"))).alias("p")
    )
    return bins.select("bin_id", "n_tokens", F.col("p.doc_id").alias("doc_ids"), F.array_join("p.part", "\n").alias("text"))
