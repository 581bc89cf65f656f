"""Sharding along a Hilbert curve, in DataFrame operations only.

Several metadata dimensions are quantised to a few bits each; their Hilbert index
orders the documents so that documents near on the curve are near in every
dimension; equal runs of that order are the shards. Files then cover small boxes
of the metadata space, and a manifest of per-file ranges prunes reads by any
dimension.

The global rank needs no global sort and no single task. The curve has a bounded
number of cells (2^15 for three dimensions of five bits), so counts per cell are a
small table. A cell that holds more than 1/4096 of the rows is divided by a hash
of identifier and text, so a hot source or language is many buckets. Rank is the
number of rows in earlier buckets plus the row number within the bucket. Law
`rows`: sizes of shards, in rows, differ by one at most.

Broadcasts: the tables of cells and buckets, bounded by `MAX_CELLS` plus `PARTS` rows.

Defined cases: null text has no bytes (size 1, checksum 0); a null dimension is a
value of its own; order within a bucket is by identifier (null first), checksum,
text hash, so repeated rows are interchangeable; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopsight.llm.common import file_backed, free_name, located
from shopsight.sources import paths
from shopsight.sources.scratch import materialize

BITS = 5
PARTS = 4096
MAX_CELLS = 1 << 18


def default_dimensions() -> dict[str, Column]:
    """Size on a logarithmic scale, language, source: each below 2^BITS."""
    top = (1 << BITS) - 1
    return {
        "q_size": F.least(F.lit(top), F.floor(1.5 * F.log2("size"))).cast("int"),
        "q_lang": hashed("lang"),
        "q_source": hashed("source"),
    }


def hashed(column: str, bits: int = BITS) -> Column:
    """A category as one of 2^bits values; equal values meet."""
    return F.pmod(F.crc32(F.concat(F.lit("="), F.col(column).cast("string"))), F.lit(1 << bits)).cast("int")


def hilbert_index(coordinates: list[str], bits: int = BITS) -> Column:
    """Position on the Hilbert curve of a point of len(coordinates) axes, `bits` each (Skilling's transform)."""
    n = len(coordinates)
    steps = ", ".join(f"named_struct('q', {1 << b}, 'd', {d})" for b in range(bits - 1, 0, -1) for d in range(n))
    masks = ", ".join(str(1 << b) for b in range(bits - 1, 0, -1))
    places = ", ".join(f"named_struct('b', {b}, 'd', {d})" for b in range(bits - 1, -1, -1) for d in range(n))
    point = f"array({', '.join(f'coalesce({c}, 0)' for c in coordinates)})"
    if bits > 1:
        point = f"""aggregate(array({steps}), {point}, (x, s) -> transform(x, (v, i) ->
            CASE WHEN (x[s.d] & s.q) <> 0 THEN IF(i = 0, v ^ (s.q - 1), v)
                 WHEN i = 0 OR i = s.d THEN v ^ ((x[0] ^ x[s.d]) & (s.q - 1)) ELSE v END))"""
    prefix = f"""aggregate({point}, cast(array() as array<int>),
        (done, v) -> concat(done, array(v ^ coalesce(try_element_at(done, -1), 0))))"""
    flip = f"aggregate(array({masks or '0'}), 0, (t, q) -> IF((element_at(g, -1) & q) <> 0, t ^ (q - 1), t))"
    # A one-element array stands in for a local variable.
    flipped = f"transform(array({prefix}), g -> transform(g, v -> v ^ {flip}))[0]"
    joined = f"aggregate(array({places}), 0L, (n, p) -> n * 2 + (shiftright(y[p.d], p.b) & 1))"
    return F.expr(f"transform(array({flipped}), y -> {joined})[0]")


def metadata(docs: DataFrame) -> DataFrame:
    """The narrow rows that sharding works on, stored once: identifier, size, checksum, locator, categories."""
    rows = located(file_backed(docs), "doc_id", "text", "lang", "source")
    body = F.coalesce(F.col("text"), F.lit(""))
    return materialize(
        rows.select(
            "doc_id",
            "lang",
            "source",
            (F.octet_length(body) + 1).cast("long").alias("size"),
            F.crc32(body).alias("text_crc32"),
            F.xxhash64(body).alias("text_hash"),
            "file_path",
            "row_index",
        ),
        "hilbert-rows",
    )


def assign(rows: DataFrame, n_shards: int, dimensions: Mapping[str, Column] | None = None, bits: int = BITS) -> DataFrame:
    """`rows` (see `metadata`) with the quantised dimensions, curve, shard and slot."""
    dimensions = dict(dimensions or default_dimensions())
    if 1 << bits * len(dimensions) > MAX_CELLS:
        raise ValueError(f"{len(dimensions)} dimensions of {bits} bits are more than {MAX_CELLS} cells.")
    names = list(dimensions)
    placed = rows.withColumns({n: F.coalesce(c, F.lit(0)) for n, c in dimensions.items()})
    cells = placed.groupBy(*names).agg(F.count(F.lit(1)).alias("cell_rows"))
    cells = materialize(cells.withColumn("curve", hilbert_index(names, bits)), "hilbert-cells")
    total = cells.agg(F.coalesce(F.sum("cell_rows"), F.lit(0))).first()[0]

    parts = F.ceil(F.col("cell_rows") * PARTS / F.lit(max(1, total)))
    divided = cells.select(*names, "curve", parts.alias("parts"))
    located_rows = placed.join(F.broadcast(divided), names).withColumn(
        "part", F.pmod(F.xxhash64("doc_id", "text_hash"), "parts")
    )
    buckets = materialize(
        located_rows.groupBy("curve", "part").agg(F.count(F.lit(1)).alias("bucket_rows")), "hilbert-buckets"
    )
    earlier_cells = Window.orderBy("curve").rowsBetween(Window.unboundedPreceding, -1)
    before_cell = cells.select("curve", F.coalesce(F.sum("cell_rows").over(earlier_cells), F.lit(0)).alias("before_cell"))
    earlier_parts = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        buckets.withColumn("before_part", F.coalesce(F.sum("bucket_rows").over(earlier_parts), F.lit(0)))
        .join(F.broadcast(before_cell), "curve")
        .select("curve", "part", (F.col("before_cell") + F.col("before_part")).alias("before"))
    )
    order = Window.partitionBy("curve", "part").orderBy("doc_id", "text_crc32", "text_hash")
    ranked = located_rows.withColumn("_number", F.row_number().over(order)).join(
        F.broadcast(offsets), ["curve", "part"]
    )
    rank = F.col("before") + F.col("_number") - 1
    return (
        ranked.withColumn("_rank", rank)
        .withColumn("shard", F.expr(f"cast(_rank * {n_shards} div {max(1, total)} as int)"))
        .withColumn("slot", F.expr(f"_rank - (shard * {total}L + {n_shards - 1}) div {n_shards}"))
        .select(*rows.columns, *names, "curve", "shard", "slot")
    )


def write_shards(docs: DataFrame, folder: str, n_shards: int) -> DataFrame:
    """Write all columns of `docs` in curve order, one folder `curve_shard=` per shard, and a manifest of ranges.

    Files are contiguous runs of a shard, so each covers a small box. Returns the
    manifest: curve_shard, file, n_rows, and the least and largest value of each dimension.
    """
    spark = docs.sparkSession
    stored = file_backed(docs)
    place = F.struct(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.row_index").alias("row_index"))
    own, slot, shard = (free_name(docs, name) for name in ("_own_place", "_slot", "curve_shard"))
    whole = stored.select("*", place.alias(own))
    assigned = assign(metadata(stored), n_shards)
    placed = assigned.select(
        F.struct("file_path", "row_index").alias("_place"), F.col("shard").alias(shard), F.col("slot").alias(slot)
    )
    joined = whole.join(placed, whole[own] == placed["_place"])
    columns = [whole[f"`{c}`"] for c in docs.columns]
    ordered = joined.select(*columns, placed[shard], placed[slot]).repartitionByRange(shard, slot)
    data = paths.join(folder, "data")
    ordered.sortWithinPartitions(shard, slot).drop(slot).write.partitionBy(shard).parquet(data)
    written = spark.read.parquet(data)
    dimensions = {"size": F.octet_length(F.coalesce("text", F.lit(""))) + 1} | {c: written[c] for c in ("lang", "source", "doc_id")}
    narrow = written.select(
        F.col(shard).alias("curve_shard"), F.col("_metadata.file_path").alias("file"), *[v.alias(k) for k, v in dimensions.items()]
    )
    ranges = [f(c).alias(f"{name}_{c}") for c in dimensions for name, f in (("min", F.min), ("max", F.max))]
    manifest = narrow.groupBy("curve_shard", "file").agg(F.count(F.lit(1)).alias("n_rows"), *ranges)
    manifest.write.parquet(paths.join(folder, "manifest"))
    return spark.read.parquet(paths.join(folder, "manifest"))


def prune(manifest: DataFrame, wanted: Mapping[str, tuple]) -> DataFrame:
    """Files that may hold rows with every column of `wanted` within its (low, high), both included."""
    for column, (low, high) in wanted.items():
        manifest = manifest.where((F.col(f"min_{column}") <= high) & (F.col(f"max_{column}") >= low))
    return manifest.select("curve_shard", "file")


def digest(assigned: DataFrame) -> DataFrame:
    return assigned.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
