"""Prefix trie of conversations, its subtree totals found by parallel tree contraction.

Nodes: a node is a sequence of turns. Its name is the exclusive-or of two 64-bit
hashes of (position, turn digest) over its turns, which a running aggregate gives for
every prefix; long conversations are aggregated in runs of `RUN` turns first, so that
no task holds one whole. Turns get their positions from one range sort of all turns.

Contraction (`subtree_totals`), on narrow rows (node, parent, totals so far): each
round *rakes* the leaves, adding their totals to their parents, and *compresses*
chains: an inner node with one child left, whose name hashes below those of its parent
and its child in this round, is taken out, its child moves up to its parent, and what
lies between is kept with the child. Both are joins and sums that combine before the
shuffle, so that a parent of very many leaves is no hot key; rounds are stored, and
their number grows with the logarithm of the nodes. Nodes that were taken out are
re-expanded by pointer doubling over the notes that each left.

Defined cases: turns are ordered by number (null first), then role and text; a null
role or text is empty; rows without an identifier belong to no conversation; repeated
rows are turns of their own; without conversations there is no node; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopsight.sources.scratch import materialize

RUN = 1024
PART_BYTES = 64 << 20
CHUNK_BYTES = 64 << 10


def ordered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored turns (conv_id, part, at, digest, chars) and, per conversation and part, where its turns stand.

    `at - start` is a turn's position; a conversation may span any number of parts.
    """
    spark = conversations.sparkSession
    empty = F.lit("")
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", empty).alias("role"),
        F.coalesce("text", empty).alias("text"),
    )
    total = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    parts = max(spark.sparkContext.defaultParallelism, 1 + total // PART_BYTES)
    order = ["conv_id", "turn", "role", "text"]
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    turns = materialize(
        rows.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .select(
            "conv_id",
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("at"),
            F.unhex(said).alias("digest"),
            F.length("text").cast("long").alias("chars"),
        ),
        "trie-turns",
    )
    stretches = turns.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("first") - F.coalesce(F.sum("n").over(before), F.lit(0))
    return turns, materialize(stretches.select("conv_id", "part", start.alias("start"), "n"), "trie-stretches")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that take over the opening of the first of their hundred.

    Returns (conv_id, n) of all conversations and their turns (conv_id, n, pos, digest, chars): the first h turns
    of conversation c - c % 100, then c's own from the h-th on; h is crc32(c) % 6.
    """
    turns, stretches = ordered_turns(conversations)
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("long")
    own = stretches.groupBy("conv_id").agg(F.sum("n").alias("n_own")).withColumn("h", h)
    own = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % 100)
    bases = own.select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_base"))
    lent = F.least("h", F.coalesce("n_base", F.lit(0)))
    n = lent + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))
    every = materialize(
        own.join(bases, "base", "left").select("conv_id", "base", "h", lent.alias("lent"), n.alias("n")), "trie-conversations"
    )
    placed = turns.join(stretches.drop("n"), ["conv_id", "part"]).withColumn("pos", F.col("at") - F.col("start"))
    placed = materialize(placed.select("conv_id", "pos", "digest", "chars"), "trie-placed")
    opening = placed.where("pos < 5").withColumnRenamed("conv_id", "base")
    taken = every.select("conv_id", "base", "lent", "n").where("lent > 0").join(opening, "base").where("pos < lent")
    rest = placed.join(every, "conv_id").where("pos >= h").withColumn("pos", F.col("pos") - F.col("h") + F.col("lent"))
    columns = ["conv_id", "n", "pos", "digest", "chars"]
    return every.select("conv_id", "n"), taken.select(*columns).unionByName(rest.select(*columns))


def _named(a: Column, b: Column, name: str) -> Column:
    return F.struct(a.alias("a"), b.alias("b")).alias(name)


def prefixes(turns: DataFrame) -> DataFrame:
    """One row per conversation and prefix: node, parent, depth, chars of the last turn, conv_id, n."""
    one = turns.select(
        "conv_id", "n", "pos", "chars", F.expr(f"pos div {RUN}").alias("run"),
        *[F.xxhash64(F.lit(seed), "pos", "digest").alias(f"own_{name}") for seed, name in enumerate("ab")],
    )
    so_far = Window.partitionBy("conv_id", "run").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    running = one.withColumns({name: F.bit_xor(f"own_{name}").over(so_far) for name in "ab"})
    runs = one.where(f"n > {RUN}").groupBy("conv_id", "run")
    runs = runs.agg(*[F.bit_xor(f"own_{name}").alias(f"run_{name}") for name in "ab"])
    earlier = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    before = runs.select("conv_id", "run", *[F.bit_xor(f"run_{name}").over(earlier).alias(f"before_{name}") for name in "ab"])
    before = materialize(before, "trie-runs")  # empty but for very long conversations; the planner sees its size
    whole = running.join(before, ["conv_id", "run"], "left")
    here = [F.col(name).bitwiseXOR(F.coalesce(f"before_{name}", F.lit(0).cast("long"))) for name in "ab"]
    above = [value.bitwiseXOR(F.col(f"own_{name}")) for value, name in zip(here, "ab")]
    return whole.select(
        _named(*here, "node"), _named(*above, "parent"), (F.col("pos") + 1).alias("depth"), "chars", "conv_id", "n"
    )


# Contraction.


def subtree_totals(tree: DataFrame, values: list[str]) -> DataFrame:
    """For every node the sum of each value over its subtree: rows (node, *values).

    `tree` has node, parent (null at roots) and the values (long, not null); a forest will do.
    """
    between = {v: f"between_{v}" for v in values}
    parents = tree.where("parent is not null").select(F.col("parent").alias("above")).distinct()
    active = materialize(
        tree.join(parents, F.col("node") == F.col("above"), "left").select(
            "node", "parent", *values, *[F.lit(0).cast("long").alias(b) for b in between.values()], F.col("above").isNull().alias("leaf")
        ),
        "trie-active",
    )
    raked, notes, round_ = [], [], 0
    while not active.isEmpty():
        raked.append(active.where("leaf").select("node", *values))
        inner = _raked(active, values, between)
        moved = _compressed(inner, values, between, round_)
        notes.append(moved.where("note is not null").select("note", F.col("node").alias("to"), *[f"note_{v}" for v in values]))
        active = moved.select("node", "parent", *values, *between.values(), "leaf")
        round_ += 1
    if not raked:
        return tree.select("node", *values)
    done = reduce(DataFrame.unionByName, raked)
    lost = _expanded(materialize(reduce(DataFrame.unionByName, notes), "trie-notes"), values)
    back = lost.join(done.withColumnRenamed("node", "to"), "to")
    return done.unionByName(back.select(F.col("note").alias("node"), *[(F.col(v) + F.col(f"note_{v}")).alias(v) for v in values]))


def _raked(active: DataFrame, values: list[str], between: dict[str, str]) -> DataFrame:
    """Inner nodes with what their leaves give; `only` is the one child left, where there is one."""
    children = active.where("parent is not null").groupBy(F.col("parent").alias("above")).agg(
        *[F.sum(F.when(F.col("leaf"), F.col(v) + F.col(b)).otherwise(0)).alias(f"given_{v}") for v, b in between.items()],
        F.count_if(~F.col("leaf")).alias("n_left"),
        F.min(F.when(~F.col("leaf"), F.col("node"))).alias("first_left"),
    )
    joined = active.where("not leaf").join(children, F.col("node") == F.col("above"))
    return joined.select(
        "node",
        "parent",
        *[(F.col(v) + F.col(f"given_{v}")).alias(v) for v in values],
        *between.values(),
        (F.col("n_left") == 0).alias("leaf"),
        F.when(F.col("n_left") == 1, F.col("first_left")).alias("only"),
    )


def _compressed(inner: DataFrame, values: list[str], between: dict[str, str], round_: int) -> DataFrame:
    """Nodes that stay, children of those taken out moved up with a note of what was taken out."""

    def rank(node: str) -> Column:
        return F.xxhash64(F.lit(round_), F.col(node))

    lower = (rank("node") < rank("parent")) & (rank("node") < rank("only"))
    out = F.col("only").isNotNull() & F.col("parent").isNotNull() & lower
    inner = materialize(inner.withColumn("out", out), "trie-raked")
    taken = inner.where("out").select(
        F.col("node").alias("note"),
        F.col("parent").alias("higher"),
        *[F.col(v).alias(f"taken_{v}") for v in values],
        *[F.col(b).alias(f"taken_{b}") for b in between.values()],
    )
    moved = inner.where("not out").join(taken, F.col("parent") == F.col("note"), "left")
    none = F.lit(0).cast("long")
    return materialize(
        moved.select(
            "node",
            F.when(F.col("note").isNotNull(), F.col("higher")).otherwise(F.col("parent")).alias("parent"),
            *values,
            *[(F.col(b) + F.coalesce(f"taken_{v}", none) + F.coalesce(f"taken_{b}", none)).alias(b) for v, b in between.items()],
            "leaf",
            "note",
            *[(F.col(f"taken_{v}") + F.col(b)).alias(f"note_{v}") for v, b in between.items()],
        ),
        "trie-active",
    )


def _expanded(notes: DataFrame, values: list[str]) -> DataFrame:
    """Notes that lead to raked nodes: each hop doubles what a note spans."""
    while True:
        names = {"note": "via", "to": "beyond", **{f"note_{v}": f"more_{v}" for v in values}}
        hops = notes.select(*[F.col(old).alias(new) for old, new in names.items()])
        joined = notes.join(hops, F.col("to") == F.col("via"), "left").select(
            "note",
            F.coalesce("beyond", "to").alias("to"),
            *[(F.col(f"note_{v}") + F.coalesce(f"more_{v}", F.lit(0).cast("long"))).alias(f"note_{v}") for v in values],
            F.col("via").isNotNull().alias("hopped"),
        )
        stored = materialize(joined, "trie-notes")
        notes = stored.drop("hopped")
        if stored.where("hopped").isEmpty():
            return notes


# Digests of long sorted lists.

_CHUNKS = "node struct<a: bigint, b: bigint>, part int, seq int, piece string"
_DIGESTS = "node struct<a: bigint, b: bigint>, ends_sha256 string"
_NODE = pa.struct([("a", pa.int64()), ("b", pa.int64())])


def _key(row: dict) -> tuple[int, int]:
    return row["node"]["a"], row["node"]["b"]


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, conv_id, part) rows as comma-joined pieces of bounded length."""
    schema = pa.schema([("node", _NODE), ("part", pa.int32()), ("seq", pa.int32()), ("piece", pa.string())])
    out: list[dict] = []
    for key, group in groupby((row for batch in batches for row in batch.to_pylist()), key=_key):
        held, size, seq = [], 0, 0
        for row in group:
            if size >= CHUNK_BYTES:
                out.append({"node": row["node"], "part": row["part"], "seq": seq, "piece": ",".join(held)})
                held, size, seq = [], 0, seq + 1
            held.append(str(row["conv_id"]))
            size += len(held[-1]) + 1
        out.append({"node": dict(zip("ab", key)), "part": row["part"], "seq": seq, "piece": ",".join(held)})
        if len(out) >= 1000:
            yield from pa.Table.from_pylist(out, schema).to_batches()
            out = []
    if out:
        yield from pa.Table.from_pylist(out, schema).to_batches()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("node", _NODE), ("ends_sha256", pa.string())])
    out: list[dict] = []
    for key, group in groupby((row for batch in batches for row in batch.to_pylist()), key=_key):
        digest, comma = hashlib.sha256(), ""
        for row in group:
            digest.update((comma + row["piece"]).encode())
            comma = ","
        out.append({"node": dict(zip("ab", key)), "ends_sha256": digest.hexdigest()})
        if len(out) >= 1000:
            yield from pa.Table.from_pylist(out, schema).to_batches()
            out = []
    if out:
        yield from pa.Table.from_pylist(out, schema).to_batches()


def ends_digests(ends: DataFrame) -> DataFrame:
    """For rows (node, conv_id): node and the hash of its conversations in order, joined by commas.

    Lists are sorted and joined over all tasks; only the pieces of one list, some 10,000 numbers each, meet in a
    stream, so that a list of any length needs bounded memory.
    """
    spark = ends.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, 1 + ends.count() // 2_000_000)
    ranged = ends.select("node", "conv_id").repartitionByRange(parts, "node", "conv_id").sortWithinPartitions("node", "conv_id")
    pieces = ranged.withColumn("part", F.spark_partition_id()).mapInArrow(_joined, _CHUNKS)
    return pieces.repartition("node").sortWithinPartitions("node", "part", "seq").mapInArrow(_hashed, _DIGESTS)


def build_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: node, parent, conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256; see `rebuilt` for the conversations."""
    every, turns = rebuilt(conversations)
    every = materialize(every, "trie-lengths")
    rows = materialize(prefixes(turns), "trie-prefixes")
    zero = F.lit(0).cast("long")
    root = _named(zero, zero, "node")
    top = every.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    top = top.select(root, F.lit(None).cast("struct<a: bigint, b: bigint>").alias("parent"), zero.alias("depth"), zero.alias("chars"), "n_convs", "conv_id")
    below = rows.groupBy("node").agg(
        *[F.min(c).alias(c) for c in ("parent", "depth", "chars")],  # equal in all rows of a node
        F.count(F.lit(1)).alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
    )
    nodes = materialize(top.unionByName(below), "trie-nodes")
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = materialize(nodes.join(children, "node", "left").fillna(0, ["n_children"]), "trie-nodes")
    tree = nodes.select(
        "node",
        "parent",
        (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
    )
    totals = subtree_totals(tree, ["n_leaves", "saved_tokens"])
    ends = rows.where("depth = n").select("node", "conv_id").unionByName(every.where("n = 0").select(root, "conv_id"))
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    joined = nodes.join(totals, "node").join(parents, "parent", "left").join(ends_digests(ends), "node", "left")
    return joined.select(
        "node", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
