"""Near-duplicate detection by an inverted join on MinHash signature coordinates.

Documents are sets of word shingles; texts of one set form a class with one
representative. A representative has `COORDINATES` MinHash values and is posted
under each coordinate-value pair. Two sets of similarity 0.8 agree in fewer than
`MATCHES` coordinates with probability 1e-6, so pairs below that count are
passed over:

- postings of frequency one are skipped, and so are documents with fewer than
  `MATCHES` shared postings;
- prefix filter: of its s shared postings a document keeps the s - MATCHES + 1
  rarest; two documents that agree in MATCHES of them share one of those;
- collisions of pairs met in lists are counted on 256 coordinates, of which four bits
  each are kept in bit planes, so that 64 coordinates compare in a few words; pairs at
  or above the threshold are verified on their full shingle sets.

Pairs within a list are not all made. First each member meets a few pivots of its
list: the member with most company in all its lists, and some drawn by hash. The
links found are merged to components; each member outside its list's largest
component then meets pivots drawn from that component. Last, all pairs that are
still in different components meet: in the postings of the first nine coordinates,
of which a pair of similarity 0.8 shares one but for a probability of 5e-7, in the
first that it shares, and with a comparison of shingle sets within the join. Pairs inside one component are never made,
since they cannot change the result, and no pair across components is left out, so
the components are those of all links; the pivots only decide how few are left.

Skew: exact copies collapse in a pre-aggregated group; hot lists are joined by
sort-merge joins that adaptive execution splits. All intermediate results are
stored in the shared folder.

Defined cases: a null, empty or blank text has no shingles and links with nothing;
fewer words than a shingle are one shingle; of equal identifiers the first by
place stays; a null identifier is larger than any other; an empty table gives no
rows; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsight.llm.common import components, file_backed, located, map_arrow, token_line, utf8, without, word_starts
from shopsight.llm.fingerprint import mix, slices
from shopsight.sources.scratch import materialize

SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80
COORDINATES = 64
MATCHES = 35
ALL_COORDINATES = 256
ALL_MATCHES = 176  # four bits of coordinates that differ agree one time in sixteen
PLANES = 4
LAST_POSTED = 9
PIVOTS = 3
_STEP = 1 << 15  # shingles hashed at a time, so that a long text takes bounded memory

_random = np.random.default_rng(64)
_FACTORS = _random.integers(1, 2**64, (ALL_COORDINATES, 1), dtype=np.uint64) | np.uint64(1)
_SHIFTS = _random.integers(0, 2**64, (ALL_COORDINATES, 1), dtype=np.uint64)


def shingles(text: bytes | None, words: int) -> np.ndarray:
    """Sorted distinct fingerprints of the text's word shingles."""
    line = token_line(text)
    if not line:
        return np.zeros(0, np.uint64)
    starts = word_starts(line)
    words = min(words, len(starts) - 1)
    return np.unique(slices(line, starts[:-words], starts[words:] - 1))


def signature(shingle_set: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """MinHash values, reduced to 32 bits."""
    least = np.full(coordinates, np.iinfo(np.uint64).max, np.uint64)
    factors, shifts = _FACTORS[:coordinates], _SHIFTS[:coordinates]
    for at in range(0, len(shingle_set), _STEP):
        least = np.minimum(least, (shingle_set[at : at + _STEP] * factors + shifts).min(axis=1))
    return (mix(least) >> np.uint64(32)).astype(np.uint32)


def bit_planes(values: np.ndarray, n: int) -> np.ndarray:
    """The lowest n bits of 64 values as n words: word j holds bit j of each."""
    bits = (values[None, :] >> np.arange(n, dtype=np.uint32)[:, None]) & np.uint32(1)
    return np.packbits(bits.astype(np.uint8)[:, ::-1], axis=1)[:, ::-1].copy().view(np.int64).ravel()


def planes(values: np.ndarray) -> np.ndarray:
    return np.concatenate([bit_planes(values[i : i + 64], PLANES) for i in range(0, ALL_COORDINATES, 64)])


def _signed(words: int):
    def sign(batch: pa.RecordBatch) -> pa.RecordBatch:
        nodes, sizes, rows, lengths = [], [], [], []
        for text in batch.column(1).to_pylist():
            found = shingles(text, words)
            sizes.append(len(found))
            if len(found):
                nodes.append(int.from_bytes(hashlib.blake2b(found.tobytes(), digest_size=8).digest(), "big", signed=True))
                rows.append(signature(found).view(np.int32))
                lengths.append(COORDINATES)
            else:
                nodes.append(None)
                lengths.append(0)
        values = np.concatenate(rows) if rows else np.zeros(0, np.int32)
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(2),
                batch.column(3),
                pa.array(nodes, pa.int64()),
                pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(offsets, values),
            ],
            names=["doc_id", "file_path", "row_index", "node", "n_shingles", "sig"],
        )

    return sign


MEMBER = "node long, n_shingles long, text binary, planes array<long>, marks array<int>, short array<int>"


def _members(words: int):
    """Adds bit planes, the first coordinates, and the shingles cut to 32 bits."""

    def add(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingles(text, words) for text in batch.column(2).to_pylist()]
        signatures = [signature(s, ALL_COORDINATES) for s in sets]
        made = [
            pa.array([planes(v).tolist() for v in signatures], pa.list_(pa.int64())),
            pa.array([v[:LAST_POSTED].view(np.int32).tolist() for v in signatures], pa.list_(pa.int32())),
            pa.array([np.unique(s.astype(np.uint32)).view(np.int32) for s in sets], pa.list_(pa.int32())),
        ]
        names = "node n_shingles text planes marks short".split()
        return pa.RecordBatch.from_arrays([*batch.columns, *made], names=names)

    return add


N_PLANES = PLANES * ALL_COORDINATES // 64


def _sided(side: str) -> list[Column]:
    """The planes as columns of their own, never null: joins then compile to code short enough for the JIT."""
    return [F.coalesce(F.col("planes")[i], F.lit(0).cast("long")).alias(f"{side}{i}") for i in range(N_PLANES)]


def _all_matches() -> Column:
    """Coordinates whose kept bits agree."""
    total = F.lit(ALL_COORDINATES)
    for at in range(0, N_PLANES, PLANES):
        differ = F.col(f"a{at}").bitwiseXOR(F.col(f"b{at}"))
        for i in range(at + 1, at + PLANES):
            differ = differ.bitwiseOR(F.col(f"a{i}").bitwiseXOR(F.col(f"b{i}")))
        total = total - F.bit_count(differ)
    return total


def _sizes_fit(percent: int) -> Column:
    return F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent


def _may_link(percent: int) -> Column:
    return _sizes_fit(percent) & (_all_matches() >= ALL_MATCHES)


def posting_lists(classes: DataFrame) -> DataFrame:
    """Prefix postings of lists with two members or more: key, node, centre (its company in all its lists)."""
    post = classes.select("node", F.posexplode("sig").alias("at", "value")).select(
        "node",
        F.shiftleft(F.col("at").cast("long"), 32).bitwiseOR(F.col("value").cast("long").bitwiseAND(0xFFFFFFFF)).alias("key"),
    )
    frequency = post.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = post.join(frequency, "key").groupBy("node").agg(
        F.collect_list(F.struct("n", "key")).alias("posts"), F.sum("n").alias("centre")
    )
    prefix = F.slice(F.array_sort("posts"), F.lit(1), F.size("posts") - MATCHES + 1)
    kept = shared.where(F.size("posts") >= MATCHES).select("node", "centre", F.explode(prefix).alias("p"))
    lists = materialize(kept.select("p.key", "node", "centre"), "minhash-postings")
    several = lists.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    return materialize(lists.join(several, "key"), "minhash-lists")


class Links:
    """Verified links so far, and what has been verified."""

    def __init__(self, members: DataFrame, words: int, percent: int):
        self.members, self.words, self.percent = members, words, percent
        self.links: DataFrame | None = None
        self.judged: DataFrame | None = None

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) whose signatures allow a link."""
        first = self.members.select(F.col("node").alias("a"), F.col("n_shingles").alias("n_a"), *_sided("a"))
        second = self.members.select(F.col("node").alias("b"), F.col("n_shingles").alias("n_b"), *_sided("b"))
        return pairs.join(first, "a").join(second, "b").where(_may_link(self.percent)).select("a", "b")

    def verify(self, pairs: DataFrame) -> None:
        """Compare the full sets of pairs (a, b)."""
        words, percent = self.words, self.percent
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if self.judged is not None:
            pairs = pairs.join(self.judged.select("a", "b"), ["a", "b"], "left_anti")
        likely = materialize(pairs, "minhash-likely")
        text_a = self.members.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
        text_b = self.members.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
        held = likely.join(text_b, "b").join(text_a, "a").select("a", "b", "text_a", "text_b")

        def compare(batch: pa.RecordBatch) -> pa.RecordBatch:
            nodes, last, own, linked = batch.column(0).to_pylist(), None, None, []
            for i, (text_one, text_two) in enumerate(zip(batch.column(2), batch.column(3))):
                if nodes[i] != last:
                    last, own = nodes[i], shingles(text_one.as_py(), words)
                other = shingles(text_two.as_py(), words)
                common = len(np.intersect1d(own, other, assume_unique=True))
                linked.append(100 * common >= percent * (len(own) + len(other) - common))
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], names=["a", "b", "linked"]
            )

        done = materialize(map_arrow(held, compare, "a long, b long, linked boolean"), "minhash-judged")
        self.judged = done if self.judged is None else self.judged.union(done)
        self.links = self.judged.where("linked").select("a", "b")

    def labels(self) -> DataFrame:
        """(node, component) of the nodes that have links."""
        return components(self.links, "minhash-components")


def _drawn(first: int, n: int) -> list[Column]:
    """Aggregates: n members of a list, drawn by hash."""
    return [F.min(F.struct(F.xxhash64("node", F.lit(first + i)).alias("h"), "node"))["node"] for i in range(n)]


def _star_pairs(lists: DataFrame) -> DataFrame:
    """Each member of a list with the list's pivots."""
    central = F.max(F.struct("centre", "node"))["node"]
    pivots = lists.groupBy("key").agg(F.array_distinct(F.array(central, *_drawn(0, PIVOTS - 1))).alias("pivots"))
    return _with_pivots(lists, pivots)


def _with_pivots(rows: DataFrame, pivots: DataFrame) -> DataFrame:
    pairs = rows.join(pivots, "key").select("node", F.explode("pivots").alias("a")).where("a <> node")
    return pairs.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()


def _main_components(labelled: DataFrame) -> DataFrame:
    """(key, main) of the lists with several components: the largest of each."""
    counts = labelled.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    mixed = counts.groupBy("key").agg(F.max(F.struct("n", "component")).alias("main"), F.count(F.lit(1)).alias("several"))
    return mixed.where("several > 1").select("key", F.col("main.component").alias("main"))


def _labelled(lists: DataFrame, labels: DataFrame) -> DataFrame:
    return lists.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _main_pairs(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """Each member outside its list's largest component with pivots drawn from that component."""
    labelled = _labelled(lists, labels)
    mixed = materialize(labelled.join(_main_components(labelled), "key"), "minhash-mixed")
    inside = mixed.where("component = main").groupBy("key")
    pivots = inside.agg(F.array_distinct(F.array(*_drawn(PIVOTS, 2 * PIVOTS))).alias("pivots"))
    return _with_pivots(mixed.where("component <> main").select("key", "node"), pivots)


def _cross_pairs(labels: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """All pairs of different components that share a posting and that, by their cut shingles, are linked."""
    posted = members.select("node", F.posexplode("marks").alias("at", "value"))
    lists = posted.select("node", "at", F.struct("at", "value").alias("key"))
    labelled = _labelled(lists, labels)
    active = materialize(labelled.join(_main_components(labelled), "key"), "minhash-mixed")
    full = members.drop("text")
    outside = active.where("component <> main").join(full, "node")
    outside = outside.select(
        F.col("key").alias("key_a"), "at", F.col("node").alias("a"), F.col("component").alias("c_a"),
        F.col("n_shingles").alias("n_a"), F.col("marks").alias("marks_a"), F.col("short").alias("short_a"), *_sided("a"),
    )
    anyone = active.drop("at").join(full, "node").select(
        F.col("key").alias("key_b"), F.col("node").alias("b"), F.col("component").alias("c_b"), "main",
        F.col("n_shingles").alias("n_b"), F.col("marks").alias("marks_b"), F.col("short").alias("short_b"), *_sided("b"),
    )
    earlier = F.lit(0)
    for i in range(LAST_POSTED):
        same = (F.lit(i) < F.col("at")) & (F.col("marks_a")[i] == F.col("marks_b")[i])
        earlier = earlier + same.cast("int")
    # Common shingles that merge when cut merge on both sides, so no more are lost than the smaller
    # number of merged values; `Links.verify` decides.
    merged = F.least(F.col("n_a") - F.size("short_a"), F.col("n_b") - F.size("short_b"))
    common = F.size(F.array_intersect("short_a", "short_b")) + merged
    meet = (
        (F.col("key_a") == F.col("key_b"))
        & (F.col("c_a") != F.col("c_b"))
        & ((F.col("c_b") == F.col("main")) | (F.col("a") < F.col("b")))
        & _may_link(percent)
        & (earlier == 0)
        & (common * 100 >= percent * (F.col("n_a") + F.col("n_b") - common))
    )
    return outside.join(anyone, meet).select("a", "b")


def find_groups(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = SIMILAR_PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, file_path, row_index."""
    rows = located(file_backed(docs), "doc_id", "text").select("doc_id", utf8("text"), "file_path", "row_index")
    schema = "doc_id long, file_path string, row_index long, node long, n_shingles long, sig array<int>"
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("long"))
    signed = materialize(map_arrow(rows, _signed(words), schema), "minhash-signed")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "file_path", "row_index")
    classes = (
        signed.where("node is not null")
        .groupBy("node")
        .agg(
            F.min(place).alias("first"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("sig").alias("sig"),
        )
    )
    classes = materialize(classes, "minhash-classes")
    lists = posting_lists(classes)
    wanted = lists.select("node").distinct().join(classes, "node")
    wanted = wanted.select(
        "node", "n_shingles", F.col("first.file_path").alias("file_path"), F.col("first.row_index").alias("row_index")
    )
    texts = rows.select("text", "file_path", "row_index").join(wanted, ["file_path", "row_index"])
    members = materialize(map_arrow(texts.select("node", "n_shingles", "text"), _members(words), MEMBER), "minhash-members")

    found = Links(members, words, percent)
    found.verify(found.likely(_star_pairs(lists)))
    found.verify(found.likely(_main_pairs(lists, found.labels())))
    found.verify(_cross_pairs(found.labels(), members, percent))
    labels = found.labels()

    groups = classes.select("node", "first").join(labels, "node", "left")
    groups = groups.withColumn("component", F.coalesce("component", "node"))
    leaders = groups.groupBy("component").agg(F.min("first").alias("leader"))
    led = groups.join(leaders, "component").select("node", "leader")
    own = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "file_path", "row_index")
    whole = signed.drop("sig").join(led, "node", "left").withColumn("leader", F.coalesce("leader", own))
    return whole.select(
        "doc_id",
        "n_shingles",
        F.col("leader.doc_id").alias("component_id"),
        ((F.col("leader.file_path") == F.col("file_path")) & (F.col("leader.row_index") == F.col("row_index"))).alias("kept"),
        "file_path",
        "row_index",
    )


def drop_near_copies(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = SIMILAR_PERCENT) -> DataFrame:
    """One document of each group, the one with the smallest identifier, with all its columns."""
    docs = file_backed(docs)
    return without(docs, find_groups(docs, words, percent).where("not kept"))
