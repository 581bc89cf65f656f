"""Removal of long repeated byte strings with a logarithmic family of suffix arrays.

Every byte covered by a `LENGTH`-byte string that also starts in a document with a
smaller identifier is found, over the whole corpus and exactly at every position.

Documents are gathered into chunks, the batches of the family. A batch's suffix
array lists its suffixes, each cut to `LENGTH` bytes and ordered by the 64-bit
fingerprint of that prefix: only equality of whole prefixes matters here, so
fingerprint order serves as well as letter order and takes 8 bytes a suffix. The
suffix space is divided into buckets, each a task of its own. In a bucket, every
batch's array joins a family of levels; levels of about equal size are merged,
keeping the smallest identifier of each suffix, so there are logarithmically many; each
batch is then merge-scanned against the levels.

Suffixes that cannot repeat never reach the arrays. Three narrowing steps:

1. A text equal to that of a smaller identifier is covered as a whole.
2. Anchors: each `LENGTH`-byte window picks the `GRAM`-byte string of smallest
   fingerprint in it. Equal windows pick equal anchors, so only anchors that occur
   in several documents matter (4 bytes each are exchanged).
3. Of those, an anchor whose surroundings, as far as any window reaches, are the
   same everywhere settles its windows by itself. Only windows at other anchors
   become suffixes of the arrays.

Skew: a chunk sends an anchor or suffix once however often it holds it, so a string
that a third of all documents share is one entry per chunk. Chunks are stored once,
bucketed by their number, and join the findings sent back to them without being
shuffled again.

Defined cases: a null text is empty; texts shorter than `LENGTH` lose nothing; equal
identifiers are not smaller than each other; a null identifier is larger than any
other; an empty table gives no rows; other columns are ignored. A document is never
split, so a worker needs memory for about forty times its longest text.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsight.llm.common import map_arrow, utf8
from shopsight.llm.fingerprint import Windows, mix, slices, sliding
from shopsight.sources.scratch import materialize, new_path

LENGTH = 50
GRAM = 24
REACH = LENGTH - GRAM
CHUNK_BYTES = 1 << 20
BLOCK = 1 << 19
BUCKET_KEYS = 1 << 18
LAST = np.iinfo(np.int64).max
_OTHER = np.uint64(0x2545F4914F6CDD1D)
_ZSTD = pa.Codec("zstd", compression_level=3)

CHUNK = "chunk_id long, doc_ids array<long>, sizes array<long>, digests array<long>, blob binary"
SENT = "bucket long, chunk_id long, keys binary, extra binary, ids binary"
BITS = "chunk_id long, bucket long, n long, bits binary, more binary"


# --- small helpers ---------------------------------------------------------------


def planes(values: np.ndarray) -> bytes:
    """Integers byte plane by byte plane: the many zero bytes then lie together and compress."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()


def unplanes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.int64).ravel()


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys ascending, each position's number among them, the sorting order, and group starts in it."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(keys) else np.zeros(0, np.int64)
    number = np.empty(len(keys), np.int64)
    number[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(keys))))
    return ordered[first], number, order, first


def least(values: np.ndarray, order: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.minimum.reduceat(values[order], first) if len(first) else values[:0]


def greatest(values: np.ndarray, order: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.maximum.reduceat(values[order], first) if len(first) else values[:0]


def log_buckets(keys: float) -> int:
    return max(1, int(np.ceil(np.log2(max(1.0, keys / BUCKET_KEYS)))))


def bucket_slices(keys: np.ndarray, log: int) -> Iterator[tuple[int, slice]]:
    """Non-empty buckets (by the highest bits) of ascending keys."""
    edges = np.searchsorted(keys, np.arange(1 << log, dtype=np.uint64) << np.uint64(64 - log))
    edges = np.append(edges, len(keys))
    for bucket in np.flatnonzero(np.diff(edges)):
        yield int(bucket), slice(int(edges[bucket]), int(edges[bucket + 1]))


def remainders(keys: np.ndarray, log: int) -> np.ndarray:
    """The 32 bits below the bucket's."""
    return ((keys << np.uint64(log)) >> np.uint64(32)).astype(np.uint32)


def packed(bits: np.ndarray) -> bytes:
    return np.packbits(bits).tobytes()


def gathered(parts: list[dict] | None, field: str) -> np.ndarray:
    """A chunk's bits from the buckets that sent some back, in key order."""
    parts = sorted(parts or [], key=lambda p: p["bucket"])
    found = [np.unpackbits(np.frombuffer(p[field], np.uint8), count=p["n"]) for p in parts]
    return np.concatenate(found).astype(bool) if found else np.zeros(0, bool)


# --- the family ------------------------------------------------------------------


class Family:
    """Sorted suffix arrays (keys, smallest identifiers) in levels of geometrically growing size."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, keys: np.ndarray, ids: np.ndarray) -> None:
        """Take in a batch's array (distinct ascending keys); every level stays over twice as large as the next."""
        while self.levels and len(self.levels[-1][0]) <= 2 * len(keys):
            other_keys, other_ids = self.levels.pop()
            both, _, order, first = grouped(np.concatenate([other_keys, keys]))
            keys, ids = both, least(np.concatenate([other_ids, ids]), order, first)
        self.levels.append((keys, ids))

    def smallest(self, keys: np.ndarray) -> np.ndarray:
        """Scan ascending keys against all levels: the smallest identifier of each, LAST if there is none."""
        found = np.full(len(keys), LAST)
        for level_keys, level_ids in self.levels:
            at = np.minimum(np.searchsorted(level_keys, keys), len(level_keys) - 1)
            found = np.where(level_keys[at] == keys, np.minimum(found, level_ids[at]), found)
        return found


# --- chunks ----------------------------------------------------------------------


class Chunk:
    """Texts end to end, with their identifiers and the windows that still have to be looked at."""

    def __init__(self, doc_ids: list, sizes: list[int], blob: bytes, copies: list[int] | None):
        self.sizes = np.array(sizes, np.int64)
        total = int(self.sizes.sum())
        self.text = _ZSTD.decompress(blob, total).to_pybytes() if total else b""
        self.bytes = np.frombuffer(self.text, np.uint8)
        self.starts = np.append(0, np.cumsum(self.sizes))
        self.ids = np.array([LAST if d is None else d for d in doc_ids], np.int64)
        self.copy = np.zeros(len(sizes), bool)
        self.copy[copies or []] = True
        self.valid = np.zeros(total, bool)
        for doc in np.flatnonzero(~self.copy & (self.sizes >= LENGTH)):
            self.valid[self.starts[doc] : self.starts[doc + 1] - LENGTH + 1] = True

    def docs_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, positions, side="right") - 1

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions and keys of the anchors of all valid windows."""
        positions, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for at in range(0, max(0, len(self.bytes) - LENGTH + 1), BLOCK):
            part = self.bytes[at : at + BLOCK + LENGTH - 1]
            prints = Windows(part).of(GRAM)
            smallest = sliding(prints, REACH + 1, np.minimum)
            smallest = np.where(self.valid[at : at + len(smallest)], smallest, np.uint64(0))
            edge = np.zeros(REACH, np.uint64)
            picked = sliding(np.concatenate([edge, smallest, edge]), REACH + 1, np.maximum)
            found = np.flatnonzero(picked == prints)
            positions.append(found + at)
            keys.append(mix(prints[found] ^ _OTHER))
        every, first = np.unique(np.concatenate(positions), return_index=True)
        return every, np.concatenate(keys)[first]

    def surroundings(self, positions: np.ndarray) -> np.ndarray:
        """Fingerprints of all that windows around the anchors reach."""
        docs = self.docs_of(positions)
        begin = np.maximum(positions - REACH, self.starts[docs])
        end = np.minimum(positions + LENGTH, self.starts[docs + 1])
        return mix(slices(self.text, begin, end) + (positions - begin).astype(np.uint64) * _OTHER)

    def suffixes(self, positions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and keys of the valid windows that hold one of the anchors."""
        if not len(positions):
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        change = np.zeros(len(self.bytes) + 1, np.int32)
        np.add.at(change, np.maximum(positions - REACH, 0), 1)
        np.add.at(change, positions + 1, -1)
        starts = np.flatnonzero((np.cumsum(change[:-1]) > 0) & self.valid)
        return starts, slices(self.text, starts, starts + LENGTH)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    ids, texts, held = [], [], 0

    def row() -> pa.RecordBatch:
        digests = [int.from_bytes(hashlib.blake2b(t, digest_size=8).digest(), "big", signed=True) for t in texts]
        data = {
            "chunk_id": number,
            "doc_ids": ids,
            "sizes": [len(t) for t in texts],
            "digests": digests,
            "blob": _ZSTD.compress(b"".join(texts), asbytes=True),
        }
        longs = pa.list_(pa.int64())
        kinds = zip(data, (pa.int64(), longs, longs, longs, pa.binary()))
        return pa.RecordBatch.from_pylist([data], pa.schema(list(kinds)))

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids.append(doc_id)
            texts.append(text.as_py() or b"")
            held += len(texts[-1])
            if held >= CHUNK_BYTES or len(texts) >= 50_000:
                yield row()
                number += 1
                ids, texts, held = [], [], 0
    if texts:
        yield row()


def store_chunks(docs: DataFrame) -> tuple[DataFrame, str]:
    """The chunk table, bucketed by chunk number in the shared folder, and its catalog name."""
    spark = docs.sparkSession
    name = f"suffix_chunks_{uuid.uuid4().hex}"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text")).mapInArrow(_chunks, CHUNK)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = new_path(spark, "suffix-chunks")
    rows.write.bucketBy(buckets, "chunk_id").sortBy("chunk_id").option("path", path).saveAsTable(name)
    return spark.table(name), name


def find_copies(chunks: DataFrame) -> DataFrame:
    """(chunk_id, copies): places in the chunk of texts that also belong to a smaller identifier."""
    docs = chunks.select("chunk_id", F.posexplode(F.arrays_zip("doc_ids", "digests", "sizes")).alias("at", "d"))
    order = F.coalesce("d.doc_ids", F.lit(int(LAST)))
    docs = docs.select("chunk_id", "at", "d.digests", "d.sizes", order.alias("own")).where(F.col("sizes") >= LENGTH)
    first = docs.groupBy("digests", "sizes").agg(F.min("own").alias("least"))
    copies = docs.join(first, ["digests", "sizes"]).where("own > least")
    return copies.groupBy("chunk_id").agg(F.array_sort(F.collect_list("at")).alias("copies"))


# --- what chunks send to buckets, and what comes back --------------------------------


def _rows(rows: list[dict], text: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    return pa.RecordBatch.from_pylist(rows, pa.schema([(n, kinds[k]) for n, k in (f.split() for f in text.split(", "))]))


def _each_chunk(make: Callable[[dict, Chunk], list[dict]]) -> Callable[[pa.RecordBatch], list[dict]]:
    """A batch function that calls `make(row, chunk)`, which returns rows, for every chunk."""

    def run(batch: pa.RecordBatch) -> list[dict]:
        out = []
        names = batch.schema.names
        for i in range(batch.num_rows):
            row = {n: batch.column(k)[i].as_py() for k, n in enumerate(names)}
            chunk = Chunk(row["doc_ids"], row["sizes"], row["blob"], row.get("copies"))
            out.extend(make(row, chunk))
        return out

    return run


def _local_anchors(chunk: Chunk):
    positions, keys = chunk.anchors()
    docs = chunk.docs_of(positions)
    distinct, number, order, first = grouped(keys)
    several = least(docs, order, first) != greatest(docs, order, first)
    return positions, keys, distinct, several[number], number


def _send_anchors(log: int):
    def make(row: dict, chunk: Chunk) -> list[dict]:
        _, _, distinct, _, _ = _local_anchors(chunk)
        short = remainders(distinct, log)
        return [
            {"bucket": b, "chunk_id": row["chunk_id"], "keys": short[s].tobytes()} for b, s in bucket_slices(distinct, log)
        ]

    run = _each_chunk(make)
    return lambda batch: _rows(run(batch), SENT)


def _repeated(table: pa.Table) -> pa.Table:
    """Of a bucket's anchors, those that were sent more than once."""
    sent = [np.frombuffer(k, np.uint32) for k in table.column("keys").to_pylist()]
    _, number, _, first = grouped(np.concatenate(sent))
    repeated = (np.diff(np.append(first, len(number))) > 1)[number]
    ends = np.cumsum([len(k) for k in sent])
    return _answers(table, [(bits, None) for bits in np.split(repeated, ends[:-1])])


def _answers(table: pa.Table, found: list[tuple[np.ndarray, np.ndarray | None]]) -> pa.Table:
    rows = [
        {"chunk_id": c, "bucket": b, "n": len(bits), "bits": packed(bits), "more": None if more is None else packed(more)}
        for c, b, (bits, more) in zip(table.column("chunk_id").to_pylist(), table.column("bucket").to_pylist(), found)
    ]
    return pa.Table.from_batches([_rows(rows, BITS)])


STATE = "bucket long, chunk_id long, keys binary, extra binary, ids binary, positions binary, numbers binary"


def _send_surroundings(log: int):
    """Rows for the buckets, and one with bucket -1 that keeps the chunk's repeated anchors."""

    def make(row: dict, chunk: Chunk) -> list[dict]:
        positions, keys, _, several, number = _local_anchors(chunk)
        kept = several | gathered(row["anchor_bits"], "bits")[number]
        positions, keys = positions[kept], keys[kept]
        if not len(positions):
            return []
        docs = chunk.docs_of(positions)
        around = chunk.surroundings(positions)
        distinct, number, order, first = grouped(keys)
        low, high = least(around, order, first), greatest(around, order, first)
        ids = least(chunk.ids[docs], order, first)
        short = remainders(distinct, log)
        out = [
            {
                "bucket": b,
                "chunk_id": row["chunk_id"],
                "keys": short[s].tobytes(),
                "extra": low[s].tobytes() + high[s].tobytes(),
                "ids": planes(ids[s]),
            }
            for b, s in bucket_slices(distinct, log)
        ]
        state = {"positions": positions.astype(np.uint32).tobytes(), "numbers": number.astype(np.uint32).tobytes()}
        return [*out, {"bucket": -1, "chunk_id": row["chunk_id"], "ids": planes(ids), **state}]

    run = _each_chunk(make)
    return lambda batch: _rows(run(batch), STATE)


def _settled(table: pa.Table) -> pa.Table:
    """Of a bucket's repeated anchors: do their surroundings differ, and has a smaller identifier one."""
    sent = [np.frombuffer(k, np.uint32) for k in table.column("keys").to_pylist()]
    extra = [np.frombuffer(e, np.uint64) for e in table.column("extra").to_pylist()]
    ids = [unplanes(i) for i in table.column("ids").to_pylist()]
    _, number, order, first = grouped(np.concatenate(sent))
    low = least(np.concatenate([e[: len(e) // 2] for e in extra]), order, first)
    high = greatest(np.concatenate([e[len(e) // 2 :] for e in extra]), order, first)
    smallest = least(np.concatenate(ids), order, first)
    out, at = [], 0
    for own in ids:
        mine = number[at : at + len(own)]
        out.append(((low != high)[mine], smallest[mine] < own))
        at += len(own)
    return _answers(table, out)


class Repeats:
    """A chunk's repeated anchors after step 3: those that are settled, and the suffixes at the others."""

    def __init__(self, chunk: Chunk, row: dict):
        positions = np.frombuffer(row["positions"] or b"", np.uint32).astype(np.int64)
        numbers = np.frombuffer(row["numbers"] or b"", np.uint32)
        self.differ = gathered(row["around_bits"], "bits")[numbers] if len(numbers) else np.zeros(0, bool)
        own = chunk.ids[chunk.docs_of(positions)]
        if len(numbers):
            earlier = gathered(row["around_bits"], "more")[numbers] | (own > unplanes(row["anchor_ids"])[numbers])
        else:
            earlier = np.zeros(0, bool)
        self.settled = positions[~self.differ & earlier]
        self.starts, keys = chunk.suffixes(positions[self.differ])
        self.own = chunk.ids[chunk.docs_of(self.starts)]
        self.keys, self.numbers, order, first = grouped(keys)
        self.ids = least(self.own, order, first)


def _send_suffixes(log: int):
    def make(row: dict, chunk: Chunk) -> list[dict]:
        found = Repeats(chunk, row)
        return [
            {"bucket": b, "chunk_id": row["chunk_id"], "keys": found.keys[s].tobytes(), "ids": planes(found.ids[s])}
            for b, s in bucket_slices(found.keys, log)
        ]

    run = _each_chunk(make)
    return lambda batch: _rows(run(batch), SENT)


def _scanned(table: pa.Table) -> pa.Table:
    """Batches of a bucket join the family, and are then scanned against its levels."""
    family = Family()
    arrays = [
        (np.frombuffer(k, np.uint64), unplanes(i))
        for k, i in zip(table.column("keys").to_pylist(), table.column("ids").to_pylist())
    ]
    for keys, ids in sorted(arrays, key=lambda a: int(a[1].min())):
        family.add(keys, ids)
    return _answers(table, [(family.smallest(keys) < ids, None) for keys, ids in arrays])


def _returned(answers: DataFrame, name: str) -> DataFrame:
    """All answers to a chunk in one row; as many as there are buckets at most."""
    return answers.groupBy("chunk_id").agg(F.collect_list(F.struct("bucket", "n", "bits", "more")).alias(name))


# --- results ----------------------------------------------------------------------

FOUND = (
    "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
    "spans array<struct<start:long,end:long>>, kept binary"
)


def _covered(chunk: Chunk, row: dict) -> np.ndarray:
    """By byte: is it removed."""
    found = Repeats(chunk, row)
    change = np.zeros(len(chunk.bytes) + 1, np.int64)
    docs = chunk.docs_of(found.settled)
    np.add.at(change, np.maximum(found.settled - REACH, chunk.starts[docs]), 1)
    np.add.at(change, np.minimum(found.settled + LENGTH, chunk.starts[docs + 1]), -1)
    if len(found.starts):
        earlier = gathered(row["suffix_bits"], "bits")[found.numbers] | (found.own > found.ids[found.numbers])
        np.add.at(change, found.starts[earlier], 1)
        np.add.at(change, found.starts[earlier] + LENGTH, -1)
    removed = np.cumsum(change[:-1]) > 0
    for doc in np.flatnonzero(chunk.copy):
        removed[chunk.starts[doc] : chunk.starts[doc + 1]] = True
    return removed


def _result(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        names = "doc_id n_bytes n_removed n_spans kept_sha256 spans kept".split()
        kinds = [pa.int64()] * 4 + [pa.string(), span, pa.binary()]
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(k)[i].as_py() for k, n in enumerate(batch.schema.names)}
                chunk = Chunk(row["doc_ids"], row["sizes"], row["blob"], row["copies"])
                removed = _covered(chunk, row)
                out = []
                for doc, doc_id in enumerate(row["doc_ids"]):
                    a, b = int(chunk.starts[doc]), int(chunk.starts[doc + 1])
                    gone = removed[a:b]
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
                    spans = [{"start": int(x), "end": int(y)} for x, y in zip(edges[::2], edges[1::2])]
                    kept = chunk.bytes[a:b][~gone].tobytes() if spans else chunk.text[a:b]
                    sha = hashlib.sha256(kept).hexdigest()
                    out.append((doc_id, b - a, int(gone.sum()), len(spans), sha, spans, kept if with_text else None))
                columns = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)

    return run


def remove_repeats(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """One row per document; see FOUND. Spans are byte ranges [start, end); `kept` is what remains."""
    spark = docs.sparkSession
    chunks, name = store_chunks(docs)
    total = chunks.select(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda x, y: x + y))).first()[0] or 0
    copies = materialize(find_copies(chunks), "suffix-copies")
    base = chunks.drop("digests").join(copies, "chunk_id", "left")

    # A window has an anchor about every REACH / 2 bytes.
    log = log_buckets(2 * total / REACH)
    sent = map_arrow(base, _send_anchors(log), SENT)
    anchors = materialize(sent.groupBy("bucket").applyInArrow(_repeated, BITS), "suffix-anchors")

    base_anchors = base.join(_returned(anchors, "anchor_bits"), "chunk_id")
    stored = materialize(map_arrow(base_anchors, _send_surroundings(log), STATE), "suffix-surroundings")
    around = stored.where("bucket >= 0").groupBy("bucket").applyInArrow(_settled, BITS)
    around = materialize(around, "suffix-settled")
    state = stored.where("bucket = -1").select("chunk_id", "positions", "numbers", F.col("ids").alias("anchor_ids"))

    repeats = base.join(state, "chunk_id", "left").join(_returned(around, "around_bits"), "chunk_id", "left")
    unsettled = around.agg(F.sum("n")).first()[0] or 0
    log_suffixes = log_buckets(unsettled * REACH / 4)
    sent = map_arrow(repeats.where("positions is not null"), _send_suffixes(log_suffixes), SENT)
    suffixes = materialize(sent.groupBy("bucket").applyInArrow(_scanned, BITS), "suffix-scanned")

    whole = repeats.join(_returned(suffixes, "suffix_bits"), "chunk_id", "left")
    result = materialize(whole.mapInArrow(_result(with_text), FOUND), "suffix-result")
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # leaves the files in the shared folder
    return result
