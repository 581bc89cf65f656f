"""Subword encoding and decoding by a table of distinct marked words.

Pieces of the model never cross a whitespace marker: no piece holds a marker after
another character (`Model` checks it, and that texts are not rewritten before they
are cut). A text is thus a row of marked words, each a run of blanks and what
follows up to the next blank, and every word's ids are the same wherever it stands.

1. `_Block` cuts the documents of a task, some MB at a time, into marked words,
   numbers the distinct ones and keeps the numbers by position.
2. Distinct words meet in hashed buckets, packed into one row per block and bucket;
   each is segmented once (`_segmenter`). A frequent word comes once per block, not
   once per place, so that no key is hot.
3. The ids go back to their block and are put in place of the numbers.

Texts are never shuffled, only word numbers and distinct words. Words of over
`LONG_WORD` bytes are segmented where they stand, so that buckets stay bounded.

Defined cases: a null text is the empty text and has no ids; bytes that are not
UTF-8 count as U+FFFD; blanks and markers that are part of the text are the same
character, as for the model; repeated rows each get their row; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from sentencepiece import SentencePieceProcessor

from shopsight.llm.common import file_backed, located, utf8
from shopsight.sources.scratch import new_path

MARKER = "▁"
BLOCK_BYTES = 16 << 20
BUCKET_BYTES = 16 << 20
LONG_WORD = 256
MAX_FILES = 100_000
OUT_ROWS, OUT_IDS = 2000, 200_000
_WORD = re.compile(" +[^ ]*")

_DOC = "struct<doc_id: bigint, file_path: string, row_index: bigint, n: bigint>"
BLOCKS = f"block string, bucket int, words binary, docs array<{_DOC}>, codes binary, buckets binary, ids binary, sizes binary"
SEGMENTED = "block string, bucket int, ids binary, sizes binary"
ENCODED = "doc_id long, file_path string, row_index long, ids array<int>"


class Model:
    """A model file's bytes, small enough to travel with the tasks."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.proto = file.read()
        processor = self.processor()
        pieces = [processor.id_to_piece(i) for i in range(processor.get_piece_size())]
        if any(MARKER in piece.lstrip(MARKER) for piece in pieces):
            raise ValueError("The model has pieces across whitespace markers; words cannot be segmented alone.")
        probe = "A  ﬁ ①\t "
        if processor.normalize(probe) != MARKER + probe.replace(" ", MARKER):
            raise ValueError("The model rewrites texts before it cuts them; words cannot be segmented alone.")

    def processor(self) -> SentencePieceProcessor:
        return _processor(self.proto)

    def word_ids(self, words: list[str]) -> list[list[int]]:
        """Ids of marked words, given without the blank that each begins with."""
        found = self.processor().encode(words, num_threads=1)
        alone = self.processor().piece_to_id(MARKER)
        return [ids if word else [alone] for word, ids in zip(words, found)]


@lru_cache(maxsize=2)
def _processor(proto: bytes) -> SentencePieceProcessor:
    return SentencePieceProcessor(model_proto=proto)


def _packed(values: np.ndarray | list, kind: type) -> bytes:
    """Numbers as compressed byte planes: high bytes, mostly equal, cost next to nothing."""
    plain = np.asarray(values, kind)
    return zstandard.compress(plain.view(np.uint8).reshape(-1, plain.itemsize).T.tobytes(), 1)


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def _packed_ids(values: np.ndarray | list) -> bytes:
    """Ids below 2^16, which is nearly all models, in two bytes each."""
    plain = np.asarray(values, np.int32)
    short = bool(len(plain) == 0 or plain.max() < 1 << 16)
    return bytes([short]) + zstandard.compress((plain.astype(np.uint16) if short else plain).tobytes(), 3)


def _unpacked_ids(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data[1:]), np.uint16 if data[0] else np.int32).astype(np.int32)


class _Block:
    """Consecutive documents of a task, as numbers of distinct words."""

    def __init__(self) -> None:
        self.numbers: dict[str, int] = {}
        self.docs: list[dict] = []
        self.codes: list[np.ndarray] = []
        self.n_bytes = 0

    def add(self, doc_id: int | None, file_path: str, row_index: int, text: bytes | None) -> None:
        plain = (text or b"").decode("utf-8", "replace").replace(MARKER, " ")
        words = _WORD.findall(" " + plain) if plain else []
        numbers = self.numbers
        codes = [numbers.setdefault(word, len(numbers)) for word in words]
        self.codes.append(np.array(codes, np.uint32))
        self.docs.append({"doc_id": doc_id, "file_path": file_path, "row_index": row_index, "n": len(codes)})
        self.n_bytes += len(text or b"") + 64

    def rows(self, model: Model, n_buckets: int) -> Iterator[dict]:
        """One row of numbers by position, and one of distinct words for each bucket."""
        block = f"{self.docs[0]['file_path']}:{self.docs[0]['row_index']}"
        by_bucket: dict[int, list[bytes]] = {}
        own: list[str] = []
        buckets = np.empty(len(self.numbers), np.int32)
        for word, number in self.numbers.items():
            raw = word[1:].encode()
            if len(raw) > LONG_WORD:
                own.append(word[1:])
                buckets[number] = n_buckets
            else:
                buckets[number] = bucket = zlib.crc32(raw) % n_buckets
                by_bucket.setdefault(bucket, []).append(raw)
        ids = model.word_ids(own)
        yield {
            "block": block,
            "docs": self.docs,
            "codes": _packed(np.concatenate(self.codes), np.uint32),
            "buckets": _packed(buckets, np.int32),
            "ids": _packed_ids([i for one in ids for i in one]),
            "sizes": _packed([len(one) for one in ids], np.int32),
        }
        for bucket, words in by_bucket.items():
            yield {"block": block, "bucket": bucket, "words": zstandard.compress(b"\xff".join(words), 3)}  # no byte of UTF-8


def _cutter(model: Model, n_buckets: int, block_bytes: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for batch in batches:
            for values in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "file_path", "row_index", "text"))):
                block.add(*values)
                if block.n_bytes >= block_bytes:
                    yield from pa.Table.from_pylist(list(block.rows(model, n_buckets)), schema).to_batches()
                    block = _Block()
        if block.docs:
            yield from pa.Table.from_pylist(list(block.rows(model, n_buckets)), schema).to_batches()

    return run


def _segmenter(model: Model) -> Callable[[pa.Table], pa.Table]:
    """Ids of the distinct words of one bucket, each segmented once, for every block."""

    def run(table: pa.Table) -> pa.Table:
        numbers: dict[bytes, int] = {}
        asked = []
        for packed in table.column("words"):
            words = zstandard.decompress(packed.as_py()).split(b"\xff")
            asked.append(np.array([numbers.setdefault(word, len(numbers)) for word in words], np.int64))
        found = model.word_ids([word.decode() for word in numbers])
        sizes = np.array([len(ids) for ids in found], np.int32)
        flat = np.array([i for ids in found for i in ids], np.int32)
        starts = np.cumsum(sizes, dtype=np.int64) - sizes
        ids = [_packed_ids(_gather(flat, starts, sizes, picked)) for picked in asked]
        return pa.table(
            {
                "block": table.column("block").cast(pa.string()),
                "bucket": table.column("bucket").cast(pa.int32()),
                "ids": pa.array(ids, pa.binary()),
                "sizes": pa.array([_packed(sizes[picked], np.int32) for picked in asked], pa.binary()),
            }
        )

    return run


def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, picked: np.ndarray) -> np.ndarray:
    """The runs numbered `picked`, one after the other; run i has sizes[i] values of `flat` from starts[i] on."""
    taken = sizes[picked].astype(np.int64)
    before = np.cumsum(taken) - taken
    return flat[np.repeat(starts[picked] - before, taken) + np.arange(taken.sum())]


def _runs(items: list, weights: list[int]) -> Iterator[list]:
    """The items in consecutive runs of about OUT_IDS, one item at least."""
    held, weight = [], 0
    for item, more in zip(items, weights):
        if held and (weight + more > OUT_IDS or len(held) >= OUT_ROWS):
            yield held
            held, weight = [], 0
        held.append(item)
        weight += more
    if held:
        yield held


def _lists(values: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of each document of a block, from its word numbers and the ids of its words."""
    for row in (row for batch in batches for i in range(batch.num_rows) for row in batch.slice(i, 1).to_pylist()):
        codes, buckets = _unpacked(row["codes"], np.uint32), _unpacked(row["buckets"], np.int32)
        parts = sorted(row["parts"] or [], key=lambda p: p["bucket"]) + [{"ids": row["ids"], "sizes": row["sizes"]}]
        sizes = np.concatenate([_unpacked(p["sizes"], np.int32) for p in parts])
        flat = np.concatenate([_unpacked_ids(p["ids"]) for p in parts])
        starts = np.cumsum(sizes, dtype=np.int64) - sizes
        place = np.empty(len(buckets), np.int64)  # of a word in the order of buckets
        place[np.argsort(buckets, kind="stable")] = np.arange(len(buckets))
        at = 0
        for docs in _runs(row["docs"], [doc["n"] for doc in row["docs"]]):
            counts = np.array([doc["n"] for doc in docs], np.int64)
            words = place[codes[at : at + counts.sum()]]
            at += counts.sum()
            after = np.concatenate([[0], np.cumsum(sizes[words], dtype=np.int64)])  # ids before each word
            ends = after[np.concatenate([[0], np.cumsum(counts)])]
            named = {name: [doc[name] for doc in docs] for name in ("doc_id", "file_path", "row_index")}
            arrays = [pa.array(named["doc_id"], pa.int64()), pa.array(named["file_path"]), pa.array(named["row_index"])]
            arrays.append(_lists(_gather(flat, starts, sizes, words), ends))
            yield pa.RecordBatch.from_arrays(arrays, names=[*named, "ids"])


def _stored_by_block(rows: DataFrame, n_files: int) -> DataFrame:
    """The rows stored in the shared folder, dealt to files by block without a shuffle."""
    spark = rows.sparkSession
    name = f"piece_blocks_{uuid.uuid4().hex}"
    try:
        rows.write.bucketBy(n_files, "block").option("path", new_path(spark, "piece-blocks")).saveAsTable(name)
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # leaves the files in the shared folder


def encode(
    docs: DataFrame,
    model: Model,
    block_bytes: int = BLOCK_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
    decoded: str | None = None,
) -> DataFrame:
    """One row per document: doc_id, ids (array<int>), file_path, row_index; as column `decoded`, if named, the
    text of its ids, found by the same tasks."""
    docs = file_backed(docs)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = 1 + total // bucket_bytes
    rows = located(docs, F.col("doc_id").cast("long").alias("doc_id"), utf8("text"))
    doc = pa.struct([("doc_id", pa.int64()), ("file_path", pa.string()), ("row_index", pa.int64()), ("n", pa.int64())])
    binary = [(name, pa.binary()) for name in ("codes", "buckets", "ids", "sizes")]
    schema = pa.schema(
        [("block", pa.string()), ("bucket", pa.int32()), ("words", pa.binary()), ("docs", pa.list_(doc)), *binary]
    )
    n_blocks = min(1 + total // block_bytes, MAX_FILES)
    cut = _stored_by_block(rows.mapInArrow(_cutter(model, n_buckets, block_bytes, schema), BLOCKS), n_blocks)
    # Explicit counts: packed rows look small to the planner, which would leave them to a few tasks. As many parts
    # as the stored table has, so that it is joined where it lies.
    words = cut.where("bucket is not null").select("block", "bucket", "words").repartition(n_buckets, "bucket")
    segmented = words.groupBy("bucket").applyInArrow(_segmenter(model), SEGMENTED)
    parts = segmented.repartition(n_blocks, "block").groupBy("block")
    parts = parts.agg(F.collect_list(F.struct("bucket", "ids", "sizes")).alias("parts"))
    blocks = cut.where("bucket is null").drop("bucket", "words").join(parts, "block", "left")
    if decoded is None:
        return blocks.mapInArrow(_placed, ENCODED)
    return blocks.mapInArrow(lambda batches: _with_texts(_placed(batches), model, decoded), f"{ENCODED}, {decoded} string")


def _with_texts(batches: Iterator[pa.RecordBatch], model: Model, column: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ends, flat = batch.column("ids").offsets.to_pylist(), batch.column("ids").values.to_numpy()
        for rows in _runs(list(range(batch.num_rows)), [j - i for i, j in zip(ends, ends[1:])]):
            ids = [flat[ends[i] : ends[i + 1]].tolist() for i in rows]
            texts = pa.array(model.processor().decode(ids, num_threads=1), pa.string())
            yield batch.slice(rows[0], len(rows)).append_column(column, texts)


def decode(encoded: DataFrame, model: Model, column: str = "decoded") -> DataFrame:
    """Rows with a column `ids` (array<int>, not null), and the texts that their ids stand for."""
    schema = StructType([*encoded.schema.fields, StructField(column, StringType())])
    return encoded.mapInArrow(lambda batches: _with_texts(batches, model, column), schema)
