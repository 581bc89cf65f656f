"""Benchmark decontamination: word windows of test items searched in training texts.

Every window of `WINDOW_WORDS` consecutive item words (a shorter item is one
window) becomes a 64-bit fingerprint. The fingerprints travel as one broadcast
hash set; documents are scanned where they lie, without a shuffle: fingerprints
of all their word windows come from vectorised prefix arithmetic, the set is
probed by binary search, and each hit is verified against the window's words.

The broadcast is bounded: windows are numbered and stored, and a block of at most
`block_windows` of them is broadcast at a time. A benchmark that fits one block is
one pass; a larger one costs one pass a block, and the blocks' findings are merged
per document. So memory does not grow with the benchmark, and no window is left out.

Defined cases: null texts have no words; an item without words has no window; a
document without words is clean; windows shared by several items count for each;
repeated documents are judged alike, row by row; an empty benchmark finds nothing.
Columns other than the named ones are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsight.llm.common import map_arrow, utf8, word_line, word_starts
from shopsight.llm.fingerprint import slices
from shopsight.sources.scratch import materialize

WINDOW_WORDS = 10
# 500,000 windows of ten words are about 60 MB of bytes and 100 MB in a worker.
BLOCK_WINDOWS = 500_000
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

FOUND = (
    "doc_id long, n_words long, n_hit long, n_items long, items array<string>, "
    "spans array<struct<first:long,last:long>>"
)


def _item_windows(n: int):
    def windows(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, lines = [], []
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = word_line(text).split()
            for i in range(max(1, len(words) - n + 1) if words else 0):
                ids.append(item)
                lines.append(b" ".join(words[i : i + n]))
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(lines, pa.binary())], ["item_id", "line"])

    return windows


def item_windows(benchmark: DataFrame, n: int = WINDOW_WORDS) -> DataFrame:
    """Distinct windows with the items they occur in: line (words joined by spaces), items."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), utf8("text"))
    return (
        map_arrow(rows, _item_windows(n), "item_id string, line binary")
        .groupBy("line")
        .agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    )


class Probe:
    """A block of windows, grouped by their number of words."""

    def __init__(self, windows: Iterable[tuple[bytes, list[str]]]):
        by_length: dict[int, list[tuple[bytes, list[str]]]] = defaultdict(list)
        for line, items in windows:
            by_length[line.count(b" ") + 1].append((bytes(line), items))
        self.sets = []
        for length, rows in by_length.items():
            prints = np.array([slices(line, np.array([0]), np.array([len(line)]))[0] for line, _ in rows], np.uint64)
            self.sets.append((length, np.unique(prints), dict(rows)))

    def find(self, line: bytes) -> tuple[list[tuple[int, int]], set[str]]:
        """Word spans [first, last] of verified window occurrences, merged, and the items they belong to."""
        starts = word_starts(line)
        hits, items = [], set()
        for length, prints, rows in self.sets:
            if len(starts) <= length:
                continue
            begin, end = starts[:-length], starts[length:] - 1
            seen = slices(line, begin, end)
            near = np.minimum(np.searchsorted(prints, seen), len(prints) - 1)
            for i in np.flatnonzero(prints[near] == seen):
                found = rows.get(line[begin[i] : end[i]])
                if found is not None:
                    hits.append((int(i), int(i) + length - 1))
                    items.update(found)
        return merge(hits), items


def merge(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Closed spans, joined where they overlap or touch."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def _scan(block):
    probes: list[Probe] = []  # one per worker, made at its first batch

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not probes:
            probes.append(Probe(block.value))
        n_words, n_hit, n_items, items, spans = [], [], [], [], []
        for text in batch.column(1).to_pylist():
            line = word_line(text)
            found, names = probes[0].find(line)
            n_words.append(line.count(b" ") + 1 if line else 0)
            n_hit.append(sum(last - first + 1 for first, last in found))
            n_items.append(len(names))
            items.append(sorted(names))
            spans.append([{"first": first, "last": last} for first, last in found])
        span = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(n_words, pa.int64()),
                pa.array(n_hit, pa.int64()),
                pa.array(n_items, pa.int64()),
                pa.array(items, pa.list_(pa.string())),
                pa.array(spans, span),
                *batch.columns[2:],
            ],
            names=["doc_id", "n_words", "n_hit", "n_items", "items", "spans", *batch.schema.names[2:]],
        )

    return scan


def _merge_blocks(rows: DataFrame) -> DataFrame:
    """One row per document from one row per document and block."""
    grouped = rows.groupBy("_row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("all"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    joined = F.expr(
        """aggregate(all, cast(array() as array<struct<first:bigint,last:bigint>>), (done, x) ->
             if(size(done) > 0 and x.first <= element_at(done, -1).last + 1,
                concat(slice(done, 1, size(done) - 1), array(named_struct(
                  'first', element_at(done, -1).first, 'last', greatest(element_at(done, -1).last, x.last)))),
                concat(done, array(x))))"""
    )
    return grouped.withColumn("spans", joined).select(
        "_row",
        "doc_id",
        "n_words",
        F.expr("aggregate(spans, 0L, (n, x) -> n + x.last - x.first + 1)").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        "items",
        "spans",
    )


def _blocks(windows: DataFrame, block_windows: int):
    """Broadcasts of at most `block_windows` windows each, one after the other."""
    context = windows.sparkSession.sparkContext
    total = windows.count()
    # Twice as many parts as needed, so that an uneven hash stays within the bound.
    parts = 1 if total <= block_windows else 2 * -(-total // block_windows)
    for k in range(parts):
        part = windows.where(F.pmod(F.xxhash64("line"), F.lit(parts)) == k)
        yield parts, context.broadcast([(bytes(r.line), r["items"]) for r in part.collect()])


def find_passages(
    docs: DataFrame, benchmark: DataFrame, n: int = WINDOW_WORDS, block_windows: int = BLOCK_WINDOWS
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items, spans (word numbers, both ends included)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text"))
    return _found(rows, benchmark, n, block_windows).drop("_row")


def _found(rows: DataFrame, benchmark: DataFrame, n: int, block_windows: int) -> DataFrame:
    """The findings; with several blocks, rows need a column `_row` that tells them apart, or get one here."""
    windows = materialize(item_windows(benchmark, n), "benchmark-windows")
    found = None
    for parts, block in _blocks(windows, block_windows):
        if parts == 1:
            kept = ", _row string" if "_row" in rows.columns else ""
            return map_arrow(rows, _scan(block), FOUND + kept)
        if "_row" not in rows.columns:
            rows = _numbered(rows)
        part = materialize(map_arrow(rows, _scan(block), FOUND + ", _row string"), "scanned-block")
        block.destroy()
        found = part if found is None else found.union(part)
    return _merge_blocks(found)


def _numbered(rows: DataFrame) -> DataFrame:
    stored = materialize(rows, "scanned-documents")
    return stored.select("*", F.concat_ws("#", "_metadata.file_path", "_metadata.row_index").alias("_row"))


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW_WORDS) -> DataFrame:
    """The documents without any benchmark window, with all their columns."""
    windows = materialize(item_windows(benchmark, n), "benchmark-windows")
    out = docs
    for _, block in _blocks(windows, BLOCK_WINDOWS):
        out = _clean_only(out, block)
    return out


def _clean_only(docs: DataFrame, block) -> DataFrame:
    at = docs.columns.index("text")
    probes: list[Probe] = []

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not probes:
            probes.append(Probe(block.value))
        return batch.filter(pa.array([not probes[0].find(word_line(t))[0] for t in batch.column(at).to_pylist()]))

    binary = docs.withColumn("text", utf8("text"))
    return map_arrow(binary, judge, binary.schema).withColumn("text", F.col("text").cast("string"))


def remove_passages(
    docs: DataFrame, benchmark: DataFrame, n: int = WINDOW_WORDS, block_windows: int = BLOCK_WINDOWS
) -> DataFrame:
    """All documents with all their columns; the words of benchmark passages are cut out of the texts."""
    rows = _numbered(docs.select(F.struct("*").alias("doc")))  # its own columns cannot clash with those below
    scanned = rows.select(F.col("doc.doc_id").cast("long").alias("doc_id"), F.col("doc.text").cast("binary").alias("text"), "_row")
    hit = _found(scanned, benchmark, n, block_windows).where("n_hit > 0").select("_row", "spans")
    dirty = rows.join(hit, "_row").select("doc", F.col("doc.text").cast("binary").alias("body"), "spans")

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [
            cut_words(text, [(s["first"], s["last"]) for s in found])
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
        ]
        return batch.set_column(1, batch.schema.field(1), pa.array(texts, pa.binary()))

    mended = map_arrow(dirty, cut, dirty.schema)
    texts = {"text": F.col("body").cast("string")}
    own = {c: F.col(f"doc.`{c}`") for c in docs.columns}
    clean = rows.join(hit, "_row", "left_anti").select(*[v.alias(c) for c, v in own.items()])
    return clean.union(mended.select(*[v.alias(c) for c, v in (own | texts).items()]))


def cut_words(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the given words; a cut runs from the first word's start to the last word's end."""
    places = [m.span() for m in WORD.finditer(text)]
    kept, at = [], 0
    for first, last in spans:
        kept.append(text[at : places[first][0]])
        at = places[last][1]
    return b"".join([*kept, text[at:]])
