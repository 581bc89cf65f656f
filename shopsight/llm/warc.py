"""WARC archives: a deterministic sharded writer, and a reader.

Records are range-sorted by page identifier. The range boundaries are quantiles of
a sample drawn by a hash of the identifiers, so they depend on the data alone. A
task streams its range through one open file, closing it once its compressed size
reaches `roll_bytes`; each record is a gzip member of its own with headers and
digests made anew and no clock or random value, so the same table yields the same
bytes. Files are written under temporary names; the writer's manifest rows survive
only for task attempts that succeeded, a second step gives their files the final
names, and the manifest itself is published last, also by renaming. Readers take
the files that the manifest names, verify sizes and digests, and see a complete
archive or none.

Pages of one payload are found by digest in a pre-aggregated group; the page with
the largest identifier is the response, the others are revisit records without payload.

Defined cases: a null payload is empty (and a payload like any other); a null url
leaves out the target header; control characters in urls are percent-encoded; a
null identifier sorts first and yields an empty identifier header; rows with equal
identifier and payload that is the largest are all responses; an empty table gives
a manifest without files; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsight.sources import paths
from shopsight.sources.scratch import materialize, new_path

ROLL_BYTES = 64 << 20
SAMPLE_PER_RANGE = 200
MIN_DUPLICATE_BYTES = 0
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMES = uuid.UUID("00000000-0000-5000-8000-000000000000")
MANIFEST, PENDING, TEMPORARY = "MANIFEST", "MANIFEST.pending", "temporary"
_PIECE = 1 << 15

WRITTEN = (
    "range int, number int, temporary string, name string, records long, bytes long, sha256 string"
)
READ = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "payload binary, file string"
)


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{page_id}/{payload_digest}')}>"


def _safe(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def make_record(page_id: int | None, url: str | None, payload: bytes, response_id: int | None) -> bytes:
    """One WARC record; a revisit if `response_id` is that of another page."""
    payload_digest = digest(payload)
    revisit = response_id is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, payload_digest)),
        ("WARC-Date", DATE),
        ("WARC-Page-ID", "" if page_id is None else str(page_id)),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", _safe(url)))
    if revisit:
        headers += [
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To", record_id(response_id, payload_digest)),
            ("WARC-Refers-To-Page-ID", str(response_id)),
        ]
    headers += [
        ("WARC-Payload-Digest", f"sha1:{payload_digest}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def pack(record: bytes) -> bytes:
    """A gzip member without time stamp or name."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def members(data: bytes) -> Iterator[bytes]:
    """The records of an archive, one gzip member at a time."""
    at = 0
    while at < len(data):
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            piece = data[at : at + _PIECE]
            if not piece:
                raise ValueError("The archive ends within a record.")
            parts.append(unpacker.decompress(piece))
            at += len(piece) - len(unpacker.unused_data)
        yield b"".join(parts)


def parse(record: bytes) -> dict[str, object]:
    """The fields of READ, without the file; digests are verified."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("Not a WARC record.")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if digest(block) != fields["WARC-Block-Digest"].removeprefix("sha1:"):
        raise ValueError(f"Block of {fields['WARC-Record-ID']} is damaged.")
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = fields["WARC-Type"] == "revisit"
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    payload_digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and (len(payload) != length or digest(payload) != payload_digest):
        raise ValueError(f"Payload of {fields['WARC-Record-ID']} is damaged.")
    refers = fields.get("WARC-Refers-To-Page-ID")
    return {
        "page_id": int(fields["WARC-Page-ID"]) if fields["WARC-Page-ID"] else None,
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": length,
        "payload_digest": payload_digest,
        "record_type": fields["WARC-Type"],
        "refers_to": int(refers) if refers else None,
        "payload": None if revisit else payload,
    }


class _File(NamedTuple):
    store: fs.FileSystem
    path: str
    out: pa.NativeFile
    hashed: object


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder, as executors open it; Hadoop writes local paths as file:/."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", folder))


def _open(folder: str, name: str) -> tuple[_File, str]:
    store, base = _store(folder)
    temporary = f"{name}.{uuid.uuid4().hex}.tmp"
    path = f"{base}/{temporary}"
    return _File(store, path, store.open_output_stream(path), hashlib.sha256()), temporary


def _writer(folder: str, roll_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[dict] = []
        current, file, row = None, None, {}

        def close() -> None:
            nonlocal file
            if file is not None:
                file.out.close()
                done.append(row | {"sha256": file.hashed.hexdigest()})
                file = None

        number = 0
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for at, page_id, url, payload, response_id in zip(*columns):
                if at != current:
                    close()
                    current, number = at, 0
                elif file is not None and row["bytes"] >= roll_bytes:
                    close()
                    number += 1
                if file is None:
                    name = f"part-{at:06d}-{number:05d}.warc.gz"
                    file, temporary = _open(folder, name)
                    row = {"range": at, "number": number, "temporary": temporary, "name": name, "records": 0, "bytes": 0}
                data = pack(make_record(page_id, url, payload or b"", response_id))
                file.out.write(data)
                file.hashed.update(data)
                row["records"] += 1
                row["bytes"] += len(data)
            if done:
                yield pa.RecordBatch.from_pylist(done, _schema(WRITTEN))
                done.clear()
        close()
        if done:
            yield pa.RecordBatch.from_pylist(done, _schema(WRITTEN))

    return write


_KINDS = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _schema(text: str) -> pa.Schema:
    return pa.schema([(name, _KINDS[kind]) for name, kind in (field.split() for field in text.split(", "))])


def responses(pages: DataFrame, least_bytes: int = MIN_DUPLICATE_BYTES) -> DataFrame:
    """`pages` (page_id, url, payload) with `response_id`: the page that a revisit refers to, else null."""
    keyed = pages.withColumns({"_digest": F.sha2("payload", 256), "_bytes": F.octet_length("payload")})
    groups = keyed.where(F.col("_bytes") >= least_bytes).groupBy("_digest", "_bytes")
    groups = groups.agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    groups = materialize(groups, "warc-repeated")  # its size is then known, and mostly small
    joined = keyed.join(groups, ["_digest", "_bytes"], "left")
    response = F.when(~F.col("last").eqNullSafe(F.col("page_id")), F.col("last"))
    return joined.select("page_id", "url", "payload", response.alias("response_id"))


def boundaries(pages: DataFrame, n_ranges: int) -> list[int]:
    """Upper range limits by page identifier: quantiles of a hash-drawn, bounded sample."""
    total = pages.count()
    share = min(1.0, n_ranges * SAMPLE_PER_RANGE / max(1, total))
    drawn = pages.where(F.pmod(F.xxhash64("page_id"), F.lit(1 << 30)) <= int(share * (1 << 30)))
    keys = sorted(r.page_id for r in drawn.where("page_id is not null").select("page_id").distinct().collect())
    return sorted({keys[len(keys) * i // n_ranges] for i in range(1, n_ranges)}) if keys else []


def write_archives(pages: DataFrame, folder: str, n_ranges: int | None = None, roll_bytes: int = ROLL_BYTES) -> None:
    """Write `pages` (page_id, url, html) as WARC files below `folder`, which must be new.

    `n_ranges` is the number of key ranges written side by side; by default that of
    shuffle partitions.
    """
    spark = pages.sparkSession
    n_ranges = n_ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"),
    )
    limits = boundaries(rows.select("page_id"), n_ranges)
    ranged = responses(rows).withColumn("range", _range_of(limits)(F.col("page_id")))
    ordered = ranged.repartitionById(len(limits) + 1, "range").sortWithinPartitions(
        "range", "page_id", "url", "response_id"
    )
    paths.make_dirs(spark, paths.join(folder, TEMPORARY))
    fields = ordered.select("range", "page_id", "url", "payload", "response_id")
    written = materialize(fields.mapInArrow(_writer(paths.join(folder, TEMPORARY), roll_bytes), WRITTEN), "warc-written")
    _publish(spark, written, folder)


def _range_of(limits: list[int]):
    @F.pandas_udf("int")
    def range_of(page_id: pd.Series) -> pd.Series:
        at = np.searchsorted(limits, page_id.fillna(-(2**63)).astype("int64"), side="right")
        return pd.Series(at.astype("int32"))

    return range_of


def _publish(spark: SparkSession, written: DataFrame, folder: str) -> None:
    """Give the files of successful attempts their names, then publish the manifest by a rename."""

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        for batch in batches:
            for row in batch.to_pylist():
                source, target = f"{base}/{TEMPORARY}/{row['temporary']}", f"{base}/{row['name']}"
                if store.get_file_info(source).type == fs.FileType.File:  # else an earlier attempt moved it
                    store.move(source, target)
                if store.get_file_info(target).size != row["bytes"]:
                    raise OSError(f"{target} does not have the size in the manifest.")
            yield batch

    manifest = paths.join(folder, PENDING)
    written.mapInArrow(rename, WRITTEN).select("name", "range", "number", "records", "bytes", "sha256").write.parquet(manifest)
    paths.rename(spark, manifest, paths.join(folder, MANIFEST))
    paths.delete(spark, paths.join(folder, TEMPORARY))


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """All records of a published set; see READ. Sizes and digests are verified.

    Without payload that column is null; the records are read and verified all the same.
    """
    manifest = spark.read.parquet(paths.join(folder, MANIFEST)).select("name", "bytes", "records")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_stream(f"{base}/{row['name']}", compression=None) as source:
                    data = source.read()
                if len(data) != row["bytes"]:
                    raise OSError(f"{row['name']} has {len(data)} bytes, the manifest {row['bytes']}.")
                found, held, n = [], 0, 0
                for record in members(data):
                    found.append(parse(record) | {"file": row["name"]} | ({} if with_payload else {"payload": None}))
                    held += len(record) if with_payload else 0
                    n += 1
                    if held > 16 << 20 or len(found) >= 10_000:
                        yield pa.RecordBatch.from_pylist(found, _schema(READ))
                        found, held = [], 0
                if n != row["records"]:
                    raise OSError(f"{row['name']} has {n} records, the manifest {row['records']}.")
                if found:
                    yield pa.RecordBatch.from_pylist(found, _schema(READ))

    files = max(1, manifest.count())
    spread = manifest.repartition(min(files, 10_000))
    return spread.mapInArrow(read, READ)


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Write the archives to a new shared folder and return what reading them back gives."""
    folder = new_path(pages.sparkSession, "warc")
    paths.make_dirs(pages.sparkSession, folder)
    write_archives(pages, folder)
    return read_archives(pages.sparkSession, folder, with_payload=False)
