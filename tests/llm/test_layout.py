"""Sharding, archives and packing: laws, round trips, brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from shopsight.llm import hilbert, minhash, packing, warc
from shopsight.sources import paths
from shopsight.sources.scratch import materialize, new_path
from tests.llm import tables


@pytest.mark.parametrize("n,bits", [(2, 4), (3, 3), (3, 5), (4, 2), (2, 1)])
def test_curve_visits_every_cell_by_unit_steps(spark, n, bits):
    cells = spark.range(1 << n * bits).select(
        *[(F.shiftright("id", bits * i).cast("long") % (1 << bits)).cast("int").alias(f"x{i}") for i in range(n)]
    )
    names = [f"x{i}" for i in range(n)]
    path = sorted(cells.withColumn("h", hilbert.hilbert_index(names, bits)).collect(), key=lambda r: r.h)
    assert [r.h for r in path] == list(range(1 << n * bits))
    assert all(sum(abs(a[c] - b[c]) for c in names) == 1 for a, b in zip(path, path[1:]))


@pytest.mark.parametrize("extra", [False, True])
def test_shards(spark, extra):
    random_ = random.Random(1)
    texts = tables.ODD + [tables.sentence(random_, random_.randint(0, 200)) for _ in range(90)] + ["same"] * 40
    docs = tables.documents(spark, texts, extra, repeat=extra)
    found = tables.rows(hilbert.digest(hilbert.assign(hilbert.metadata(docs), 16)))
    assert len(found) == docs.count()
    slots = defaultdict(list)
    for row in found:
        raw = (texts[row["doc_id"]] or "").encode()
        assert row["size"] == len(raw) + 1 and row["text_crc32"] == zlib.crc32(raw)
        assert row["law"] == "rows" and row["grown_shard"] is None
        slots[row["shard"]].append(row["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(16))
    sizes = [len(slots[s]) for s in range(16)]
    assert max(sizes) - min(sizes) <= 1


def test_ranks_follow_the_curve_and_hot_cells_are_divided(spark, monkeypatch):
    monkeypatch.setattr(hilbert, "PARTS", 8)
    docs = tables.documents(spark, ["same text"] * 300 + [f"{'w ' * (i % 50)}{i}" for i in range(100)])
    placed = hilbert.assign(hilbert.metadata(docs), 5)
    order = sorted(tables.rows(placed), key=lambda r: (r["shard"], r["slot"]))
    curve = [r["curve"] for r in order]
    assert curve == sorted(curve) and len(set(curve)) > 5


def test_written_shards_prune(spark):
    texts = [tables.sentence(random.Random(i), 1 + i % 40) for i in range(200)]
    docs = tables.documents(spark, texts, extra=True)
    folder = new_path(spark, "test-shards")
    manifest = hilbert.write_shards(docs, folder, 4)
    back = spark.read.parquet(paths.join(folder, "data"))
    assert set(docs.columns) <= set(back.columns)
    assert back.select(*docs.columns).exceptAll(docs).count() == 0 and back.count() == 200
    low = back.where("octet_length(text) <= 19")
    files = {r.file for r in hilbert.prune(manifest, {"size": (0, 20)}).collect()}
    assert {r.f for r in low.select(F.col("_metadata.file_path").alias("f")).distinct().collect()} <= files
    assert manifest.agg(F.sum("n_rows")).first()[0] == 200 and len(files) < manifest.count()


def test_empty_and_single_rows(spark):
    docs = tables.documents(spark, ["one"])
    assert hilbert.assign(hilbert.metadata(docs), 16).count() == 1
    assert hilbert.assign(hilbert.metadata(docs.where("doc_id < 0")), 16).count() == 0
    assert packing.pack_documents(docs.where("doc_id < 0")).count() == 0


# --- archives ---------------------------------------------------------------------


def pages(spark, html):
    rows = [(i, f"http://e.org/{i}" if i % 3 else None, h) for i, h in enumerate(html)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


HTML = [None, "", "<p>é</p>", "same", "same", "x" * 100_000, "same", "\r\n\r\nWARC/1.1\r\n", "", "tail\x00\x1f\x8b"]


def test_archives_round_trip(spark):
    folder = new_path(spark, "test-warc")
    paths.make_dirs(spark, folder)
    df = pages(spark, HTML + [f"<p>{i}</p>" for i in range(60)]).withColumn("digest", F.lit("clash"))
    warc.write_archives(df, folder, n_ranges=3, roll_bytes=2000)
    found = {r["page_id"]: r for r in tables.rows(warc.read_archives(spark, folder))}
    html = {r.page_id: (r.url, (r.html or "").encode()) for r in df.collect()}
    assert found.keys() == html.keys()
    last = {}
    for i, (_, body) in html.items():
        last[body] = max(i, last.get(body, -1))
    for i, (url, body) in html.items():
        row = found[i]
        assert row["url"] == url and row["payload_bytes"] == len(body) and row["payload_digest"] == warc.digest(body)
        assert row["record_type"] == ("response" if last[body] == i else "revisit")
        assert row["refers_to"] == (None if last[body] == i else last[body])
        assert row["payload"] == (body if last[body] == i else None)
    manifest = tables.rows(spark.read.parquet(paths.join(folder, warc.MANIFEST)))
    assert sum(r["records"] for r in manifest) == len(html)
    assert len(manifest) > len({r["range"] for r in manifest})  # some range was rolled
    assert not paths.exists(spark, paths.join(folder, warc.TEMPORARY))


def test_archives_are_deterministic(spark):
    shas = []
    for parts in (1, 5):
        folder = new_path(spark, "test-warc")
        paths.make_dirs(spark, folder)
        warc.write_archives(pages(spark, HTML * 4).repartition(parts), folder, n_ranges=3, roll_bytes=500)
        manifest = tables.rows(spark.read.parquet(paths.join(folder, warc.MANIFEST)))
        shas.append(sorted((r["name"], r["bytes"], r["sha256"]) for r in manifest))
    assert shas[0] == shas[1]


def test_unpublished_or_damaged_archives_are_not_read(spark):
    folder = new_path(spark, "test-warc")
    paths.make_dirs(spark, folder)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        warc.read_archives(spark, folder)
    with pytest.raises(ValueError, match="damaged"):
        warc.parse(warc.make_record(1, "u", b"payload", None).replace(b"payload", b"pay-oad"))
    with pytest.raises(ValueError, match="ends within"):
        list(warc.members(warc.pack(b"record")[:-3]))


def test_archives_of_odd_tables(spark):
    empty = warc.archive_and_read(pages(spark, ["x"]).where("page_id < 0"))
    assert empty.count() == 0
    repeated = spark.createDataFrame([(1, "a\r\nb", "x"), (1, "a\r\nb", "x"), (None, None, "x"), (None, "u", None)], "page_id bigint, url string, html string")
    found = tables.rows(warc.archive_and_read(repeated))
    kinds = Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in found)
    assert kinds == {(1, "response", None): 2, (None, "revisit", 1): 1, (None, "response", None): 1}


# --- packing ----------------------------------------------------------------------


def plain_best_fit(items, capacity):
    """Look at all bins: of those with room and without conflict, the tightest, then the oldest."""
    bins, placed = [], []
    for length, source, cluster in items:
        fits = [
            (capacity - b["used"], k)
            for k, b in enumerate(bins)
            if capacity - b["used"] >= length
            and (source is None or source not in b["sources"])
            and (cluster is None or cluster not in b["clusters"])
        ]
        k = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append({"used": 0, "sources": set(), "clusters": set()})
        b = bins[k]
        placed.append((k, b["used"]))
        b["used"] += length
        b["sources"].add(source)
        b["clusters"].add(cluster)
    return placed


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_equals_a_look_at_all_bins(seed):
    random_ = random.Random(seed)
    items = sorted(
        ((random_.randint(1, 100), random_.choice([None, "a", "a", "b", "c", "d"]), random_.choice([None, *range(40)])) for _ in range(400)),
        key=lambda i: -i[0],
    )
    assert packing.pack(*map(list, zip(*items)), 100) == plain_best_fit(items, 100)


@pytest.mark.parametrize("extra", [False, True])
def test_packed_documents(spark, extra):
    random_ = random.Random(3)
    texts = tables.ODD + [tables.sentence(random_, random_.randint(0, 150)) for _ in range(150)] + ["same copy"] * 20
    docs = tables.documents(spark, texts, extra)
    found = tables.rows(packing.pack_documents(docs, capacity=64, group_pieces=100))
    own, bins = defaultdict(list), defaultdict(list)
    for row in found:
        own[row["doc_id"]].append(row)
        bins[row["bin_id"]].append(row)
    source = {r.doc_id: r.source for r in docs.collect()}
    for i, text in enumerate(texts):
        parts = sorted(own[i], key=lambda r: r["piece"])
        n = len([w for w in (text or "").replace("\x0b", " ").split(" ") for w in w.split()]) + 1
        assert sum(r["n_tokens"] for r in parts) == n and len(parts) == parts[0]["n_pieces"] == -(-n // 64)
        assert [r["first_token"] for r in parts] == [64 * k for k in range(len(parts))]
    for held in bins.values():
        held.sort(key=lambda r: r["bin_offset"])
        assert [r["bin_offset"] for r in held] == [sum(x["n_tokens"] for x in held[:k]) for k in range(len(held))]
        assert sum(r["n_tokens"] for r in held) <= 64
        sources = [source[r["doc_id"]] for r in held if source[r["doc_id"]] is not None]
        copies = [hashlib.sha256((texts[r["doc_id"]] or "").encode()).digest() for r in held]
        assert len(set(sources)) == len(sources) and len(set(copies)) == len(copies)


def test_near_copies_share_no_sequence(spark):
    """Near duplicates that the caller knows are clusters; without them only exact copies are."""
    random_ = random.Random(8)
    base = [tables.sentence(random_, 100).split() for _ in range(4)]
    texts = [" ".join([*b[:-1], f"end{k}"]) for k in range(6) for b in base]  # last word changed, sources differ
    docs = tables.documents(spark, texts).withColumn("source", F.lit(None).cast("string"))
    docs = materialize(docs.coalesce(1), "near-copies")
    near = minhash.find_groups(docs).select("file_path", "row_index", F.col("component_id").alias("cluster"))
    bins = defaultdict(list)
    for row in tables.rows(packing.pack_documents(docs, clusters=near)):
        bins[row["bin_id"]].append(row["doc_id"] % 4)
    assert sum(map(len, bins.values())) == 24 and max(map(len, bins.values())) > 1
    assert all(len(set(held)) == len(held) for held in bins.values())


def test_assembled_sequences_hold_every_word(spark):
    texts = [tables.sentence(random.Random(i), i) for i in range(60)] + [None]
    docs = tables.documents(spark, texts)
    packed = packing.pack_documents(docs, capacity=32, group_pieces=30)
    sequences = tables.rows(packing.assemble(docs, packed))
    words = Counter(w for s in sequences for w in s["text"].split())
    assert words == Counter(w for t in texts for w in (t or "").split())
    assert all(s["n_tokens"] <= 32 for s in sequences)


def test_shards_keep_columns_of_any_name(spark):
    docs = tables.documents(spark, [f"text {i}" for i in range(40)]).selectExpr("*", "doc_id + 1 as curve_shard", "'s' as _slot", "2 as _own_place", "3 as _place")
    folder = new_path(spark, "test-shards")
    manifest = hilbert.write_shards(docs, folder, 4)
    assert manifest.agg({"n_rows": "sum"}).first()[0] == 40
    back = spark.read.parquet(f"{folder}/data")
    assert {r.doc_id: r.curve_shard for r in back.collect()} == {i: i + 1 for i in range(40)}
