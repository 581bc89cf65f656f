"""Exact, near and substring deduplication against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from shopsight.llm import exact_dedup, minhash, suffix_family
from shopsight.llm.common import components
from shopsight.sources.scratch import new_path
from tests.llm import tables

BLANK = re.compile(r"[\x20\x09-\x0D]+")


@pytest.mark.parametrize("extra", [False, True])
def test_exact_copies(spark, extra):
    random_ = random.Random(3)
    base = [tables.sentence(random_, 5) for _ in range(6)]
    texts = tables.ODD + [random_.choice(base).replace(" ", random_.choice([" ", "\n", "  ", "\t "])) for _ in range(60)]
    pairs = [(i, t) for i, t in enumerate(texts)] + [(None, base[0]), (None, "only nulls"), (None, "only nulls")]
    docs = tables.documents(spark, pairs, extra)
    groups = {}
    for i, t in pairs:
        groups.setdefault(BLANK.sub(" ", t or ""), []).append(i)
    found = tables.rows(exact_dedup.find_copies(docs))
    assert len(found) == len(pairs) and sum(r["kept"] for r in found) == len(groups)
    sizes = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in groups.items()}
    for row in found:
        members = sizes[row["text_sha256"]]
        assert row["group_size"] == len(members)
        assert row["keep_id"] == min((m for m in members if m is not None), default=None)
        assert row["doc_id"] is None or row["kept"] == (row["doc_id"] == row["keep_id"])
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns and left.count() == len(groups)


def test_texts_with_one_digest_are_told_apart(spark, monkeypatch):
    """A digest that collides by construction: groups still follow the bytes."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(exact_dedup.F, "sha2", lambda column, bits: F.lit("same"))
    docs = tables.documents(spark, ["aa", "bb", "aa", "bb", "cc", "ddd"])
    found = tables.by_id(exact_dedup.find_copies(docs))
    assert [found[i]["keep_id"] for i in range(6)] == [0, 1, 0, 1, 4, 5]
    assert [found[i]["group_size"] for i in range(6)] == [2, 2, 2, 2, 1, 1]
    assert [found[i]["kept"] for i in range(6)] == [True, True, False, False, True, True]


def test_state_carries_over_to_later_batches(spark):
    dedup = exact_dedup.Deduplicator(spark, new_path(spark, "test-state"))
    dedup.add(tables.documents(spark, [(5, "a  b"), (6, "c")]))
    state = {r.text_sha256: r for r in dedup.add(tables.documents(spark, [(3, "a b"), (9, "d")])).collect()}
    assert len(state) == 3
    seen = state[hashlib.sha256(b"a b").hexdigest()]
    assert seen.group_size == 2 and seen.keep.doc_id == 3


def test_a_batch_counts_once_and_is_decided_by_bytes(spark):
    dedup = exact_dedup.Deduplicator(spark, new_path(spark, "test-state"))
    first = tables.documents(spark, [(5, "a  b"), (6, "c"), (None, "only null")])
    second = tables.documents(spark, [(3, "a b"), (9, "d"), (10, "c"), (11, None), (12, "")])
    for batch in (first, first, second, second):
        state = {r.text_sha256: r for r in dedup.add(batch).collect()}
    assert sorted(r.group_size for r in state.values()) == [1, 1, 2, 2, 2]
    found = tables.by_id(dedup.decide(second, _with_places(spark, first, second)))
    assert {i: (r["keep_id"], r["kept"], r["group_size"]) for i, r in found.items()} == {
        3: (3, True, 2), 9: (9, True, 1), 10: (6, False, 2), 11: (11, True, 2), 12: (11, False, 2),
    }


def _with_places(spark, *tables_):
    return spark.read.parquet(*[f.rpartition("/")[0] for t in tables_ for f in t.inputFiles()[:1]])


def near_brute(texts, words, percent):
    sets = []
    for t in texts:
        w = [x for x in BLANK.split((t or "").encode().lower().decode()) if x]
        n = min(words, len(w))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [len(s) for s in sets], [find(i) for i in range(len(texts))]


def edited(random_, text, edits):
    w = text.split()
    for _ in range(edits):
        w[random_.randrange(len(w))] = random_.choice(["zz", "yy", "xx"])
    return " ".join(w)


@pytest.mark.parametrize("words,extra", [(4, False), (5, True)])
def test_near_copies_equal_brute_force(spark, words, extra):
    random_ = random.Random(words)
    base = [tables.sentence(random_, 80) for _ in range(4)]
    texts = list(tables.ODD)
    for b in base:
        texts += [b, b, b.upper()] + [edited(random_, b, random_.randint(1, 6)) for _ in range(30)]
    texts += [f"{tables.sentence(random_, 12)} {base[0][:120]}" for _ in range(20)]  # a passage in common
    texts += ["a b c", "A b  c", "a b", "é b c d e f"]
    docs = tables.documents(spark, texts, extra)
    sizes, roots = near_brute(texts, words, 80)
    found = tables.by_id(minhash.find_groups(docs, words))
    assert [found[i]["n_shingles"] for i in range(len(texts))] == sizes
    assert [found[i]["component_id"] for i in range(len(texts))] == roots
    assert [found[i]["kept"] for i in range(len(texts))] == [r == i for i, r in enumerate(roots)]
    left = minhash.drop_near_copies(docs, words)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == set(roots)


def test_last_round_keeps_pairs_whose_cut_shingles_merge(spark):
    # Nine of ten shingles are common; two of them merge when cut, which leaves seven cut values.
    planes, marks = [0] * minhash.N_PLANES, [5] * minhash.LAST_POSTED
    members = [(1, 10, b"", planes, marks, [*range(7), 100]), (2, 10, b"", planes, marks, [*range(7), 200])]
    members += [(3, 10, b"", planes, marks, [*range(6), *range(300, 304)])]  # nothing merges: six common of fourteen
    members = spark.createDataFrame(members, minhash.MEMBER)
    labels = spark.createDataFrame([], "node bigint, component bigint")
    found = minhash._cross_pairs(labels, members, 80).collect()
    assert {tuple(sorted((r.a, r.b))) for r in found} == {(1, 2)}


def test_repeated_rows_leave_one(spark):
    docs = tables.documents(spark, ["one two three four five six", "other words than those before them"], repeat=True)
    assert minhash.drop_near_copies(docs).count() == 2
    assert exact_dedup.drop_copies(docs).count() == 2


def test_miss_probability():
    from math import comb

    chance = 1 / 2**minhash.PLANES
    for n, t, p in (
        (minhash.COORDINATES, minhash.MATCHES, 0.8),
        (minhash.ALL_COORDINATES, minhash.ALL_MATCHES, 0.8 + 0.2 * chance),
        (minhash.LAST_POSTED, 1, 0.8),
    ):
        assert sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(t)) < 1.5e-6


def test_bit_planes():
    values = np.random.default_rng(0).integers(0, 2**32, 64, dtype=np.uint32)
    found = minhash.bit_planes(values, 32)
    for j in (0, 5, 31):
        assert [(int(found[j]) >> c) & 1 for c in range(64)] == [(int(v) >> j) & 1 for v in values]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 30)] + [(50, 51), (51, 50), (3, 3)]
    found = components(spark.createDataFrame(links, "a bigint, b bigint"))
    expected = {i: 100 for i in range(100, 161)} | {i: 7 for i in range(7, 30)} | {50: 50, 51: 50}
    assert {r.node: r.component for r in found.collect()} == expected


def repeats_brute(pairs, length=50):
    first = {}
    order = [(float("inf") if d is None else d, (t or "").encode()) for d, t in pairs]
    for d, b in order:
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            first[w] = min(first.get(w, float("inf")), d)
    out = []
    for d, b in order:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < d:
                gone[i : i + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeats_equal_brute_force(spark, monkeypatch, seed):
    if seed == 3:  # many chunks and buckets, blocks that end within windows
        monkeypatch.setattr(suffix_family, "CHUNK_BYTES", 600)
        monkeypatch.setattr(suffix_family, "BLOCK", 97)
        monkeypatch.setattr(suffix_family, "BUCKET_KEYS", 50)
    random_ = random.Random(seed)
    base = [tables.sentence(random_, 60) for _ in range(4)]
    texts = [None, "", "short", "é" * 40, "a" * 49, "a" * 50, "a" * 200, "ab" * 60, "x" * 4000, "x" * 51]
    for _ in range(60):
        parts = []
        for _ in range(random_.randint(1, 4)):
            b = random_.choice(base)
            a = random_.randrange(len(b))
            parts += [tables.sentence(random_, random_.randint(0, 12)), b[a : a + random_.choice([30, 49, 50, 51, 80, 300])]]
        texts.append(" ".join(parts))
    texts += [texts[20], texts[30] + ".", base[0], base[0]]
    ids = list(range(len(texts)))
    random_.shuffle(ids)
    pairs = [*zip(ids, texts), (ids[12], texts[13]), (None, base[0]), (None, base[1] + base[0])]
    docs = tables.documents(spark, pairs, extra=seed == 2)
    found = tables.rows(suffix_family.remove_repeats(docs))
    expected = sorted((repr(d), *r) for (d, _), r in zip(pairs, repeats_brute(pairs)))
    assert sorted((repr(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found) == expected
    for row in found:
        assert len(row["spans"]) == row["n_spans"] and hashlib.sha256(row["kept"]).hexdigest() == row["kept_sha256"]


def test_family_keeps_few_levels():
    family, everything = suffix_family.Family(), {}
    random_ = np.random.default_rng(4)
    for n in range(64):
        keys = np.unique(random_.integers(0, 5000, 200).astype(np.uint64))
        family.add(keys, np.full(len(keys), 64 - n))
        everything.update({int(k): 64 - n for k in keys})
        sizes = [len(k) for k, _ in family.levels]
        assert all(a > 2 * b for a, b in zip(sizes, sizes[1:]))
    asked = np.arange(5000, dtype=np.uint64)
    expected = [everything.get(int(k), suffix_family.LAST) for k in asked]
    assert family.smallest(asked).tolist() == expected


def test_empty_tables(spark):
    docs = tables.documents(spark, ["some text"]).where("doc_id < 0")
    assert exact_dedup.find_copies(docs).count() == 0
    assert minhash.find_groups(docs).count() == 0
    assert suffix_family.remove_repeats(docs).count() == 0
