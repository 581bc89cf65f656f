"""License scan and decontamination against brute force."""

import hashlib
import random
import re

import pytest

from shopsight.llm import decontaminate, license_scan
from tests.llm import tables

BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


LICENSES = [
    "Released under the MIT License.", "gnu, GENERAL\npublic--license; Apache License cc by cc-by-nc", "limit licenses",
    "GNU Genral Public Licence", "apache licence", "the mit licensee", "cc by", "CC\x00BY", "é cc by é", "mit license mit license",
    "gnu general public license gnu general public license", "apache", "License Apache", "cc  by" * 3,
]


@pytest.mark.parametrize("extra", [False, True])
def test_license_scan_equals_brute_force(spark, extra):
    random_ = random.Random(1)
    pieces = ["mit", "license", "cc", "by", "apache", "gnu", "general", "public", "x", "É", "-", "licence"]
    texts = tables.ODD + LICENSES + [" ".join(random_.choices(pieces, k=60)) for _ in range(60)]
    docs = tables.documents(spark, texts, extra, repeat=extra)
    found = tables.rows(license_scan.scan_licenses(docs))
    assert len(found) == docs.count()
    for row in found:
        own = words(texts[row["doc_id"]])
        places = [
            (i, label)
            for phrase, label in BASE.items()
            for i in range(len(own))
            if own[i : i + len(phrase.split())] == phrase.split()
        ]
        assert row["n_words"] == len(own) and row["n_base"] == len(places)
        assert row["first_word"] == min((i for i, _ in places), default=None)
        assert row["last_word"] == max((i for i, _ in places), default=None)
        assert row["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert set(row["base_labels"].split(",")) - {""} <= set(row["labels"].split(","))
        assert 0 <= row["score"] <= 1
        raw = (texts[row["doc_id"]] or "").encode()
        for span in row["spans"]:
            inside = words(raw[span["start"] : span["end"]].decode())
            assert inside == own[span["first_word"] : span["last_word"] + 1]


def test_fuzzy_notices_within_their_edits(spark):
    texts = ["GNU Genral Public Licence", "gnu generic private license", "apache licenze", "apache lizenze", "mit licenze"]
    found = tables.by_id(license_scan.scan_licenses(tables.documents(spark, texts)))
    assert [found[i]["labels"] for i in range(5)] == ["gpl", "", "apache", "", "mit"]
    assert [found[i]["n_base"] for i in range(5)] == [0] * 5
    assert found[0]["spans"][0]["edits"] == 2


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_no_notice_within_its_edits_is_missed():
    """Random edits of every notice, between random words: the labels are those of all runs of words."""
    random_ = random.Random(12)
    scanner = license_scan.Scanner()
    letters = "aeilnrst "
    for case in range(4000):
        notice = random_.choice(license_scan.NOTICES)
        phrase = notice.phrase
        for _ in range(random_.randint(0, notice.edits + 1)):
            at = random_.randrange(len(phrase))
            phrase = phrase[:at] + random_.choice(["", random_.choice(letters), random_.choice(letters) + phrase[at]]) + phrase[at + 1 :]
        before, after = ([random_.choice(["see", "the", "a", "of", "words"]) for _ in range(random_.randint(0, 3))] for _ in range(2))
        own = " ".join([*before, *phrase.split(), *after])
        cuts = own.split(" ")
        expected = set()
        for n in license_scan.NOTICES:
            runs = (" ".join(cuts[i:j]) for i in range(len(cuts)) for j in range(i + 1, len(cuts) + 1))
            if any(abs(len(r) - len(n.phrase)) <= n.edits and distance(r, n.phrase) <= n.edits for r in runs):
                expected.add((n.label, n.phrase))
        _, spans = scanner.scan(own.encode())
        assert {(s.label, s.phrase) for s in spans} == expected, own
        for s in spans:
            assert distance(" ".join(cuts[s.first_word : s.last_word + 1]), s.phrase) == s.edits, own


def brute_hits(text, items, n=10):
    own, hit, named = words(text), set(), set()
    for item, body in items:
        parts = words(body)
        for at in range(max(1, len(parts) - n + 1) if parts else 0):
            window = parts[at : at + n]
            for i in range(len(own) - len(window) + 1):
                if own[i : i + len(window)] == window:
                    hit |= set(range(i, i + len(window)))
                    named.add(str(item))
    return own, hit, named


@pytest.fixture(scope="module")
def benchmark_case(spark):
    random_ = random.Random(2)
    items = [(i, tables.sentence(random_, random_.choice([1, 3, 9, 10, 11, 30]))) for i in range(25)]
    items += [(90, None), (91, ""), (92, "..."), (93, items[3][1]), (None, "null item of more than ten words in all that is planted here")]
    texts = list(tables.ODD)
    for _ in range(60):
        body = tables.sentence(random_, 30).split()
        at = random_.randint(0, 30)
        planted = (random_.choice(items)[1] or "").split()
        cut = random_.choice([0, 0, 1])
        texts.append(" ".join(body[:at] + planted[cut:] + body[at:]).title())
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    return items, texts, benchmark


@pytest.mark.parametrize("block,extra", [(decontaminate.BLOCK_WINDOWS, False), (20, True)])
def test_decontamination_equals_brute_force(spark, benchmark_case, block, extra):
    items, texts, benchmark = benchmark_case
    docs = tables.documents(spark, texts, extra)
    named_items = [(i, t) for i, t in items if i is not None]
    benchmark = benchmark.where("item_id is not null")
    found = tables.by_id(decontaminate.find_passages(docs, benchmark, block_windows=block))
    digests = tables.by_id(decontaminate.digest(decontaminate.find_passages(docs, benchmark, block_windows=block)))
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        own, hit, named = brute_hits(text, named_items)
        assert (found[i]["n_words"], found[i]["n_hit"], found[i]["n_items"]) == (len(own), len(hit), len(named))
        assert digests[i]["items_sha256"] == hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        assert digests[i]["contaminated"] == bool(hit)


def test_removing_documents_and_passages(spark, benchmark_case):
    items, texts, benchmark = benchmark_case
    docs = tables.documents(spark, texts, extra=True)
    clean = decontaminate.drop_contaminated(docs, benchmark)
    assert clean.columns == docs.columns
    dirty = {i for i, t in enumerate(texts) if brute_hits(t, items)[1]}
    assert {r.doc_id for r in clean.collect()} == set(range(len(texts))) - dirty
    for blocks in (decontaminate.BLOCK_WINDOWS, 20):
        cut = tables.by_id(decontaminate.remove_passages(docs, benchmark, block_windows=blocks))
        assert len(cut) == len(texts)
        for i, text in enumerate(texts):
            own, hit, _ = brute_hits(text, items)
            assert words(cut[i]["text"]) == [w for k, w in enumerate(own) if k not in hit]
            assert i in dirty or cut[i]["text"] == text


def test_empty_tables(spark, benchmark_case):
    docs, none = tables.documents(spark, ["some text"]), spark.createDataFrame([], "item_id bigint, text string")
    assert license_scan.scan_licenses(docs.limit(0)).count() == 0
    assert decontaminate.find_passages(docs.limit(0), benchmark_case[2]).count() == 0
    assert tables.rows(decontaminate.digest(decontaminate.find_passages(docs, none)))[0]["contaminated"] is False
    assert decontaminate.drop_contaminated(docs, none).count() == 1


def test_cut_texts_keep_columns_of_any_name(spark):
    docs = tables.documents(spark, ["x " + " ".join("abcdefghij") + " y", "clean", None]).selectExpr("*", "1 as spans", "'r' as _row", "2 as body", "3 as doc", "4 as n_hit")
    items = spark.createDataFrame([(1, " ".join("abcdefghij"))], "item_id long, text string")
    left = decontaminate.remove_passages(docs, items)
    assert left.columns == docs.columns
    rows = {r.doc_id: r for r in left.collect()}
    assert [rows[i].text for i in range(3)] == ["x  y", "clean", None]
    assert all((r.spans, r._row, r.body, r.doc, r.n_hit) == (1, "r", 2, 3, 4) for r in rows.values())
