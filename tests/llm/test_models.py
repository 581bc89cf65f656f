"""Language ID and the quality classifier: exact parts, held-out accuracy, odd inputs."""

import random
import zlib

import numpy as np
import pytest

from shopsight.llm import langid, quality, queries
from tests.llm import tables

SF = "/root/testdata/sf0.01"


def held(doc_id, of, rest):
    return zlib.crc32(str(doc_id).encode()) % of == rest


def test_filters_return_all_languages_that_hold_a_gram():
    members = {f"l{i:03d}": np.unique(np.random.default_rng(i).integers(0, 3000, 400).astype(np.uint64)) for i in range(70)}
    model = langid.build(sorted(members), members)
    assert model.slices.shape[0] == 2  # seventy languages need two words
    assert np.all(model.false_rates < 0.1)
    line = bytes(random.Random(0).choices(range(97, 123), k=300))
    found = langid.grams(line)
    own = langid.build(["a", "b"], {"a": found, "b": found[:100]})
    n, counts = langid.popcounts(own, line)
    assert n == 297 and counts[0] == 297
    expected = np.isin(found, found[:100]).sum()
    assert expected <= counts[1] <= expected + 20


def test_grams_are_all_windows():
    assert langid.grams(b"abcde").tolist() == [int.from_bytes(b"abcd", "big"), int.from_bytes(b"bcde", "big")]
    assert len(langid.grams(b"abc")) == 0


def test_language_accuracy_on_held_out_documents(spark):
    found = tables.by_id(queries.QUERIES["op4_language_id"](spark, SF))
    true = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert found.keys() == true.keys()
    assert all(r["held_out"] == held(d, 4, 2) and 0 <= r["score"] <= 1 for d, r in found.items())
    unseen = [found[d]["lang_pred"] == lang for d, lang in true.items() if held(d, 4, 2)]
    assert np.mean(unseen) > 0.97


def test_language_of_odd_texts(spark):
    words = {"en": ["the", "thing", "with"], "fr": ["élan", "queue", "très"]}
    random_ = random.Random(1)
    texts = [" ".join(random_.choices(words[("en", "fr")[i % 2]], k=20)) for i in range(40)]
    rows = [(i, t, ("en", "fr")[i % 2], None, 1) for i, t in enumerate(texts)]
    model = langid.train(spark.createDataFrame(rows, tables.DOCUMENT))
    odd = ["123 !?", None, "", "ж", "the " * 50_000, "très", "的", "A"]
    docs = tables.documents(spark, odd, extra=True)
    found = tables.by_id(langid.predict(docs, model))
    assert [found[i]["lang_pred"] for i in (0, 1, 2)] == ["und"] * 3 and found[0]["score"] == 0
    assert found[3]["lang_pred"] == "en"  # nothing known: the first by size, then name
    assert found[4]["lang_pred"] == "en" and found[5]["lang_pred"] == "fr" and found[6]["lang_pred"] in ("en", "fr")
    empty = langid.train(docs.where("doc_id < 0"))
    assert {r["lang_pred"] for r in tables.rows(langid.predict(docs, empty))} == {"und"}
    assert langid.predict(docs.where("doc_id < 0"), model).count() == 0


def test_quality_on_held_out_documents(spark):
    found = tables.by_id(queries.QUERIES["op6_quality"](spark, SF))
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(found) == 1000
    assert all(r["held_out"] == held(d, 3, 1) and r["predicted"] == (r["score"] >= 0.5) for d, r in found.items())
    unseen = [found[d]["predicted"] == q for d, q in labels.items() if held(d, 3, 1)]
    assert np.mean(unseen) > 0.95


def test_gradients_agree_with_differences():
    random_ = np.random.default_rng(5)
    sizes = np.array([3, 1, 4])
    first = np.append(0, np.cumsum(sizes)[:-1])
    x = random_.normal(size=(8, 5))
    y = np.array([1.0, 0.0, 1.0])
    shapes = {"W": (5, 4), "b": 4, "V": (4, 3), "U": (4, 3), "a": 3, "c": 4, "d": ()}
    w = {k: random_.normal(size=s) for k, s in shapes.items()}

    def loss(weights):
        p = quality._sigmoid(quality._forward(weights, x, first, sizes)["logit"])
        return -np.sum(y * np.log(p) + (1 - y) * np.log(1 - p))

    f = quality._forward(w, x, first, sizes)
    assert np.allclose(np.add.reduceat(f["alpha"], first), 1)
    found = quality._gradients(w, x, sizes, f, quality._sigmoid(f["logit"]) - y)
    for k in w:
        for at in np.ndindex(w[k].shape):
            up, down = {**w, k: w[k].copy()}, {**w, k: w[k].copy()}
            up[k][at] += 1e-6
            down[k][at] -= 1e-6
            assert (loss(up) - loss(down)) / 2e-6 == pytest.approx(float(np.asarray(found[k])[at]), abs=1e-5)


def test_attention_finds_the_one_bad_passage():
    random_ = random.Random(2)
    good = lambda: " ".join(tables.sentence(random_, 64 * 6).split())
    bad = lambda: "$$$ %%% " * 32
    texts = [good() + (" " + bad() + good() if i % 2 else "") for i in range(80)]
    bags = [quality.encode(t.encode()) for t in texts]
    y = np.array([1.0 - i % 2 for i in range(80)])
    model = quality.fit(bags[:60], y[:60])
    assert np.mean((quality.predict(model, bags[60:]) >= 0.5) == y[60:]) > 0.9


def test_quality_of_odd_texts_and_labels(spark):
    docs = tables.documents(spark, tables.ODD + ["plain words of a text"] * 5, extra=True)
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    one_class = spark.createDataFrame([(11, 1), (11, None), (12, 1), (None, 1)], "doc_id bigint, quality int")
    mixed = spark.createDataFrame([(11, 1), (4, 0), (4, 0), (12, 1), (7, 0)], "doc_id bigint, quality int")
    for labels, expected in ((none, 0.5), (one_class, 2.5 / 3), (mixed, None)):
        model = quality.train(docs, labels)
        found = tables.rows(quality.score(docs, model))
        assert len(found) == docs.count() and all(0 <= r["score"] <= 1 for r in found)
        assert expected is None or all(r["score"] == pytest.approx(expected) for r in found)
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r["doc_id"] for r in found if r["score"] >= 0.5}
    assert quality.score(docs.where("doc_id < 0"), model).count() == 0


def test_long_documents_are_trained_on(spark):
    good, bad = "a plain word of some text ", "$$$ %%% !!! "
    texts = [(bad if i % 2 else good) * (64 * 520 // 3) for i in range(12)]
    assert min(len(quality.encode(t.encode())) for t in texts) > 512
    docs = tables.documents(spark, texts)
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(12)], "doc_id bigint, quality int")
    found = tables.by_id(quality.score(docs, quality.train(docs, labels)))
    assert all((found[i]["score"] >= 0.5) == (i % 2 == 0) for i in range(12))


def test_training_on_spark_equals_training_on_the_driver(spark, monkeypatch):
    monkeypatch.setattr(quality, "EPOCHS", 4)
    random_ = random.Random(4)
    texts = [tables.sentence(random_, 64 * (1 + i % 7)) + " !!! $$$" * (40 * (i % 2)) for i in range(30)]
    docs = tables.documents(spark, texts)
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(30)], "doc_id bigint, quality int")
    one, two = quality.train(docs, labels), quality.train(docs, labels, driver_passages=10)
    assert one.prior == two.prior and np.allclose(one.mean, two.mean) and np.allclose(one.scale, two.scale)
    assert all(np.allclose(one.weights[k], two.weights[k], atol=1e-6) for k in one.weights)
    same = spark.createDataFrame([(i, 1) for i in range(30)], "doc_id bigint, quality int")
    assert quality.train(docs, same, driver_passages=10).prior == quality.train(docs, same).prior
