"""Subword encoding by distinct words against the library on whole texts."""

import hashlib
import random

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from shopsight.llm import piece_codec, queries
from tests.llm import tables

PATH = public_tokenizers.path("piece_bpe_32k.model")
LETTERS = " ab▁\n\té日\x00<s>　😀."


@pytest.fixture(scope="module")
def model():
    return piece_codec.Model(PATH)


def texts():
    random_ = random.Random(5)
    odd = ["<s> </s> <unk> <0x0A>", " ", "  ", "▁", "a▁▁b ", "z" * 1000 + " " + "é" * 700, " z" * 300]
    return tables.ODD + odd + ["".join(random_.choices(LETTERS, k=random_.randint(0, 30))) for _ in range(300)]


@pytest.mark.parametrize(("block", "bucket", "extra"), [(16 << 20, 64 << 20, False), (1500, 3000, True)])
def test_ids_and_texts_are_those_of_the_library(spark, model, block, bucket, extra):
    """Many blocks and buckets, or one of each, give the same rows."""
    given = texts()
    library = SentencePieceProcessor(model_file=PATH)
    encoded = piece_codec.encode(tables.documents(spark, given, extra), model, block, bucket)
    found = tables.by_id(piece_codec.decode(encoded, model))
    assert len(found) == len(given)
    for i, text in enumerate(given):
        ids = library.encode(text or "")
        assert (found[i]["ids"], found[i]["decoded"]) == (ids, library.decode(ids))


def test_repeated_rows_and_empty_table(spark, model):
    docs = tables.documents(spark, [(1, "one two"), (None, "one"), (None, None)], repeat=True)
    assert sorted(len(r["ids"]) for r in tables.rows(piece_codec.encode(docs, model))) == [0, 0, 1, 1, 2, 2]
    assert piece_codec.encode(docs.limit(0), model).count() == 0


def test_pieces_across_markers_are_refused(monkeypatch):
    class Crossing(SentencePieceProcessor):
        def id_to_piece(self, i):
            return "a▁b" if i == 7 else super().id_to_piece(i)

    monkeypatch.setattr(piece_codec, "_processor", lambda proto: Crossing(model_proto=proto))
    with pytest.raises(ValueError, match="across whitespace"):
        piece_codec.Model(PATH)


def test_query_against_the_library(spark):
    library = SentencePieceProcessor(model_file=PATH)
    folder = "/root/testdata/sf0.001"
    found = tables.by_id(queries.op12_piece_codec(spark, folder))
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(found) == len(docs)
    for doc in docs:
        ids = library.encode(doc.text or "")
        row = found[doc.doc_id]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
