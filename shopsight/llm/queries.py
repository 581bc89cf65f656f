"""The registered queries of the training-data operators and, where SQL can state them, their oracles."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path as tokenizer_path
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsight.llm import decontaminate, dialogue_repair, exact_dedup, hilbert, langid, license_scan, minhash, oracles, packing, piece_codec, prefix_trie, quality, suffix_family, warc
from shopsight.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = oracles.ORACLES


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.find_copies(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_passages(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return decontaminate.digest(found)


@query
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(read_table(spark, sf_dir, "documents")).drop("spans")


@query
def op3_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hilbert.metadata(read_table(spark, sf_dir, "documents"))
    return hilbert.digest(hilbert.assign(rows, n_shards=16))


@query
def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.find_groups(read_table(spark, sf_dir, "documents"), words=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def _remainder(of: int) -> Column:
    """crc32 of the identifier as text, modulo `of`."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(of))


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = langid.train(docs.where(_remainder(4) != 2))
    return langid.predict(docs, model).select("doc_id", (_remainder(4) == 2).alias("held_out"), "lang_pred", "score")


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = quality.train(docs, read_table(spark, sf_dir, "labels").where(_remainder(3) != 1))
    return quality.score(docs, model).select(
        "doc_id", (_remainder(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archive_and_read(read_table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters are those of exact copies up to blanks; callers that know near duplicates pass `clusters`."""
    return packing.pack_documents(read_table(spark, sf_dir, "documents")).drop("file_path", "row_index")


@query
def op9_suffix_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_family.remove_repeats(read_table(spark, sf_dir, "documents"), with_text=False)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op12_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = piece_codec.Model(tokenizer_path("piece_bpe_32k.model"))
    return piece_codec.encode(read_table(spark, sf_dir, "documents"), model, decoded="decoded").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op13_dialogue_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations")
    found = dialogue_repair.audit(dialogue_repair.damaged(turns))
    every = turns.select("conv_id").distinct()
    joined = every.join(found.withColumnRenamed("conv_id", "own"), F.col("conv_id").eqNullSafe(F.col("own")), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.build_trie(read_table(spark, sf_dir, "conversations")).drop("node", "parent")
