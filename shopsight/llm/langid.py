"""Language identification with bit-sliced Bloom filters over n-grams.

Every language has a Bloom filter of the n-grams common in it. The filters are
stored bit-sliced: for each bit position, one word whose bit l belongs to language
l. A lookup of an n-gram is the AND of the words at its hash positions and yields
the mask of all languages that hold it. A text's n-grams are looked up at once;
per-language popcounts of the masks, corrected for the filters' rates of false
positives, decide.

Training takes a sample of about `MAX_DOCUMENTS` labelled documents per language,
drawn by a hash; n-grams are counted by document, combined before the shuffle, and
kept if they occur in `MIN_SHARE` of their language's sampled documents, so the
model's size is bounded by the n-grams per document over MIN_SHARE. Prediction runs
where the texts lie and covers whole texts.

Defined cases: a null text, or one without a letter, is `und` with score 0; a text
whose n-grams are all unknown gets the language with most training documents;
ties go to the language with more training documents, then the smaller name;
without any training document every text is `und`; repeated documents get equal
answers; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import string
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsight.llm.common import map_arrow, utf8
from shopsight.llm.fingerprint import mix

GRAM_BYTES = 4
MAX_DOCUMENTS = 4000
MIN_SHARE = 0.005
HASHES = 3
BITS_PER_GRAM = 12
MAX_LOG_BITS = 24
UNKNOWN = "und"

_LETTERS = bytes.maketrans(
    bytes(b for b in range(0x80) if chr(b) not in string.ascii_letters),
    b" " * sum(chr(b) not in string.ascii_letters for b in range(0x80)),
)
_ASCII_LETTER = re.compile(rb"[a-z]")


def letters(text: bytes | None) -> bytes:
    """Lower-cased words of letters between single spaces; empty if there is no letter."""
    if not text:
        return b""
    lowered = text.decode("utf-8", "replace").lower()
    line = b" ".join(lowered.encode().translate(_LETTERS).split())
    if not _ASCII_LETTER.search(line) and not any(c.isalpha() for c in lowered):
        return b""
    return b" " + line + b"  " if line else b""


def grams(line: bytes) -> np.ndarray:
    """All windows of GRAM_BYTES bytes, as integers."""
    b = np.frombuffer(line, np.uint8).astype(np.uint64)
    n = len(b) - GRAM_BYTES + 1
    out = np.zeros(max(n, 0), np.uint64)
    for i in range(GRAM_BYTES):
        out = (out << np.uint64(8)) | b[i : i + len(out)]
    return out


class Model(NamedTuple):
    """`slices[w, p]`: word w of bit position p; languages in order of preference."""

    languages: list[str]
    slices: np.ndarray
    false_rates: np.ndarray


def _positions(found: np.ndarray, log_bits: int) -> list[np.ndarray]:
    h, g = mix(found), mix(found ^ np.uint64(0x5851F42D4C957F2D)) | np.uint64(1)
    shift = np.uint64(64 - log_bits)
    return [(h + np.uint64(i) * g) >> shift for i in range(HASHES)]


def build(languages: list[str], members: dict[str, np.ndarray]) -> Model:
    most = max((len(m) for m in members.values()), default=1)
    log_bits = min(MAX_LOG_BITS, max(10, int(np.ceil(np.log2(most * BITS_PER_GRAM + 1)))))
    table = np.zeros((-(-len(languages) // 64), 1 << log_bits), np.uint64)
    rates = np.zeros(len(languages))
    for number, language in enumerate(languages):
        word, bit = table[number // 64], np.uint64(1 << (number % 64))
        for at in _positions(members.get(language, np.zeros(0, np.uint64)), log_bits):
            word[at] |= bit
        rates[number] = np.mean((word & bit) != 0) ** HASHES
    return Model(languages, table, rates)


def popcounts(model: Model, line: bytes) -> tuple[int, np.ndarray]:
    """Number of n-grams, and how many of them each language's filter holds."""
    found = grams(line)
    at = _positions(found, int(model.slices.shape[1]).bit_length() - 1)
    counts = np.zeros(len(model.languages))
    for number in range(len(model.languages)):
        if number % 64 == 0:
            words = model.slices[number // 64]
            mask = words[at[0]]
            for positions in at[1:]:
                mask = mask & words[positions]
        counts[number] = np.count_nonzero(mask & np.uint64(1 << (number % 64)))
    return len(found), counts


def decide(model: Model, text: bytes | None) -> tuple[str, float]:
    line = letters(text)
    if not line or not model.languages:
        return UNKNOWN, 0.0
    n, counts = popcounts(model, line)
    rates = np.minimum(model.false_rates, 0.999)
    share = np.clip((counts / n - rates) / (1 - rates), 0, 1)
    total = share.sum()
    best = int(np.argmax(share))  # the first of equals, in order of preference
    return model.languages[best], float(share[best] / total) if total > 0 else 0.0


def _counted(batch: pa.RecordBatch) -> pa.RecordBatch | None:
    """(lang, gram, documents) of a batch."""
    by_language: dict[str, list[np.ndarray]] = {}
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        by_language.setdefault(lang, []).append(np.unique(grams(letters(text))))
    names, found, times = [], [], []
    for lang, parts in by_language.items():
        own, n = np.unique(np.concatenate(parts), return_counts=True)
        names.extend([lang] * len(own))
        found.append(own)
        times.append(n)
    columns = [pa.array(names, pa.string()), pa.array(np.concatenate(found).view(np.int64)), pa.array(np.concatenate(times))]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "n"])


def train(docs: DataFrame, max_documents: int = MAX_DOCUMENTS) -> Model:
    """Learn from the rows of `docs` with a language, text included; nothing else is read."""
    labelled = docs.where("lang is not null and text is not null").select("doc_id", F.col("lang").cast("string"), "text")
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("total"))
    found = sizes.collect()  # one row per language
    if not found:
        return Model([], np.zeros((1, 1024), np.uint64), np.zeros(0))
    order = [r.lang for r in sorted(found, key=lambda r: (-r.total, r.lang))]
    parts = 1 << 30
    shares = [(r.lang, int(min(1.0, max_documents / r.total) * parts)) for r in found]
    spark = docs.sparkSession
    limits = F.broadcast(spark.createDataFrame(shares, "lang string, below long"))
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.length("text")), F.lit(parts)) < F.col("below")
    drawn = labelled.join(limits, "lang").where(draw).select("lang", utf8("text"))
    counted = map_arrow(drawn, _counted, "lang string, gram long, n long")
    counted = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    expected = {r.lang: min(r.total, max_documents) for r in found}
    least = F.broadcast(
        spark.createDataFrame([(k, max(1, int(MIN_SHARE * v))) for k, v in expected.items()], "lang string, least long")
    )
    kept = counted.join(least, "lang").where("n >= least").select("lang", "gram").toPandas()
    members = {lang: rows["gram"].to_numpy().view(np.uint64) for lang, rows in kept.groupby("lang")}
    return build(order, members)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, lang_pred, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most 2^MAX_LOG_BITS words per 64 languages

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        answers = [decide(shared.value, text) for text in batch.column(1).to_pylist()]
        names, scores = zip(*answers)
        made = [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
        return pa.RecordBatch.from_arrays(made, names=["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text"))
    return map_arrow(rows, run, "doc_id long, lang_pred string, score double")
