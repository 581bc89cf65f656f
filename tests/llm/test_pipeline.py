"""The corpus pipeline and the registry of its operators."""

import __spark_entry__ as contract
import corpus_pipeline
from shopsight.llm import decontaminate, queries
from shopsight.sources.scratch import materialize
from tests.llm.test_dedup import near_brute
from tests.llm.test_scans import brute_hits

SF = "/root/testdata/sf0.001"


def test_registered_queries():
    found = contract.queries()
    assert [f"op{n}" for n in range(1, 14)] == sorted({n.split("_")[0] for n in queries.QUERIES}, key=lambda n: int(n[2:]))
    assert set(queries.QUERIES) | {"pipeline"} <= set(found)
    assert set(queries.ORACLES) <= set(contract.oracle_sql())


def test_stages_take_effect(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_dedup", "near_dedup", "decontamination", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = [set(texts)]
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = materialize(stage(spark, docs, SF), f"test-{name}")
        kept.append({r.doc_id for r in docs.select("doc_id").collect()})
        if name != "packing":
            assert docs.columns == before.columns and docs.count() == len(kept[-1])
    good, exact, near, clean, packed = kept[1:]
    judged = [(labels[d] == 1) == (d in good) for d in labels]
    assert sum(judged) / len(judged) > 0.95

    first = {}
    for d in sorted(good):
        first.setdefault(" ".join((texts[d] or "").split()), d)
    assert exact == set(first.values())

    order = sorted(exact)
    _, roots = near_brute([texts[d] for d in order], 5, 80)
    assert near == {order[r] for r in roots}
    assert clean == {d for d in near if not brute_hits(texts[d], items, decontaminate.WINDOW_WORDS)[1]}
    assert packed == clean
