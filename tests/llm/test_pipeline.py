"""The pipeline's stages one after the other on the smallest documents, each against a plain version."""

import re

import corpus_pipeline as pipeline
from clinloom.llm.common import new_store

from .conftest import prose
from .test_duplicates import brute_components

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs, store, kept = spark.read.parquet(f"{FOLDER}/documents.parquet"), new_store(spark), {}
    for name, stage in pipeline.STAGES:
        out = store.save(stage(spark, docs, FOLDER), "stage")
        kept[name] = docs, out
        if name != pipeline.STAGES[-1][0]:
            assert out.schema == docs.schema
        docs = out

    before, after = kept["near duplicates"]
    components = brute_components([(r["doc_id"], r["text"]) for r in before.collect()])
    assert {r["doc_id"] for r in after.collect()} == {c for _, _, c in components}

    before, after = kept["benchmark decontamination"]
    plain = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    items = [plain(r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert {r["doc_id"] for r in after.collect()} == {r["doc_id"] for r in before.collect() if not any(i in plain(r["text"]) for i in items)}

    before, after = kept["mixing sources"]
    ids = {r["doc_id"] for r in before.collect()}
    counts = [r["count"] for r in after.groupBy("doc_id").count().collect()]
    assert {r["doc_id"] for r in after.collect()} <= ids and max(counts) <= 3

    before, after = kept["sharding"]
    assert before.count() == after.count() and {r["shard"] for r in after.collect()} <= set(range(16))


def test_odd_and_no_documents(spark, odd, nothing):
    for given in (odd, nothing):
        docs, store = given, new_store(spark)
        for name, stage in pipeline.STAGES:
            out = store.save(stage(spark, docs, FOLDER), "stage")
            if name != pipeline.STAGES[-1][0]:
                assert out.columns == given.columns
            docs = out
        assert (docs.count() > 0) == (given.count() > 0)


def test_near_copies_go_row_by_row(spark):
    """Null and repeated ids: a row goes only if a near copy of its own text stays."""
    base, other, third = (prose(60, seed) for seed in (1, 2, 3))
    rows = [
        (1, base, "a"), (None, base, "b"), (None, other, "c"), (None, third, "d"), (5, other + " x", "e"), (5, prose(60, 4), "f"), (5, prose(60, 4), "g"),
        (7, base.upper(), "h"), (8, None, "i"), (8, None, "j"), (9, "", "k"), (10, "one two", "l"), (11, "ONE  two", "m"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row string").repartition(4).withColumnRenamed("_row", "source")
    kept = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["source"]) for r in pipeline.near_duplicate_stage(spark, docs, FOLDER).collect())
    wanted = {"a", "d", "e", "i", "j", "k", "l"}
    assert {k[2] for k in kept} - {"f", "g"} == wanted and len({k[2] for k in kept} & {"f", "g"}) == 1 and len(kept) == 8
