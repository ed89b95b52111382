from __future__ import annotations

from collections import defaultdict

import pytest
from llm_cases import hard_docs, no_docs
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from aerolake.llm.common import staged
from aerolake.llm.queries import op2_simhash_near_dedup, op8_toxicity, op10_quality_rules

SF = "/root/testdata/sf0.01"


def test_registered():
    found = entry.queries()
    assert [n.split("_")[0] for n in found if n.startswith("op")] == [f"op{i}" for i in range(1, 14)] and "pipeline" in found
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality rules", "SimHash near-dedup", "best-fit packing"]


def test_stages_take_effect(spark):
    """Each stage, on the documents themselves, keeps what its operator's query says."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    toxicity, quality, dedup, _ = (f for _, f in corpus_pipeline.STAGES)
    assert ids(toxicity(spark, docs, SF)) == ids(op8_toxicity(spark, SF).where("predicted = 0"))
    assert ids(quality(spark, docs, SF)) == ids(op10_quality_rules(spark, SF).where("kept"))
    assert ids(dedup(spark, docs, SF)) == ids(op2_simhash_near_dedup(spark, SF).where("doc_id = component_id"))


def test_run_packs_what_the_stages_keep(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = staged(stage(spark, docs, SF), "t")
        assert docs.columns == columns
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in out} == {r["doc_id"] for r in docs.collect()}
    fill = defaultdict(int)
    for r in out:
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= 4096


@pytest.mark.parametrize("which", ["hard", "clashing", "none"])
def test_stages_on_hard_rows(spark, which):
    docs = no_docs(spark) if which == "none" else hard_docs(spark, which == "clashing")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns, before = docs.columns, docs.count()
        docs = staged(stage(spark, docs, SF), "t")
        assert docs.columns == columns and docs.count() <= before
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).agg(F.count(F.lit(1)).alias("n")).first()["n"] >= docs.count()
