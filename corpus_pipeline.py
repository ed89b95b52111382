"""The corpus pipeline: toxicity, quality rules, near duplicates, packing.

Each stage takes the rows its predecessor kept, written as Parquet in the shared scratch folder and
read again, so a lost executor costs a reread of one stage's output. All but the last return the
columns they were given. Rows are judged, never looked up by id, so NULL or repeated ids pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.llm import packing, quality_rules, simhash_dedup, toxicity
from aerolake.llm.common import learns_from, quoted, spare_name, table
from aerolake.llm.queries import PACKING_TOKENIZER, tokenizer_path
from aerolake.session import delete_folder, scratch_path, scratch_scope


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier does not call toxic; it learns from the labelled rows outside the held-out fifth."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), learns_from(F.col("doc_id"), 5, 0))
    score = spare_name(docs, "_toxicity")
    scored = toxicity.with_toxicity(docs, model, "text", score)
    return scored.where(quoted(score) < toxicity.THRESHOLD).select(*[quoted(c) for c in docs.columns])


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the thresholds of their language and source."""
    return quality_rules.keep_good(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of SimHash near-duplicates."""
    return simhash_dedup.keep_one_of_each(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the remaining documents and their places in sequences of 4096."""
    return packing.pack_documents(docs, tokenizer_path(PACKING_TOKENIZER), keep_ids=False)


STAGES = [("toxicity", drop_toxic), ("quality rules", keep_good_quality),
          ("SimHash near-dedup", drop_near_duplicates), ("best-fit packing", pack_sequences)]

#: Compression lengths, KLL sketches and bin packing are not SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, whole texts of any length (an empty one is a text). Of what a stage writes, only its result
    stays, until the next one is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, "pipeline-" + name.replace(" ", "-").lower())
        with scratch_scope(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if before:
            delete_folder(spark, before)
        before = path
    packed = STAGES[-1][1](spark, docs, sf_dir)  # it has written its pieces
    delete_folder(spark, before)
    return packed
