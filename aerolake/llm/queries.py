"""The registered queries of this folder: each operator over its whole table, and the pipeline.

The tables have no fetch times and no dated lists, so the URL query derives both from the pages
themselves by md5 (which DuckDB has too): a day of 2024 for each page, and add and remove entries for
its hosts, URLs and a domain.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.llm import (conversation_repair, filter_audit, langid, license_scan, lsh_forest, packing, personal_data,
                          quality_rules, simhash_dedup, subword_sampling, suffix_tree_lm, toxicity, url_lists)
from aerolake.llm.common import held_out, learns_from, staged, table

PACKING_TOKENIZER, SUBWORD_MODEL = "word_bpe_49k.json", "piece_bpe_32k.model"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.near_duplicate_classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _hex_number(text: Column, start: int, size: int) -> Column:
    return F.conv(F.substring(F.md5(text.cast("binary")), start, size), 16, 10).cast("int")


def _at(day: Column) -> Column:
    return F.timestamp_seconds(F.lit(1704067200).cast("long") + day.cast("long") * 86400)


def captures_of(pages: DataFrame) -> DataFrame:
    """Pages with a fetch time, a whole hour of 2024."""
    key = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    hours = _hex_number(key, 1, 7) % 8784
    return pages.select("page_id", "url", F.timestamp_seconds(F.lit(1704067200).cast("long") + hours.cast("long") * 3600).alias("fetched_at"))


def entries_of(pages: DataFrame) -> DataFrame:
    """Dated entries: two thirds of the hosts come and go, some URLs stay listed, one domain is listed for a week."""
    hosts = pages.select(url_lists.host_of(F.col("url")).alias("pattern")).where("pattern != ''").distinct()
    h = F.col("pattern")
    first = _hex_number(h, 2, 3) % 200
    gone = first + 20 + _hex_number(h, 5, 3) % 60
    again = gone + 10 + _hex_number(h, 8, 3) % 90
    by_host = hosts.where(_hex_number(h, 1, 1) < 10).select(F.explode(F.array(
        *[F.struct(F.lit("hosts").alias("list_name"), F.lit("host").alias("kind"), h, F.lit(a).alias("action"), _at(t).alias("effective_at"))
          for a, t in (("add", first), ("remove", gone), ("add", again))])).alias("e")).select("e.*")
    urls = pages.select(url_lists.plain_url(F.col("url")).alias("pattern")).where("pattern IS NOT NULL").distinct()
    by_url = urls.where(_hex_number(h, 1, 1) == 0).select(
        F.lit("urls").alias("list_name"), F.lit("url").alias("kind"), "pattern", F.lit("add").alias("action"),
        _at(_hex_number(h, 2, 3) % 366).alias("effective_at"))
    domains = hosts.select(F.substring_index("pattern", ".", -2).alias("pattern")).distinct()
    by_domain = domains.select(F.explode(F.array(
        *[F.struct(F.lit("domains").alias("list_name"), F.lit("domain").alias("kind"), h, F.lit(a).alias("action"), _at(t).alias("effective_at"))
          for a, t in (("add", _hex_number(h, 1, 3) % 300), ("remove", _hex_number(h, 1, 3) % 300 + 7))])).alias("e")).select("e.*")
    return by_host.unionByName(by_url).unionByName(by_domain)


def op3_url_temporal_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    judged = url_lists.with_verdict(captures_of(pages), staged(entries_of(pages), "url-entries"))
    return judged.select("page_id", F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss").alias("fetched_at"),
                         "url_filter.blocked", "url_filter.n_active", "url_filter.lists",
                         F.date_format("url_filter.listed_since", "yyyy-MM-dd").alias("listed_since"))


def op4_subword_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = subword_sampling.sample_segmentations(docs, tokenizer_path(SUBWORD_MODEL))
    return found.select("doc_id", "sample", F.size("ids").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"), "log_prob", "perturbed",
                        "inclusion", F.crc32(F.col("decoded").cast("binary")).alias("decoded_crc32"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(PACKING_TOKENIZER), keep_ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op6_hash_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, i = table(spark, sf_dir, "documents"), F.col("doc_id")
    return suffix_tree_lm.scores(*suffix_tree_lm.fit_and_encode(docs, learns_from(i, 5, 1), held_out(i, 5, 1)))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), learns_from(F.col("doc_id"), 5, 0))
    scored = toxicity.with_toxicity(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, learns_from(F.col("doc_id"), 4, 2))
    named = langid.with_language(docs.select("doc_id", "text"), model)
    return named.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), F.col("language.lang").alias("lang_pred"),
                        "language.score")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    measured = staged(quality_rules.with_measures(docs).drop("text"), "quality-measures")
    return quality_rules.with_verdict(measured).select(
        "doc_id", *[f"quality.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")], "kept")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    masks = filter_audit.failure_masks(table(spark, sf_dir, "documents"))
    return filter_audit.audit(masks, table(spark, sf_dir, "labels"))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = personal_data.find_personal_data(docs, personal_data.fit(docs))

    def listed(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[number(k) for k in personal_data.KINDS], F.sha2(listed("base"), 256).alias("base_sha256"),
                        listed("spans").alias("spans"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with a seeded fault each: ``copies`` 0 drops a row, 2 repeats it; emptied, without sentence ends or with another role."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    fault = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    return conversations.select(
        "conv_id", "turn", F.when(fault == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_conversations(damaged(table(spark, sf_dir, "conversations")), copies=F.col("copies"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_license_scan, op2_simhash_near_dedup, op3_url_temporal_lists, op4_subword_sampling,
                            op5_best_fit_packing, op6_hash_prefix_forest, op7_suffix_tree_lm, op8_toxicity, op9_language_id,
                            op10_quality_rules, op11_filter_audit, op12_personal_data, op13_conversation_repair)
}
