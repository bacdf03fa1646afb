"""The operators as queries over whole tables, each with its contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import (
    collocations, decontaminate, fixity, hard_negatives, line_dedup, lm_score, mixing, packing, quality_rules, simhash, suffix_dedup, topk, url_filter,
)
from tripmart.llm.common import read_table, shared

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = (
    ("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"),
    ("net/fr/", "block"),
)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "rule string, verdict string")
    return url_filter.filter_urls(read_table(spark, sf_dir, "pages"), rules)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    deduped = line_dedup.remove_repeated_lines(read_table(spark, sf_dir, "documents"))
    return deduped.select("doc_id", "n_lines", "n_removed", F.md5("text").alias("text_md5"))


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> tuple[quality_rules.RuleModel, DataFrame]:
    """The model learned from the labels outside the held-out part, and the statistics of all documents."""
    stats = shared(quality_rules.with_statistics(docs, "doc_id"))
    training = shared(quality_rules.training_rows(stats, read_table(spark, sf_dir, "labels")))
    return quality_rules.fit_rules(training, "label_"), stats


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, stats = quality_model(spark, read_table(spark, sf_dir, "documents"), sf_dir)
    score = model.score({name: F.col(name) for name in quality_rules.NAMES})
    return stats.select(
        "doc_id", quality_rules.held_out(F.col("doc_id")).alias("held_out"), score.alias("score")
    ).withColumn("predicted", (F.col("score") >= quality_rules.THRESHOLD).cast("int"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(decontaminate.find_matches(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")))
    return found.select(
        F.col("row").alias("doc_id"), "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def damaged(pages: DataFrame) -> DataFrame:
    """A replica of the pages with changed, missing and extra records."""
    at = lambda modulus, rest: F.col("page_id") % modulus == rest
    columns = ["page_id", "url", "html"]
    changed = F.when(at(97, 13), F.concat(F.substring("html", 1, 10), F.lit("?"))).otherwise(F.col("html"))
    kept = pages.where(~F.coalesce(at(101, 7), F.lit(False))).select("page_id", "url", changed.alias("html"))
    extra = pages.where(at(103, 5)).select((F.col("page_id") + 1_000_000_000).alias("page_id"), "url", "html")
    return kept.unionByName(extra).select(*columns)


def op5_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return fixity.audit(pages, damaged(pages)).withColumnRenamed("id", "page_id")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeated_strings(read_table(spark, sf_dir, "documents"))
    return cut.select(
        F.col("row").alias("doc_id"), "n_bytes",
        (F.col("n_bytes") - F.length("kept")).cast("bigint").alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def fingerprint_text(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select(F.col("row").alias("doc_id"), fingerprint_text(F.col("fingerprint")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"))
    return mixed.select(F.col("row").alias("doc_id"), "size", "source_size", "target", "taken", "source", "rate", "copies")


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm_score.language_model_scores(read_table(spark, sf_dir, "documents"), by_others=True)
    return scored.select(F.col("row").alias("doc_id"), "n_words", F.round("mean_log_score", 6).alias("mean_log_score"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations.collocations(read_table(spark, sf_dir, "documents"))
    return found.withColumn("rank", F.col("rank").cast("bigint"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    packed = packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select(F.col("row").alias("doc_id"), "piece", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "sequence_id", "offset")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label=noisy)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # at the top of the repository; it imports this module

    return corpus_pipeline.run(spark, sf_dir)


def llm_queries() -> dict[str, Query]:
    numbered = (op1_url_filter, op2_line_dedup, op3_quality, op4_decontaminate, op5_warc_fixity, op6_suffix_dedup,
                op7_simhash, op8_mixing, op9_topk, op10_lm_score, op11_collocations, op12_packing, op13_hard_negatives)
    return {query.__name__: query for query in numbered} | {"pipeline": pipeline}
