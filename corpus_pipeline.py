"""A corpus from raw documents in five stages, each written as Parquet and read again by the next.

Every stage works on what its predecessor kept, and keeps the columns of `documents` but for the last, which adds what
the mix takes of each document and carries it out: a document is there as often as the mix takes it. Documents whose text
changes get a new n_chars.

Defined results of every stage: null and empty texts are documents without words, lines or windows, so only the quality
score, equal fingerprints or the mix can take them out. Null ids are ids of their own kind, repeated rows are judged alike, and
texts of any length are judged whole. Ties go to the smaller id, then the smaller text key. Columns beside those of
`documents`, whatever their names, are left out; an empty table gives no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripmart.llm import decontaminate, line_dedup, mixing, quality_rules, simhash
from tripmart.llm.common import read_table, shared, shared_folder, text_key

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go: those whose score is below the threshold. Statistics are worked out once and written beside
    the documents, as they cost far more than another copy of the texts; fitting reads none of the texts."""
    found = quality_rules.with_statistics(docs, *COLUMNS)
    path = f"{shared_folder(spark)}/measured-{uuid.uuid4().hex}"
    found.write.option("compression", "zstd").parquet(path)
    measured = spark.read.schema(found.schema).parquet(path)
    labels = read_table(spark, sf_dir, "labels")
    training = shared(quality_rules.training_rows(measured.select("doc_id", *quality_rules.NAMES), labels))
    model = quality_rules.fit_rules(training, "label_")
    score = model.score({name: F.col(name) for name in quality_rules.NAMES})
    return measured.where(score >= quality_rules.THRESHOLD).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of repeated three-line windows go; documents stay."""
    deduped = line_dedup.remove_repeated_lines(docs.select(*COLUMNS))
    size = F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return deduped.withColumn("n_chars", size).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: that of the smallest id (of several rows of it, the smallest text)."""
    return simhash.one_of_each(docs.select(*COLUMNS))


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    found = decontaminate.find_matches(docs, read_table(spark, sf_dir, "benchmark"))
    hit = found.matches.select(F.col("key").alias("key_")).distinct()
    keyed = docs.select(*COLUMNS, text_key(F.col("text")).alias("key_"))
    return keyed.join(hit, "key_", "left_anti").select(*COLUMNS)


def plan(docs: DataFrame) -> DataFrame:
    """Every document with the copies the mix takes of it, 0 included."""
    def same(doc_id: str, key: Column) -> Column:
        """One value that rows of equal id, text and source share, and no others."""
        parts = [F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit("")) for name in (doc_id, "source")]
        return F.sha2(F.concat_ws("\n", parts[0], F.hex(key), parts[1]), 256)

    found = mixing.mix(docs)
    # Rows that nothing tells apart may get different copies: they are dealt out by number.
    planned = found.groupBy(same("row", F.col("key")).alias("same_")).agg(
        F.sort_array(F.collect_list("copies")).alias("dealt"),
        *[F.first(name).alias(name) for name in ("size", "source_size", "target")],
    )
    keyed = docs.select(*COLUMNS, same("doc_id", text_key(F.col("text"))).alias("same_"))
    number = F.row_number().over(Window.partitionBy("same_").orderBy("same_"))
    joined = keyed.join(planned, "same_").withColumn("copies", F.element_at("dealt", number))
    return joined.select(*COLUMNS, "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(planned: DataFrame) -> DataFrame:
    """The rows of the corpus: each document as often as the mix takes it (copy: 1 to copies), those of no copies not."""
    copy = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")
    return planned.where(F.col("copies") > 0).select(*COLUMNS, "size", "source_size", "target", "copies", copy)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus: documents of no copies go, others are repeated, and the words of each source are near its target."""
    return mixed(plan(docs))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality), ("lines", lines), ("near_copies", near_copies), ("benchmark_free", benchmark_free),
    ("mixture", mixture),
]

# A fitted classifier, XXH64 fingerprints and rounded rates are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
