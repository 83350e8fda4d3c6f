"""The document pipeline: named stages from raw documents to packed sequences.

Each stage is a function (spark, docs, sf_dir) over all that its predecessor
kept; all but the last return the columns of their input.  ORACLE_SQL is None, as neither a
trained classifier nor connected components have an SQL form; the stages are
tested against brute force.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmart.llm import decontaminate, packing, quality, secrets, simhash
from shopmart.llm.common import fold_of, read
from shopmart.session import ensure_checkpoint_dir

SHINGLE, MAX_BITS = 4, 4  # as operator 1 is called


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below 0.5 go."""
    model = quality.train(docs, read(spark, sf_dir, "labels"), "quality",
                          keep=fold_of("doc_id", 3) != 1)
    return docs.where(quality.score_udf(model, spark)(F.col("text")) >= 0.5)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.keep_one_per_group(docs, SHINGLE, MAX_BITS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontaminate.remove_contaminated(docs, read(spark, sf_dir, "benchmark"), window=10)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; every document stays, n_chars follows the text."""
    clean = docs.withColumn("text", secrets.masked_udf(secrets.train(docs))(F.col("text")))
    return clean.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each piece of a document with its sequence and its place in it."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; between stages the table is written and read again."""
    work = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4()}"
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs.write.parquet(f"{work}/{name}")
            docs = spark.read.parquet(f"{work}/{name}")
    return docs
