"""Small helpers of the document operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmart.session import ensure_checkpoint_dir


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(ensure_checkpoint_dir(df.sparkSession))
    return df.checkpoint()


def fold_of(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds`` (null id: of the empty text)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % folds


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, keep: Column,
                    per_class: int) -> DataFrame:
    """(text, label) of at most ``per_class`` documents of each class, 0 and 1.

    The bound is on labels, chosen by a hash of the id, so the sample is the
    same in any layout.  At most 2 * per_class ids of 8 bytes are broadcast;
    the documents are scanned once, and of those in the sample one row an id
    (the text of least hash) leaves each task.  An id labelled twice takes its
    larger label; rows with a null id or label are not used.
    """
    one = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & keep)
           .groupBy("doc_id").agg(F.max(label).alias("label")))
    ids = None
    for value in (0, 1):
        part = (one.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id")
                .limit(per_class))
        ids = part if ids is None else ids.unionByName(part)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return (texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id")
            .agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least"),
                 F.max("label").cast("int").alias("label"))
            .select("least.text", "label"))


def splittable(aggregated: DataFrame) -> DataFrame:
    """One more (small) exchange above an aggregate that is joined with a skewed table.

    AQE splits a hot key of a join only if both inputs come straight from
    their exchange; an aggregate on the join key keeps its own exchange below it.
    """
    return aggregated.hint("rebalance")
