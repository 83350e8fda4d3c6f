"""Exact length histogram of a corpus and what follows from it for every context limit.

Documents are encoded with a public byte-level vocabulary (a parameter) and
counted by their length; one row per distinct length stays.  Sums over the
rows above and below a length answer totals, quantiles and truncated totals
for every limit, exactly.  The running sums go block-wise over the lengths (within
blocks of ``BLOCK`` lengths, then over the blocks), so no task holds more than a block's or
the blocks' rows.

Defined results: null and empty texts have length 0; repeated rows count
each; extra columns are ignored; an empty table gives an empty histogram.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from shopmart.llm.common import cut

VOCABULARY = "byte_bpe_50k.tiktoken"
BLOCK = 1024


@lru_cache(maxsize=4)
def encoding(vocabulary: str) -> tiktoken.Encoding:
    """The encoder of a vocabulary file: a path, or a name among the public ones."""
    path = vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


def length_udf(vocabulary: str = VOCABULARY):
    """Column function text → number of tokens."""

    @arrow_udf("bigint")
    def length(texts: pa.Array) -> pa.Array:
        encoder = encoding(vocabulary)
        return pa.array([len(encoder.encode_ordinary(t.as_py() or "")) for t in texts], pa.int64())

    return length


def length_histogram(docs: DataFrame, vocabulary: str = VOCABULARY,
                     text_col: str = "text") -> DataFrame:
    """(length, n_docs) of the encoded texts: one row per distinct length, summed map-side."""
    lengths = docs.select(length_udf(vocabulary)(F.col(text_col)).alias("length"))
    return lengths.groupBy("length").agg(F.count("*").alias("n_docs"))


def with_running_sums(histogram: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per length L: documents and tokens up to L, documents and tokens above L, and
    ``truncated_tokens``, the total when every document is cut at L tokens.

    Only blocks of lengths (longest length / ``block`` rows) meet in one task.  The histogram (one
    row per distinct length) is written once, as the sums read it twice.
    """
    rows = cut(histogram).withColumn("block", F.floor(F.col("length") / block))
    inside = Window.partitionBy("block").orderBy("length").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tokens = F.col("length") * F.col("n_docs")
    blocks = (rows.groupBy("block").agg(F.sum("n_docs").alias("docs"), F.sum(tokens).alias("tokens"))
              .select("block", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before")
                                 for c in ("docs", "tokens")),
                      *(F.sum(c).over(whole).alias(f"{c}_all") for c in ("docs", "tokens"))))
    upto = rows.join(blocks, "block").select(
        "length", "n_docs",
        (F.sum("n_docs").over(inside) + F.col("docs_before")).alias("docs_upto"),
        (F.sum(tokens).over(inside) + F.col("tokens_before")).alias("tokens_upto"),
        "docs_all", "tokens_all")
    above = upto.select("length", "n_docs", "docs_upto", "tokens_upto",
                        (F.col("docs_all") - F.col("docs_upto")).alias("docs_above"),
                        (F.col("tokens_all") - F.col("tokens_upto")).alias("tokens_above"))
    return above.withColumn("truncated_tokens",
                            F.col("tokens_upto") + F.col("length") * F.col("docs_above"))


def truncated_totals(sums: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, total_tokens, docs_cut) when every document is cut at a limit."""
    found = []
    for limit in limits:
        last = F.max(F.when(F.col("length") <= limit, F.struct("length", "tokens_upto", "docs_above")))
        every = F.max(F.col("n_docs") + F.col("docs_above") + F.col("docs_upto") - F.col("n_docs"))
        found.append(sums.agg(last.alias("last"), every.alias("docs")).select(
            F.lit(limit).cast("long").alias("context_limit"),
            F.coalesce(F.col("last.docs_above"), "docs", F.lit(0)).alias("docs_cut"),
            F.coalesce(F.col("last.tokens_upto"), F.lit(0)).alias("upto"))
            .select("context_limit", (F.col("upto") + limit * F.col("docs_cut")).alias("total_tokens"),
                    "docs_cut"))
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df)
    return out


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """(share, length): the shortest length that at least that share of documents does not exceed."""
    every = F.col("docs_upto") + F.col("docs_above")
    aggregates = [F.min(F.when(F.col("docs_upto") >= F.lit(q) * every, F.col("length"))).alias(f"q{i}")
                  for i, q in enumerate(shares)]
    pairs = F.explode(F.array(*[F.struct(F.lit(float(q)).alias("share"), F.col(f"q{i}").alias("length"))
                                for i, q in enumerate(shares)]))
    return sums.agg(*aggregates).select(pairs.alias("r")).select("r.*")
