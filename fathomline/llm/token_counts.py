"""Token counts of a corpus for every context limit, from an exact histogram of encoded lengths.

Documents are counted by encoded length. At each length L that occurs, as a context limit, suffix sums give: documents
longer than L, their tokens, the tokens that stay if each document is cut to L, and those that are lost; prefix counts
give the share of documents that fit, so L is that quantile of lengths. Between two lengths that occur, the figures
follow from the lower one: documents longer than L stay the same and each adds a token for each step of L.

Null texts are empty and count as length 0; an empty table gives no rows; repeated rows count as often as they are there. Only the text's column is read,
so others may have any name. Sums are split in blocks of lengths, so no task sees all lengths.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bpe
from .common import cut

#: Lengths in a block; sums run within blocks and over blocks.
BLOCK = 1024


def histogram(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """(length, docs): how many documents have each encoded length."""
    return docs.select(bpe.length_column(path, pattern, F.coalesce(text, F.lit(""))).alias("length")).groupBy("length").agg(F.count("*").alias("docs"))


def limits(lengths: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row for each length of a histogram (length, docs), as a context limit.

    (context_limit, docs, docs_fit, docs_over, quantile, tokens_total, tokens_over, tokens_kept, tokens_lost)
    """
    rows = lengths.withColumn("block", F.floor(F.col("length") / block)).withColumn("tokens", F.col("length") * F.col("docs"))
    blocks = rows.groupBy("block").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    # blocks are few, as many as the longest document has tokens by the block: one task sums them
    order = Window.partitionBy(F.lit(0)).orderBy("block")
    earlier, every = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = blocks.select(
        "block",
        F.coalesce(F.sum("d").over(earlier), F.lit(0)).alias("d0"),
        F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("t0"),
        F.sum("d").over(every).alias("all_docs"),
        F.sum("t").over(every).alias("all_tokens"),
    )
    upto = Window.partitionBy("block").orderBy("length").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.join(before, "block")
    fit, fit_tokens = F.col("d0") + F.sum("docs").over(upto), F.col("t0") + F.sum("tokens").over(upto)
    got = summed.select("length", "docs", "all_docs", "all_tokens", fit.alias("docs_fit"), fit_tokens.alias("tokens_fit"))
    over = F.col("all_docs") - F.col("docs_fit")
    return got.select(
        F.col("length").alias("context_limit"),
        "docs",
        "docs_fit",
        over.alias("docs_over"),
        (F.col("docs_fit") / F.col("all_docs")).alias("quantile"),
        F.col("all_tokens").alias("tokens_total"),
        (F.col("all_tokens") - F.col("tokens_fit")).alias("tokens_over"),
        (F.col("tokens_fit") + over * F.col("length")).alias("tokens_kept"),
        (F.col("all_tokens") - F.col("tokens_fit") - over * F.col("length")).alias("tokens_lost"),
    )


def at_limits(lengths: DataFrame, wanted: list[int]) -> DataFrame:
    """The same totals for given limits: (context_limit, docs, docs_fit, docs_over, tokens_total, tokens_kept)."""
    aggs = []
    for w in wanted:
        aggs += [F.sum(F.when(F.col("length") <= w, F.col("docs")).otherwise(0)).alias(f"f{w}"), F.sum(F.col("docs") * F.least(F.col("length"), F.lit(w))).alias(f"k{w}")]
    one = lengths.agg(F.sum("docs").alias("n"), F.sum(F.col("docs") * F.col("length")).alias("t"), *aggs)
    rows = F.array(*(F.struct(F.lit(w).cast("long").alias("context_limit"), F.col("n").alias("docs"), F.col(f"f{w}").alias("docs_fit"), (F.col("n") - F.col(f"f{w}")).alias("docs_over"), F.col("t").alias("tokens_total"), F.col(f"k{w}").alias("tokens_kept")) for w in wanted))
    return one.select(F.inline(rows))


def quantiles(lengths: DataFrame, shares: list[float]) -> DataFrame:
    """(share, length): the smallest length that at least the share of documents doesn't exceed."""
    table = limits(lengths)
    return table.agg(*(F.min(F.when(F.col("quantile") >= s, F.col("context_limit"))).alias(f"q{i}") for i, s in enumerate(shares))).select(
        F.inline(F.array(*(F.struct(F.lit(s).alias("share"), F.col(f"q{i}").alias("length")) for i, s in enumerate(shares))))
    )


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return limits(cut(histogram(docs, *bpe.production())))
