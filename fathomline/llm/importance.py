"""Target-distribution importance resampling over hashed word runs.

Runs of consecutive words of a text are hashed into BUCKETS buckets. The share of a bucket among all runs of the target
against its share among all runs of the documents is the bucket's gain; a document's weight is the mean gain of its runs.
Gumbel noise from a hash of the id turns the weights into draws without replacement: the highest sums are drawn.

Runs are never rows of a shuffle. A first pass sums runs by bucket within each task, so a task hands on at most BUCKETS
counts. The second folds each document's array of buckets over a literal array of gains, and moves no row at all. Ranks
come from a histogram of scores: a score is a whole number of a bounded range (weights within 1000 * ln of the counts,
noise of 32 bits within -3,200 and 23,000), so there are some 10^5 of them whatever the size of the corpus, and only
documents of one score are numbered together.

Null and empty texts have no runs: their weight is 0, and they are never drawn as they have too few words. Equal rows are
each scored and ranked. A null id is hashed as an empty one and comes first among equal scores. An empty target gives all
buckets nearly equal gains; an empty table of documents gives no rows. Other columns of the tables aren't read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, spare_name

BUCKETS = 10_000
#: Words of the longest run.
LONGEST = 1
#: Documents with fewer words aren't drawn.
LEAST_WORDS = 20
#: Of the others so many in a hundred are.
PERCENT = 10
SEED = 2024

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text, A to Z lower-cased; none for a null text."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def run_buckets(of: Column, longest: int = LONGEST, buckets: int = BUCKETS) -> Column:
    """The buckets of all runs of one to longest words, an array of integers."""

    def bucket(run: Column) -> Column:
        return (F.crc32(run.cast("binary")) % buckets).cast("int")

    def of_length(n: int) -> Column:
        starts = F.when(F.size(of) >= n, F.sequence(F.lit(1), F.size(of) - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: bucket(F.array_join(F.slice(of, i, n), " ")))

    out = F.transform(of, bucket)
    for n in range(2, longest + 1):
        out = F.concat(out, of_length(n))
    return out


def bucket_counts(texts: DataFrame, text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> list[int]:
    """How often each bucket occurs: at most one number for each bucket reaches the driver."""
    runs = texts.select(words(F.col(text)).alias("w")).select(F.explode(run_buckets(F.col("w"), longest, buckets)).alias("bucket"))
    out = [0] * buckets
    for r in runs.groupBy("bucket").count().collect():
        out[r["bucket"]] = r["count"]
    return out


def gains(documents: list[int], target: list[int]) -> list[int]:
    """Of each bucket 1000 times the logarithm of its smoothed share in the target over that in the documents."""
    n, s, t = len(documents), sum(documents), sum(target)
    return [math.floor(1000 * math.log((b + 1) * (s + n) / ((a + 1) * (t + n)))) for a, b in zip(documents, target)]


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """1000 times Gumbel noise, rounded down, from the first 32 bits of a digest of the seed and the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def weigh(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """(doc_id, digest, n_words, n_features, weight, score): a row for each row of docs; digest is a hash of the text."""
    worth = gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, target_text, longest, buckets))
    table = F.split(F.lit(",".join(map(str, worth))), ",").cast("array<bigint>")  # folded into one literal by the planner
    zero = F.lit(0).cast("bigint")
    # in steps, so that each array is made once
    got = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("digest"), words(F.col(text)).alias("w"))
    got = got.select("doc_id", "digest", F.size("w").cast("bigint").alias("n_words"), run_buckets(F.col("w"), longest, buckets).alias("b"))
    got = got.select("doc_id", "digest", "n_words", F.size("b").cast("bigint").alias("n_features"), F.aggregate("b", zero, lambda a, x: a + F.element_at(table, x + 1)).alias("sum"))
    mean = F.when(F.col("n_features") > 0, F.expr("(sum - pmod(sum, n_features)) div n_features")).otherwise(zero)
    got = got.select("doc_id", "digest", "n_words", "n_features", mean.alias("weight"))
    return got.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


def ranked(weighed: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """The rows of weigh() with rank: 1, 2, ... of those drawn, by score from the highest, equal ones by id; else null.

    weighed is read three times and should be written.
    """
    fit = F.col("n_words") >= least_words
    histogram = weighed.where(fit).groupBy("score").count()
    upto = F.sum("count").over(Window.orderBy(F.desc("score")))
    before = histogram.select(F.col("score").alias("_score"), (upto - F.col("count")).alias("_before"), (F.sum("count").over(Window.partitionBy()) * percent / 100).cast("bigint").alias("_drawn"))
    # scores are few, see above, so this side may be broadcast
    near = weighed.join(F.broadcast(before.where("_before < _drawn")), fit & (F.col("score") == F.col("_score")), "left")
    place = F.col("_before") + F.row_number().over(Window.partitionBy("score").orderBy("doc_id", "digest"))
    drawn = near.where("_score IS NOT NULL").withColumn("_place", place).withColumn("rank", F.when(F.col("_place") <= F.col("_drawn"), F.col("_place")))
    rest = near.where("_score IS NULL").withColumn("rank", F.lit(None).cast("bigint"))
    return drawn.select(*weighed.columns, "rank").unionByName(rest.select(*weighed.columns, "rank"))


def draw(docs: DataFrame, target: DataFrame, percent: int = PERCENT, **given) -> DataFrame:
    """The rows of docs that are drawn, with the columns they had; equal rows of one id and text go together."""
    _doc, _digest = spare_name(docs, "_doc", "_digest")
    doc_id, text = given.get("doc_id", "doc_id"), given.get("text", "text")
    picked = ranked(cut(weigh(docs, target, **given)), percent).where("rank IS NOT NULL").select(F.col("doc_id").alias(_doc), F.col("digest").alias(_digest)).distinct()
    return docs.join(picked, docs[doc_id].eqNullSafe(F.col(_doc)) & (F.xxhash64(docs[text]) == F.col(_digest)), "left_semi")


def query(spark: SparkSession, docs: DataFrame, target: DataFrame) -> DataFrame:
    return ranked(cut(weigh(docs, target))).select("doc_id", "n_features", "weight", "score", "rank")
