"""Helpers shared by the text operators: table access, durable cuts of lineage, bounded samples."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..durable import cut, shared_dir

__all__ = ["cut", "shared_dir", "Scratch", "first_by_hash", "join_split", "labelled_sample", "remainder", "spare_name", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables; the path may be in any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Parquet tables in the shared folder, one after another; drop() removes one that is no longer read."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.n, self.last = spark, f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}", 0, ""

    def put(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.parquet(path)
        self.last = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def spare_name(df: DataFrame, *wanted: str) -> list[str]:
    """Column names close to the wanted ones that clash with none of the frame's."""
    have, out = {c.lower() for c in df.columns}, []
    for w in wanted:
        while w.lower() in have:
            w += "_"
        have.add(w.lower())
        out.append(w)
    return out


def remainder(doc_id, modulus: int):
    """crc32 of the id's decimal text, modulo modulus (null for a null id)."""
    return F.crc32(F.col(doc_id).cast("string")) % modulus


def first_by_hash(df: DataFrame, limit: int, total: int, *keys: str) -> DataFrame:
    """limit rows in the order of a hash of the keys, of some total rows; ties by the keys.

    Each task hands its first rows on to one task; those that can't be among them are left out first: of total rows, the
    first are those of the smallest hashes, all below a bound that twice the limit are expected under.
    """
    h = F.xxhash64(*keys)
    share = min(1.0, (2 * limit + 100) / max(total, 1))
    df = df.where(h <= F.lit(min(int(share * (1 << 64)) - (1 << 63), (1 << 63) - 1)))
    return df.orderBy(F.xxhash64(*keys), *keys).limit(limit)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, per_class: int) -> DataFrame:
    """At most per_class training documents of each class: (doc_id, text, label).

    Only ids whose remainder is not held_out take part. The ids come first, in the order of a hash of the id (so the
    choice doesn't follow any order of the table); 2 * per_class ids bound the broadcast side of the join with the
    texts. Repeated label rows count once, as the larger label; of repeated documents the smallest text is taken.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (remainder("doc_id", modulus) != held_out))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
    )
    sizes = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    picked = None
    for value in (0, 1):
        part = first_by_hash(known.where(F.col("label") == value), per_class, sizes.get(value, 0), "doc_id")
        picked = part if picked is None else picked.unionByName(part)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))


#: Keys that hold one row in so many, or more, are joined without dealing their rows out; there are at most so many.
SHARE = 4096


def join_split(left: DataFrame, right: DataFrame, key: str, share: int = SHARE) -> DataFrame:
    """left joined to right by key, where right has one row for each key and says in many how often left has it.

    Keys of at least one row of left in so many as share says are at most that many, so they are broadcast; no task is
    given more of one key than that share by the other join. Both sides should be written: left is read twice.
    """
    total = right.agg(F.sum("many")).first()[0] or 0
    hot, cold = right.where(F.col("many") * share >= total).drop("many"), right.where(F.col("many") * share < total).drop("many")
    rest = left.join(F.broadcast(hot.select(key)), key, "left_anti")
    return left.join(F.broadcast(hot), key).unionByName(rest.join(cold, key))
