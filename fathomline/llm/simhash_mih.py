"""Near-duplicates by SimHash with multi-index hashing.

A fingerprint is cut into segments, each with a radius; the radii plus one add up to more than the distance looked
for, so two near fingerprints are within the radius of at least one segment. Each distinct fingerprint is stored under
the value of every segment and looks up the values in a small Hamming ball around its own; matches are verified over
all 64 bits. Looking up larger values only finds each such pair of values once.

A bucket with very many distinct fingerprints takes another exact way: two fingerprints are at most four bits apart
if and only if some word of 64 bits is at most two bits from both. All words that near to a fingerprint are listed
(2,081), and those of one word are linked to the smallest. The work is linear, and no word can have more than 2,081.

Texts of equal fingerprint are one node. Null and empty texts have fingerprint zero, which is linked like any other.
Texts are read whole, whatever their length. Equal rows are each returned; a row without an id has a fingerprint and a
component like others but is never the id that names one. An empty table gives no rows. keep_one() keeps all columns,
whatever their names, and of a component the row of the smallest id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .common import cut, join_split, spare_name

WORDS, SEED, DISTANCE = 4, 42, 4
#: (bits, radius) of the segments for up to so many distinct fingerprints.
PLANS = ((1 << 26, ((21, 1), (21, 1), (22, 0))), (None, ((32, 2), (32, 1))))
#: Distinct fingerprints of a bucket beyond which its fingerprints go the linear way.
HEAVY = 2000


def fingerprint(text: str | None) -> int:
    """The 64 bits as a signed integer: a bit is set if it is in over half the shingles' hashes, repeats counted."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes.lower() and split() know ASCII only
    if not words:
        return 0
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    k = min(WORDS, len(words))
    text_ = b" ".join(words)
    of = xxhash.xxh64_intdigest
    begin, stop = (end - size)[: len(words) - k + 1].tolist(), end[k - 1 :].tolist()
    total = np.zeros(64, np.int64)
    for i in range(0, len(begin), 1 << 16):
        h = np.array([of(text_[a:b], SEED) for a, b in zip(begin[i : i + (1 << 16)], stop[i : i + (1 << 16)])], ">u8")
        total += np.unpackbits(h.view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > len(begin)).view(">i8")[0])


def fingerprint_column(text: Column | str) -> Column:
    @F.pandas_udf(LongType())
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t) for t in texts], dtype="int64")

    return of(text)


def _segments(plan) -> list[tuple[int, int, int, int]]:
    """(number, lowest bit, bits, radius) of each segment."""
    out, low = [], 0
    for i, (bits, radius) in enumerate(plan):
        out.append((i, low, bits, radius))
        low += bits
    return out


def _value(fp: Column, low: int, bits: int) -> Column:
    return F.shiftrightunsigned(fp, low).bitwiseAND((1 << bits) - 1)


def stored(prints: DataFrame, plan) -> DataFrame:
    """(seg, key, fp): each fingerprint under the value of every segment."""
    keys = F.array(*(F.struct(F.lit(i).alias("seg"), _value(F.col("fp"), low, bits).alias("key")) for i, low, bits, _ in _segments(plan)))
    return prints.select("fp", F.explode(keys).alias("k")).select("k.seg", "k.key", "fp")


def looked_up(prints: DataFrame, plan) -> DataFrame:
    """(seg, key, fp): the values in the balls around each fingerprint's segments that are its own or larger."""
    def ball(i: int, low: int, bits: int, radius: int) -> Column:
        flips = [0]
        if radius >= 1:
            flips += [1 << a for a in range(bits)]
        if radius >= 2:
            flips += [1 << a | 1 << b for a in range(bits) for b in range(a)]
        own = _value(F.col("fp"), low, bits)
        near = F.transform(F.expr(f"array({','.join(f'{x}L' for x in flips)})"), lambda x: own.bitwiseXOR(x))
        return F.transform(F.filter(near, lambda k: k >= own), lambda k: F.struct(F.lit(i).alias("seg"), k.alias("key")))

    balls = [ball(*s) for s in _segments(plan)]
    return prints.select("fp", F.explode(F.flatten(F.array(*balls))).alias("k")).select("k.seg", "k.key", "fp")


def _linear_links(prints: DataFrame) -> DataFrame:
    """(a, b): links by way of words at most two bits from both; a chain of them joins all that are near."""
    flips = [0] + [1 << a for a in range(64)] + [1 << a | 1 << b for a in range(64) for b in range(a)]
    signed = [x - (1 << 64) if x >> 63 else x for x in flips]
    listed = prints.select("fp", F.explode(F.expr(f"array({','.join(f'CAST({x} AS BIGINT)' for x in signed)})")).alias("x")).select("fp", F.col("fp").bitwiseXOR(F.col("x")).alias("word"))
    together = listed.groupBy("word").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)  # 2,081 at most
    return together.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a < b").distinct()


def links(prints: DataFrame, heavy: int = HEAVY, plan=None) -> DataFrame:
    """(a, b): enough links between distinct fingerprints for their components; prints: (fp), distinct, written."""
    plan = plan or next(p for most, p in PLANS if most is None or prints.count() <= most)
    table, probe = stored(prints, plan), looked_up(prints, plan)
    full = cut(table.groupBy("seg", "key").count().where(F.col("count") > heavy).select("seg", "key"))
    if full.isEmpty():
        linear = None
    else:
        # bounded: a table of n fingerprints has at most 3 n / heavy such buckets; still not broadcast, but joined
        linear = _linear_links(probe.join(full, ["seg", "key"], "left_semi").select("fp").distinct())
        table, probe = table.join(full, ["seg", "key"], "left_anti"), probe.join(full, ["seg", "key"], "left_anti")
    a, b = table.withColumnRenamed("fp", "a"), probe.withColumnRenamed("fp", "b")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE
    same = (a["seg"] == b["seg"]) & (a["key"] == b["key"]) & (F.col("a") != F.col("b")) & near
    found = a.join(b, same).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return found if linear is None else found.unionByName(linear).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of an edge reaches. edges: (a, b), distinct, written.

    Each round every node takes its smallest neighbour, if smaller, as its parent, and edges become edges between
    parents; those within one parent go. Few are left after a round, however dense a group is.
    """
    labels = None
    while labels is None or not edges.isEmpty():
        ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = ends.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("up")).withColumnRenamed("a", "child")
        parents = cut(first)
        above = parents.select(F.col("child").alias("up"), F.col("up").alias("further"))
        parents = cut(parents.join(above, "up").select("child", F.col("further").alias("up")))
        if labels is None:
            labels = parents.select(F.col("child").alias("node"), F.col("up").alias("root"))
        else:
            labels = cut(labels.join(parents, F.col("root") == F.col("child"), "left").select("node", F.coalesce("up", "root").alias("root")))
        left = edges.join(parents, F.col("a") == F.col("child")).select(F.col("up").alias("a"), "b")
        moved = left.join(parents, F.col("b") == F.col("child")).select(F.least("a", "up").alias("a"), F.greatest("a", "up").alias("b"))
        edges = cut(moved.where("a < b").distinct())
    return labels


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", heavy: int = HEAVY) -> DataFrame:
    """(doc_id, digest, fp, component_id): a row for each row of docs.

    component_id is the smallest doc_id that is reached, null ids left out; digest is a hash of the text.
    """
    rows = cut(docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("digest"), fingerprint_column(text).alias("fp")))
    return component_ids(rows, cut(links(cut(rows.select("fp").distinct()), heavy)))


def component_ids(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """(doc_id, digest, fp, component_id) of rows (doc_id, digest, fp) by edges (a, b) between fps, both written."""
    nodes = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("many")))
    reach = components(edges)
    rooted = cut(nodes.join(reach, F.col("fp") == F.col("node"), "left").select("fp", "first", "many", F.coalesce("root", "fp").alias("root")))
    least = cut(rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("many")))
    found = cut(join_split(rooted.select("fp", "root", F.col("many").alias("copies")), least, "root").select("fp", "component_id", F.col("copies").alias("many")))
    return join_split(rows, found, "fp").select("doc_id", "digest", "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component, with the columns it had: that of the smallest doc_id, then of the smallest text hash.

    Rows equal in id and text are one, the first in the order of their JSON; a row without an id stays only where no row
    of the component has one.
    """
    return kept(docs, near_duplicates(docs))


def kept(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """The rows that keep_one() keeps. marks: (doc_id, digest, fp, component_id)."""
    _id, _digest, _many = spare_name(docs, "_id", "_digest", "_many")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    # components without any id are told apart by a fingerprint
    picked = (
        marks.groupBy("doc_id", "digest", "component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("alone"))
        .count()
        .groupBy("component_id", "alone")
        .agg(F.min(F.struct(order.alias("o"), "count")).alias("m"))
        .select(F.col("m.o.doc_id").alias(_id), F.col("m.o.digest").alias(_digest), F.col("m.count").alias(_many))
        .groupBy(_id, _digest)
        .agg(F.max(_many).alias(_many))
    )
    found = docs.join(picked, docs["doc_id"].eqNullSafe(F.col(_id)) & (F.xxhash64(docs["text"]) == F.col(_digest)))
    single = found.where(F.col(_many) == 1).select(docs["*"])
    # of rows equal in id and text but not in other columns, the first in the order of their JSON
    row = F.struct(*(docs[f"`{c.replace('`', '``')}`"] for c in docs.columns))
    repeated = found.where(F.col(_many) > 1).groupBy(_id, _digest).agg(F.min_by(row, F.to_json(row)).alias("_row")).select("_row.*")
    return single.unionByName(repeated)


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
