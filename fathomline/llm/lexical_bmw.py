"""Ranked lexical search by Block-Max WAND over an index of compressed posting blocks.

index() cuts the documents into segments as they are scanned, without a shuffle. In a segment documents are numbered in
the order of their ids, and each term's postings are cut into blocks of BLOCK: first and last number, the number of
postings, a payload of bit-packed gaps, frequencies and lengths, and the block's maximum impact. An impact depends on
the corpus's totals, which are known only after all segments are; so a block keeps the frequencies and lengths of those
postings that no other of the block beats in both, from which the maximum is exact whatever the totals are, and an index
needs no rewriting when documents are added.

search() joins the terms of the queries with the index and searches each (segment, block of queries) as one group. The
last numbers of all blocks of a query's terms cut a segment into ranges. Moving the terms' pointers over the ranges
without decompressing (shallow moves) gives each range's bound: the sum of weights times maximum impacts. Ranges are
entered from the highest bound on, as long as a bound reaches the threshold, the tenth best score so far. In a range the
terms that can add most come first; a document that they lack is looked at only while the others' bounds reach the
threshold, and a block of the others is decompressed only where a document that may still do lies in it.

Scores are whole numbers, so results are exact. Null texts, and texts without terms, count nowhere and are never found.
Equal rows are found each. A null id comes last among equal scores; equal scores are told apart by id, then at random.
Rows of one item are one item with the terms of all their texts; an item without terms has no result. Empty tables give
no rows. A text of any length is one document of a segment; no other columns are read.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut
from .importance import LOWER, UPPER
from .winnowing import filter_bits

#: Postings in a block.
BLOCK = 128
#: Bytes of text in a segment (a longer text is a segment of its own).
SEGMENT = 64 << 20
#: Queries in a block of queries.
QUERIES = 256
TOP = 10
#: Fixed values of the score: 1000 * k1 in parts, b in hundredths.
SCALE, B = 1_000_000_000, 90

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER_BYTES = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_TERM_BYTES = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    """The terms of a text column in Spark, as the index has them."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(TERM), F.lit(0))


def pack(values: np.ndarray, width: int) -> bytes:
    """Numbers from 0 on, each in width bits."""
    bits = (values[:, None] >> np.arange(width)) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def unpack(data: bytes, at: int, count: int, width: int) -> tuple[np.ndarray, int]:
    """count numbers of width bits from byte at on, and the byte after them."""
    size = (count * width + 7) // 8
    if not width:
        return np.zeros(count, np.int64), at
    bits = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=count * width).reshape(count, width)
    return bits @ (np.int64(1) << np.arange(width, dtype=np.int64)), at + size


def encode_block(docs: np.ndarray, tf: np.ndarray, length: np.ndarray) -> bytes:
    """A block's postings: three widths, then gaps between numbers, frequencies and lengths, each less the least."""
    columns = (np.diff(docs) - 1, tf - 1, length - 1)
    widths = [int(c.max()).bit_length() if len(c) else 0 for c in columns]
    return bytes(widths) + b"".join(pack(c, w) for c, w in zip(columns, widths) if w and len(c))


def decode_block(first: int, count: int, payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    gaps, at = unpack(payload, 3, count - 1, payload[0])
    tf, at = unpack(payload, at, count, payload[1])
    length, _ = unpack(payload, at, count, payload[2])
    docs = np.full(count, first, np.int64)
    docs[1:] += np.cumsum(gaps + 1)
    return docs, tf + 1, length + 1


def competitive(tf: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Places of the postings that none beats in frequency and shortness; a block's largest impact is one of theirs."""
    order = np.lexsort((length, -tf))
    least = np.minimum.accumulate(length[order])
    keep = np.ones(len(order), bool)
    keep[1:] = least[1:] < least[:-1]
    return order[keep]


_BLOCKS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("n", pa.int32()), ("tf", pa.list_(pa.int64())), ("length", pa.list_(pa.int64())), ("payload", pa.binary())]))
_BLOCKS_DDL = "array<struct<first:int,last:int,n:int,tf:array<bigint>,length:array<bigint>,payload:binary>>"


def _segment(name: str, ids: list, lengths: list[int], postings: dict[bytes, tuple[array, array]], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """One row for the documents of a segment (term null), and one for each term."""
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] if ids[i] is not None else 0))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    length = np.array(lengths, np.int64)[order]
    rows: list[tuple] = [(None, len(order), int(length.sum()), [ids[i] for i in order], None)]
    for term, (docs, tf) in postings.items():
        d = place[np.array(docs, np.int64)]
        o = np.argsort(d)
        d, t = d[o], np.array(tf, np.int64)[o]
        blocks = []
        for a in range(0, len(d), BLOCK):
            bd, bt = d[a : a + BLOCK], t[a : a + BLOCK]
            bl = length[bd]
            best = competitive(bt, bl)
            blocks.append({"first": int(bd[0]), "last": int(bd[-1]), "n": len(bd), "tf": bt[best].tolist(), "length": bl[best].tolist(), "payload": encode_block(bd, bt, bl)})
        rows.append((term.decode("utf-8", "replace"), len(d), None, None, blocks))
    for a in range(0, len(rows), 4096):
        part = list(zip(*rows[a : a + 4096]))
        n = len(part[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * n), pa.array(part[0], pa.string()), pa.array(part[1], pa.int64()), pa.array(part[2], pa.int64()), pa.array(part[3], pa.list_(id_type)), pa.array(part[4], _BLOCKS)],
            names=["segment", "term", "n", "n_terms", "ids", "blocks"],
        )


def index(docs: DataFrame, wanted: np.ndarray | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(segment, term, n, n_terms, ids, blocks): a row for each segment and term, n its documents; and one for each segment.

    The segment's own row has no term: n is its number of documents, n_terms that of their terms with repeats, and ids
    are theirs in order. wanted is a filter from term_filter(): terms that it lacks get no postings. Documents without
    terms are in no segment.
    """
    kind = docs.schema[doc_id].dataType
    ddl = kind.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(wanted) if wanted is not None else None

    def of(batches):
        from pyspark import TaskContext
        import xxhash

        bits = shared.value if shared is not None else None
        mask = len(bits) * 8 - 1 if bits is not None else 0
        known: dict[bytes, bool] = {}

        def wants(term: bytes) -> bool:
            hit = known.get(term)
            if hit is None:
                h = xxhash.xxh64_intdigest(term, 42) & mask
                hit = known[term] = bool(bits[h >> 3] >> (h & 7) & 1)
                if len(known) > 1_000_000:
                    known.clear()
            return hit

        part, n = TaskContext.get().partitionId(), 0
        ids, lengths, postings, size = [], [], {}, 0
        for batch in batches:
            id_type = batch.column(0).type
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = raw.as_py() or b""
                counts = Counter(_TERM_BYTES.findall(raw.translate(_LOWER_BYTES)))
                if not counts:
                    continue
                for term, tf in counts.items():
                    if bits is None or wants(term):
                        got = postings.get(term)
                        if got is None:
                            got = postings[term] = (array("i"), array("i"))
                        got[0].append(len(ids))
                        got[1].append(tf)
                ids.append(i)
                lengths.append(counts.total())
                size += len(raw)
                if size >= SEGMENT:
                    yield from _segment(f"{part}-{n}", ids, lengths, postings, id_type)
                    ids, lengths, postings, size, n = [], [], {}, 0, n + 1
        if ids:
            yield from _segment(f"{part}-{n}", ids, lengths, postings, id_type)

    return docs.select(doc_id, F.col(text).cast("binary").alias("text")).mapInArrow(of, f"segment string, term string, n bigint, n_terms bigint, ids array<{ddl}>, blocks {_BLOCKS_DDL}")


def term_filter(items: DataFrame) -> np.ndarray:
    """A bit for each remainder of a hash of the queries' terms: 2 MB whatever their number."""
    return filter_bits(items.select("term").distinct().select(F.xxhash64("term").alias("fp")))


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, term): each term of an item once."""
    return items.select(F.col(item_id).alias("item_id"), F.explode(terms(F.col(text))).alias("term")).distinct()


def best(weights: np.ndarray, blocks: list[dict[str, np.ndarray]], at_most: int, floor: int, n_docs: int, total: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The highest-scoring documents of a segment, (numbers, scores), and how many blocks this query needed decompressed.

    weights and blocks are of the query's terms; floor is a score that a document must reach to matter. What is
    decompressed stays with the blocks, for the next query.
    """

    def impact(tf, length):
        return SCALE * tf // (1000 * tf + 8 * (100 - B + B * length * n_docs // total))

    edges = np.unique(np.concatenate([b["last"] for b in blocks] + [b["first"] - 1 for b in blocks]))
    # range r holds the documents after edges[r - 1] up to edges[r]; shallow moves of each term's pointer over all ranges
    starts = np.concatenate([[0], edges[:-1] + 1])
    tops, reach = np.zeros((len(blocks), len(edges)), np.int64), np.zeros((len(blocks), len(edges)), np.int64)
    for k, (w, b) in enumerate(zip(weights, blocks)):
        if "top" not in b:
            b["top"], b["open"] = np.maximum.reduceat(impact(b["tf"], b["length"]), b["offset"]), {}
        top = w * b["top"]
        here = np.searchsorted(b["last"], edges)
        there = np.minimum(here, len(b["last"]) - 1)
        inside = (here < len(b["last"])) & (b["first"][there] <= starts)
        tops[k] = np.where(inside, top[there], 0)
        reach[k] = np.where(inside, there, -1)
    # terms that can add most come first; rest[k] is what those from k on can add in each range
    by_top = np.argsort(-tops.max(1), kind="stable")
    rest = np.vstack([np.cumsum(tops[by_top][::-1], 0)[::-1], np.zeros((1, len(edges)), np.int64)])
    bound = rest[0]
    docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    opened = [np.zeros(len(b["first"]), bool) for b in blocks]
    threshold, done, order = max(floor, 1), 0, np.argsort(-bound, kind="stable")
    while done < len(order) and bound[order[done]] >= threshold:
        # some ranges at once, more each time, so that the threshold rises early and later steps are long
        step = order[done : done + max(32, 3 * done)]
        step = step[bound[step] >= threshold]
        done += max(32, 3 * done)
        found, got, where = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        fresh = np.zeros(len(edges), bool)
        fresh[step] = True
        for place, k in enumerate(by_top.tolist()):
            # documents found so far that may still do, and ranges in which a document that isn't found yet may
            alive = got + rest[place][where] >= threshold
            if not alive.all():
                found, got, where = found[alive], got[alive], where[alive]
            fresh &= rest[place] >= threshold
            needed = np.zeros(len(opened[k]) + 1, bool)  # the last is for no block
            needed[reach[k][fresh]] = True
            needed[reach[k][where]] = True
            need = np.flatnonzero(needed[:-1])
            if not len(need):
                if not len(found) and not fresh.any():
                    break
                continue
            opened[k][need] = True
            b = blocks[k]
            for j in need.tolist():
                if j not in b["open"]:
                    d, tf, length = decode_block(int(b["first"][j]), int(b["n"][j]), b["payload"][j])
                    b["open"][j] = (d, impact(tf, length))
            d, s = (np.concatenate(x) for x in zip(*(b["open"][j] for j in need.tolist())))
            s = weights[k] * s
            if len(found):
                at = np.minimum(np.searchsorted(found, d), len(found) - 1)
                known = found[at] == d
                got[at[known]] += s[known]
                d, s = d[~known], s[~known]
            in_range = np.searchsorted(edges, d)
            new = fresh[in_range]
            if new.any():
                at = np.searchsorted(found, d[new])
                found, got, where = np.insert(found, at, d[new]), np.insert(got, at, s[new]), np.insert(where, at, in_range[new])
        docs, scores = np.concatenate([docs, found]), np.concatenate([scores, got])
        first = np.lexsort((docs, -scores))[:at_most]
        docs, scores = docs[first], scores[first]
        if len(docs) == at_most:
            threshold = max(threshold, int(scores[-1]))
    use = scores > 0
    return docs[use], scores[use], sum(int(o.sum()) for o in opened)


def search(built: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): of each item its top documents with a score above 0.

    built is an index that was written; items are rows of item_terms(), written too.
    """
    whole = built.where("term IS NULL").agg(F.sum("n").alias("docs"), F.sum("n_terms").alias("total")).first()
    n_docs, total = whole.docs or 0, whole.total or 1
    id_type = built.schema["ids"].dataType.elementType.simpleString()
    item_type = items.schema["item_id"].dataType.simpleString()
    df = built.where("term IS NOT NULL").groupBy("term").agg(F.sum("n").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2.0 * F.col("df") + 1)))
    n_items = items.select("item_id").distinct().count()
    parts = -(-n_items // QUERIES) or 1
    part = F.pmod(F.xxhash64("item_id"), F.lit(parts)).cast("int")
    wanted = items.join(df, "term").groupBy("term", part.alias("part")).agg(F.collect_list(F.struct("item_id", weight.cast("bigint").alias("weight"))).alias("items"))
    postings = built.where("term IS NOT NULL").select("segment", "term", "blocks").join(wanted, "term").select("segment", "part", "items", "blocks", F.lit(None).cast(f"array<{id_type}>").alias("ids"))
    each = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")  # every block of queries is asked of every segment
    heads = built.where("term IS NULL").select("segment", each, "ids").select("segment", "part", F.lit(None).cast(f"array<struct<item_id:{item_type},weight:bigint>>").alias("items"), F.lit(None).cast(_BLOCKS_DDL).alias("blocks"), "ids")

    def of(table: pa.Table) -> pa.Table:
        ids: list = []
        queries: dict = {}
        for row in table.to_pylist():
            if row["ids"] is not None:
                ids = row["ids"]
                continue
            blocks = row["blocks"]
            b = {c: np.array([x[c] for x in blocks], np.int64) for c in ("first", "last", "n")}
            b["offset"] = np.cumsum([0] + [len(x["tf"]) for x in blocks[:-1]])
            b["tf"], b["length"] = (np.array([v for x in blocks for v in x[c]], np.int64) for c in ("tf", "length"))
            b["payload"] = [x["payload"] for x in blocks]
            for q in row["items"]:
                queries.setdefault(q["item_id"], []).append((q["weight"], b))
        out = []
        for item, of_terms in queries.items():
            of_terms = [x for x in of_terms if x[0] > 0]
            if of_terms:
                d, s, _ = best(np.array([w for w, _ in of_terms]), [b for _, b in of_terms], top, 1, n_docs, total)
                out += [(item, ids[i], v) for i, v in zip(d.tolist(), s.tolist())]
        columns = list(zip(*out)) if out else [(), (), ()]
        return pa.table([pa.array(columns[0], table.schema.field("items").type.value_type.field(0).type), pa.array(columns[1], table.schema.field("ids").type.value_type), pa.array(columns[2], pa.int64())], names=["item_id", "doc_id", "score"])

    hits = postings.unionByName(heads).groupBy("segment", "part").applyInArrow(of, f"item_id {item_type}, doc_id {id_type}, score bigint")
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return hits.withColumn("rank", place).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def query(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    asked = cut(item_terms(items))
    return search(cut(index(docs, term_filter(asked))), asked)
