"""Benchmark decontamination by winnowing.

Words of a text become hashes, GRAM words in a row a gram, and of every HOLD grams in a row the smallest is kept as a
fingerprint. Two texts that share GRAM + HOLD - 1 words in a row share a fingerprint there. Fingerprints of documents
and of benchmark items are joined; each hit carries the words around it, so that it is extended, and checked word for
word, without reading the texts again. Items shorter than a window are one gram of their own length.

A filter of fixed size made from the items' fingerprints drops most fingerprints of documents before the join; what it
lets through by chance the join drops.

Null and empty texts have no words. Equal rows are each returned. A null doc_id is kept as null. A null item_id counts
for hit words but is not among the item ids; equal items count once. An empty table of documents gives no rows, without
items nothing is contaminated. Texts of any length are read whole, some megabytes at a time. keep_clean() keeps all
columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, spare_name

WINDOW, GRAM = 10, 5
HOLD = WINDOW - GRAM + 1
#: Bits of the filter, as a power of two: 2 MB whatever the size of the benchmark.
FILTER_BITS = 24
#: Copies of each item's fingerprint that a common fingerprint's documents are spread over.
SALT = 16
#: Bytes of texts that are worked on at once.
AT_ONCE = 4 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.ones(256, bool)
_IN_WORD[0x00:0x30] = _IN_WORD[0x3A:0x61] = _IN_WORD[0x7B:0x80] = False
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def _stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _powers(n: int) -> np.ndarray:
    out = np.empty(max(n, 1), np.uint64)
    out[0] = 1
    if n > 1:
        out[1:] = _MULTIPLY
        out = np.cumprod(out, dtype=np.uint64)
    return out


class Words:
    """The words of some texts, one text after another, as byte ranges and hashes."""

    def __init__(self, texts: list[str | None]):
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        # a byte that is in no word parts the texts
        self.bytes = _LOWER[np.frombuffer(b"\0" + b"\0".join(raw) + b"\0", np.uint8)]
        inside = _IN_WORD[self.bytes]
        turn = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        self.start, self.end = turn[::2], turn[1::2]
        edges = np.cumsum([0] + [len(r) + 1 for r in raw])
        self.first = np.searchsorted(self.start, edges)  # of each text its first word; then the number of words
        n, size = len(self.start), self.end - self.start
        if n:
            at = np.flatnonzero(inside)
            place = at - np.repeat(self.start, size)
            term = (self.bytes[at].astype(np.uint64) + np.uint64(1)) * _powers(int(size.max()))[place]
            self.hash = _stir(np.add.reduceat(term, np.concatenate([[0], np.cumsum(size)[:-1]])) + size.astype(np.uint64))
        else:
            self.hash = np.zeros(0, np.uint64)
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def grams(self, n: int) -> np.ndarray:
        """The hash of the n words from each word on; at a text's last words they go on into the next text."""
        if len(self.hash) < n:
            return np.zeros(0, np.uint64)
        out = np.zeros(len(self.hash) - n + 1, np.uint64)
        for i in range(n):
            out = out * _MULTIPLY + self.hash[i : i + len(out)]
        return _stir(out + np.uint64(n))

    def winnowed(self) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the fingerprints: of each HOLD grams within a text the smallest, of equal ones the last."""
        g = self.grams(GRAM)
        if len(g) < HOLD:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        n = len(g) - HOLD + 1
        least, where = g[:n].copy(), np.arange(n)
        for i in range(1, HOLD):
            other = g[i : i + n]
            better = other <= least
            least = np.where(better, other, least)
            where = np.where(better, np.arange(i, i + n), where)
        inside = self.text[:n] == self.text[WINDOW - 1 :]
        where = np.unique(where[inside])
        return where, g[where]

    def short(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of all grams of n words within a text."""
        g = self.grams(n)
        where = np.flatnonzero(self.text[: len(g)] == self.text[n - 1 :]) if len(g) else np.zeros(0, np.int64)
        return where, g[where]

    def span(self, a: int, b: int) -> list[str]:
        data = self.bytes
        return [data[self.start[i] : self.end[i]].tobytes().decode("utf-8", "surrogatepass") for i in range(a, b)]


_HITS = pa.list_(pa.struct([("fp", pa.int64()), ("size", pa.int32()), ("at", pa.int64()), ("left", pa.int32()), ("words", pa.list_(pa.string()))]))
_HITS_DDL = "array<struct<fp:bigint,size:int,at:bigint,left:int,words:array<string>>>"


def _batches(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    a = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= AT_ONCE:
            yield a, i + 1
            a, size = i + 1, 0
    if a < len(texts):
        yield a, len(texts)


def _found(w: Words, texts: int, sizes: list[int], passes) -> list[list[dict]]:
    """Of each text its fingerprints that pass, with up to HOLD - 1 words to either side of a gram of GRAM."""
    out: list[list[dict]] = [[] for _ in range(texts)]
    for n in [0, *sizes]:
        at, g = w.winnowed() if n == 0 else w.short(n)
        keep = passes(g)
        around = HOLD - 1 if n == 0 else 0
        for i, h in zip(at[keep].tolist(), g[keep].view(np.int64).tolist()):
            k = int(w.text[i])
            a, b = max(i - around, int(w.first[k])), min(i + (n or GRAM) + around, int(w.first[k + 1]))
            out[k].append({"fp": h, "size": n, "at": i - int(w.first[k]), "left": i - a, "words": w.span(a, b)})
    return out


def item_fingerprints(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, fp, size, left, words): the fingerprints of each item; size 0: winnowed, else one gram of the item."""

    def of(batches):
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in _batches(texts):
                w = Words(texts[a:b])
                count = np.diff(w.first)
                rows = _found(w, b - a, sorted({int(c) for c in count if 0 < c < WINDOW}), lambda g: slice(None))
                flat = [(ids[a + k], h) for k in range(b - a) for h in rows[k] if h["size"] == (0 if count[k] >= WINDOW else count[k])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i for i, _ in flat], pa.string()), *(pa.array([h[c] for _, h in flat], t) for c, t in (("fp", pa.int64()), ("size", pa.int32()), ("left", pa.int32()), ("words", pa.list_(pa.string()))))],
                    names=["item_id", "fp", "size", "left", "words"],
                )

    return items.select(F.col(item_id).cast("string").alias("item_id"), text).mapInArrow(of, "item_id string, fp long, size int, left int, words array<string>")


def filter_bits(fingerprints: DataFrame) -> np.ndarray:
    """A bit for each remainder of a fingerprint: 2 MB at most reach the driver, in parts of 4 KB."""
    bit = F.col("fp").bitwiseAND((1 << FILTER_BITS) - 1) + 1  # from 1 on, part k has the 32,768 bits after (k - 1) * 32,768
    rows = fingerprints.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect()
    out = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for r in rows:
        base = (r.part - 1) * 4096
        out[base : base + 4096] |= np.frombuffer(bytes(r.bits), np.uint8)
    return out


def document_hits(docs: DataFrame, sizes: list[int], bits: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, digest, n_words, hits): one row for each document; hits are the fingerprints that the filter lets through."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    kind = docs.schema[doc_id].dataType

    def of(batches):
        known = shared.value
        mask, eight = np.uint64((1 << FILTER_BITS) - 1), np.uint64(7)

        def passes(g):
            bit = g & mask
            return np.flatnonzero((known[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & eight).astype(np.uint8)) & 1)

        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in _batches(texts):
                w = Words(texts[a:b])
                hits = _found(w, b - a, sizes, passes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(np.diff(w.first), pa.int64()), pa.array(hits, _HITS)],
                    names=["doc_id", "digest", "n_words", "hits"],
                )

    return docs.select(doc_id, text, F.xxhash64(text)).mapInArrow(of, f"doc_id {kind.simpleString()}, digest bigint, n_words bigint, hits {_HITS_DDL}")


def extend(doc_words: list[str], doc_left: int, item_words: list[str], item_left: int, size: int) -> tuple[int, int] | None:
    """The longest common run of words around aligned fingerprints, as an offset from the document's and a length.

    None where it is shorter than the window (WINDOW words, or the whole of a short item).
    """
    need = size or WINDOW
    n = size or GRAM
    if doc_words[doc_left : doc_left + n] != item_words[item_left : item_left + n]:
        return None
    a = 0
    while a < min(doc_left, item_left) and doc_words[doc_left - a - 1] == item_words[item_left - a - 1]:
        a += 1
    b = 0
    while doc_left + n + b < len(doc_words) and item_left + n + b < len(item_words) and doc_words[doc_left + n + b] == item_words[item_left + n + b]:
        b += 1
    return (-a, a + n + b) if a + n + b >= need else None


def runs(found: DataFrame, prints: DataFrame) -> DataFrame:
    """(doc_id, digest, item_id, begin, length): the runs of words that documents share with items, a row for each hit."""
    hits = found.select("doc_id", "digest", F.explode("hits").alias("hit")).select("doc_id", "digest", "hit.*")
    hits = hits.withColumn("salt", F.pmod(F.xxhash64("doc_id", "digest", "at"), F.lit(SALT)).cast("int"))
    items = prints.select(
        "fp", "size", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"), "item_id", F.col("left").alias("item_left"), F.col("words").alias("item_words")
    )
    names = ("doc_id", "digest", "item_id", "words", "left", "size", "at", "item_words", "item_left")

    def extended(batches):
        for batch in batches:
            got = [(i, x) for i, x in enumerate(extend(*v) for v in zip(*(batch.column(c).to_pylist() for c in ("words", "left", "item_words", "item_left", "size")))) if x]
            kept = batch.take(pa.array([i for i, _ in got], pa.int64()))
            at = kept.column("at").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [kept.column("doc_id"), kept.column("digest"), kept.column("item_id"), pa.array([p + x[0] for p, (_, x) in zip(at, got)], pa.int64()), pa.array([x[1] for _, x in got], pa.int64())],
                names=["doc_id", "digest", "item_id", "begin", "length"],
            )

    kind = found.schema["doc_id"].dataType.simpleString()
    return hits.join(items, ["fp", "size", "salt"]).select(*names).mapInArrow(extended, f"doc_id {kind}, digest bigint, item_id string, begin bigint, length bigint")


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, digest, n_words, n_hit, item_ids): one row for each row of docs; item_ids are strings, sorted.

    digest is a hash of the text. A word is hit if it is in a run that holds a whole window of an item.
    """
    prints = cut(item_fingerprints(items.select(item_id, item_text).distinct(), item_id, item_text))
    sizes = sorted(r[0] for r in prints.select("size").distinct().collect() if r[0])  # WINDOW - 1 of them at most
    found = cut(document_hits(docs, sizes, filter_bits(prints), doc_id, text))
    span = F.struct(F.col("begin").alias("a"), (F.col("begin") + F.col("length")).alias("b"))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))
    covered = F.aggregate(
        F.array_sort(F.collect_set(span)),
        start,
        lambda s, x: F.struct((s.n + F.greatest(F.lit(0).cast("long"), x.b - F.greatest(x.a, s.upto))).alias("n"), F.greatest(s.upto, x.b).alias("upto")),
        lambda s: s.n,
    )
    by_doc = runs(found, prints).groupBy(F.col("doc_id").alias("_doc"), F.col("digest").alias("_digest")).agg(covered.alias("n_hit"), F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    return found.join(by_doc, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("digest") == F.col("_digest")), "left").select(
        "doc_id", "digest", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids")
    )


def keep_clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of docs without a hit word, with the columns they had."""
    _doc, _digest = spare_name(docs, "_doc", "_digest")
    bad = contamination(docs, items).where("n_hit > 0").select(F.col("doc_id").alias(_doc), F.col("digest").alias(_digest)).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(F.col(_doc)) & (F.xxhash64(docs["text"]) == F.col(_digest)), "left_anti")


def query(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    got = contamination(docs, items)
    return got.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
