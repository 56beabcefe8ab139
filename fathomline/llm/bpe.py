"""Byte-level BPE by the ranks of a public tokenizer: encoding, decoding and digests of both.

A pattern cuts a text into words. Each distinct word starts as single bytes; as long as two neighbouring pieces join to
a piece that has a rank, the pair of lowest rank, leftmost first, is merged. Equal words give equal ids, so a worker
folds each distinct word once and keeps the result in a bounded cache. Decoding concatenates the pieces of the ids.

encode_words() does the same fold with Spark's higher-order functions, over a table of distinct words, with the ranks
as a literal: Spark searches a map from its front, so the literal is an array of short maps by a hash of the piece.

Null texts are empty. Every text is encoded whole. Equal rows are each returned, with equal ids; a null id is kept; an
empty table gives no rows. encode() and decode() keep all other columns; a column of a result's name is replaced.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words whose ids a worker keeps, at most; bytes of text whose ids it holds at once.
CACHE, AT_ONCE = 400_000, 8 << 20
#: Short maps in the literal of encode_words().
BUCKETS = 1 << 16


def production() -> tuple[str, str]:
    """(rank file, pattern) of the tokenizer that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@functools.lru_cache(4)
def read_ranks(path: str) -> dict[bytes, int]:
    """The rank file: on each line a piece in base64 and its rank, which is also its id."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def fold(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one word. Time grows with the square of its length at worst, so long words keep their ranks by pair."""
    if word in ranks:
        return [ranks[word]]
    pieces = [word[i : i + 1] for i in range(len(word))]
    if len(pieces) > 256:
        return _fold_long(pieces, ranks)
    none = 1 << 62
    pair = [ranks.get(a + b, none) for a, b in zip(pieces, pieces[1:])]
    while pair and (least := min(pair)) < none:
        i = pair.index(least)
        pieces[i : i + 2] = [pieces[i] + pieces[i + 1]]
        del pair[i]
        if i:
            pair[i - 1] = ranks.get(pieces[i - 1] + pieces[i], none)
        if i < len(pair):
            pair[i] = ranks.get(pieces[i] + pieces[i + 1], none)
    return [ranks[p] for p in pieces]


def _fold_long(pieces: list[bytes], ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap of pairs and linked pieces: for words of many thousands of bytes."""
    import heapq

    n = len(pieces)
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    heap = [(r, i, pieces[i], pieces[i + 1]) for i in range(n - 1) if (r := ranks.get(pieces[i] + pieces[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i] if pieces[i] else -1
        if j < 0 or pieces[i] != a or pieces[j] != b:
            continue  # one of the two has been merged since
        pieces[i], pieces[j] = a + b, b""
        after[i] = after[j]
        if after[i] >= 0:
            before[after[i]] = i
        for k in (before[i], i):
            if k >= 0 and after[k] >= 0 and (r := ranks.get(pieces[k] + pieces[after[k]])) is not None:
                heapq.heappush(heap, (r, k, pieces[k], pieces[after[k]]))
    return [ranks[p] for p in pieces if p]


class Codec:
    """Encodes and decodes with one rank file and pattern; keeps the ids of words it has met, up to a bound."""

    def __init__(self, path: str, pattern: str):
        self.ranks, self.find, self.seen = read_ranks(path), regex.compile(pattern).findall, {}
        self.pieces = {i: p for p, i in self.ranks.items()}

    def _packed(self, word: str) -> bytes:
        got = np.array(fold(word.encode("utf-8", "replace"), self.ranks), "<u4").tobytes()
        if len(self.seen) >= CACHE:
            self.seen.clear()
        self.seen[word] = got
        return got

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers, one after another."""
        seen, new = self.seen, self._packed
        return b"".join([seen.get(w) or new(w) for w in self.find(text or "")])

    def decode(self, ids: bytes) -> bytes:
        pieces = self.pieces
        return b"".join([pieces[i] for i in np.frombuffer(ids, "<u4").tolist()])


@functools.lru_cache(2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """All rows and columns of docs with a binary column of ids (little-endian, 32 bits), replacing one of that name."""

    @F.pandas_udf("binary")
    def of(texts):
        c = codec(path, pattern)
        return texts.map(c.encode)

    return docs.withColumn(ids, of(F.coalesce(text, F.lit(""))))


def decode(rows: DataFrame, path: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """All rows and columns with the bytes that the ids stand for; null ids give null."""

    @F.pandas_udf("binary")
    def of(packed):
        c = codec(path, pattern)
        return packed.map(lambda x: None if x is None else c.decode(x))

    return rows.withColumn(decoded, of(F.col(ids)))


def digests(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode() and decode() in one pass, without carrying the ids."""

    def of(batches):
        c = codec(path, pattern)
        for batch in batches:
            counts, a, b = [], [], []
            for t in batch.column(1).to_pylist():
                packed = c.encode(t)
                counts.append(len(packed) // 4)
                a.append(hashlib.sha256(packed).hexdigest())
                b.append(hashlib.sha256(c.decode(packed)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(doc_id, text).mapInArrow(of, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def length_column(path: str, pattern: str, text: Column | str) -> Column:
    """The number of ids of each text."""

    @F.pandas_udf("bigint")
    def of(texts):
        c = codec(path, pattern)
        return texts.map(lambda t: len(c.encode(t)) // 4).astype("int64")

    return of(text)


def rank_literal(path: str, buckets: int = BUCKETS) -> Column:
    """The ranks as an array of maps from a piece in hexadecimal to its rank; a piece's place is a hash of that text.

    The planner folds it to one literal. Its size is that of the rank file.
    """
    import xxhash

    maps: list[dict[str, int]] = [{} for _ in range(buckets)]
    for piece, rank in read_ranks(path).items():
        key = piece.hex().upper()
        maps[xxhash.xxh64_intdigest(key.encode(), 42) % buckets][key] = rank
    return F.from_json(F.lit(json.dumps(maps, separators=(",", ":"))), "array<map<string,int>>")


def encode_words(words: DataFrame, path: str, word: str = "word", ids: str = "ids", buckets: int = BUCKETS) -> DataFrame:
    """words (distinct, not null) with an array of ids: the ranked merges as a fold of higher-order functions.

    The state is the list of pieces, in hexadecimal. Each of as many steps as the word has bytes merges the leftmost
    pair of least rank; a step that finds none leaves the state.
    """
    table = rank_literal(path, buckets)
    # F.xxhash64 is signed; its unsigned remainder by a power of two is its low bits
    rank = lambda p: table.getItem(F.xxhash64(p).bitwiseAND(buckets - 1).cast("int")).getItem(p)
    text = F.hex(F.encode(F.col(word), "UTF-8"))
    start = F.transform(F.sequence(F.lit(0), F.greatest(F.length(text) / 2 - 1, F.lit(0)).cast("int")), lambda i: F.substring(text, i * 2 + 1, F.lit(2)))

    def step(pieces: Column, _: Column) -> Column:
        pair = F.zip_with(F.slice(pieces, 1, F.size(pieces) - 1), F.slice(pieces, 2, F.size(pieces)), lambda a, b: F.concat(a, b))
        ranked = F.transform(pair, lambda p, i: F.struct(F.coalesce(rank(p), F.lit(2**31 - 1)).alias("rank"), i.alias("at")))
        best = F.array_min(ranked)
        merged = lambda at: F.concat(F.slice(pieces, F.lit(1), at), F.array(F.concat(pieces.getItem(at), pieces.getItem(at + 1))), F.slice(pieces, at + 3, F.size(pieces)))
        return F.when((F.size(pieces) < 2) | (best["rank"] == 2**31 - 1), pieces).otherwise(merged(best["at"]))

    folded = F.aggregate(start, start, step)
    whole = rank(text)
    return words.withColumn(ids, F.when(whole.isNotNull(), F.array(whole)).otherwise(F.transform(folded, rank)))


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return digests(docs, *production())
