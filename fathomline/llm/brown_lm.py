"""LM scoring by Brown's class-based bigrams.

Exchange clustering gives the most frequent words, and the shapes of all others, classes: they move, one at a time, to
the class that raises the likelihood of the class bigrams most. Every other word of the table that occurs often enough is
then assigned to the class which explains its own neighbours best, from counts over the whole corpus; words that don't
are in the class of their shape (the kind of their characters and their last letters). Class bigrams are counted again
with the final classes. A text's probability is the product, over its tokens, of the probability of the token's class
after the class before it and of the token in its class.

Texts are read once, into numbers: the place of a word in the table of the most frequent words, which goes to every task,
or else its shape. All counts are over all training texts; those of words beyond the table are joined by word. So counts
and base scores don't depend on the size of the table.

Null texts are empty: they have the end token only; repeated rows score alike. Training without texts leaves smoothed
probabilities of nothing. Columns to keep may have any name but those of the results.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut

#: Words and shapes that are clustered by exchanges, classes, and rounds of exchanges.
CLUSTERED, SHAPES, CLASSES, ROUNDS = 1500, 500, 128, 4
#: Words whose counts and classes go to every task; occurrences from which a word is assigned by its own neighbours.
TABLE, ASSIGNED = 200_000, 2
#: Added to each count of a word, and to each count of a class bigram.
ADD, ADD_CLASS = 0.5, 0.1
#: Entries of a task's counters before they are handed on, and of words whose shape it remembers; bytes of text that it
#: works on at once.
HELD, REMEMBERED, AT_ONCE = 200_000, 100_000, 4 << 20
END = "\n"  # no word contains white space
START_UNIT, END_UNIT = 0, 1


def magnitude(c) -> Column:
    """Sixteen steps for each doubling of a count."""
    return F.floor(F.log2(c) * 16).cast("int")


def tokens(text: str | None) -> list[bytes]:
    """Words in lower case (A to Z only), parted by ASCII white space, without the end token."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _text(word: bytes) -> str:
    return word.decode("utf-8", "surrogatepass").encode("utf-8", "replace").decode()


def shape(word: bytes) -> str:
    """One of a bounded number of shapes: kinds of characters, what ends the word, and its last two letters."""
    high = any(b > 127 for b in word)
    digit = any(48 <= b < 58 for b in word)
    body = word.rstrip(b".,;:!?|#$%&*()[]{}<>\"'=+-_/@~^`\\")
    tail = {0: "", 1: word[-1:].decode("ascii", "replace")}.get(min(len(word) - len(body), 2), word[-2:-1].decode("ascii", "replace") + "+")
    if not body:
        return f"\tmark{tail}"
    if digit:
        return f"\tdigit{int(high)}"
    last = bytes(b if 97 <= b < 123 else 35 for b in body[-2:]).decode()
    return f"\t{'h' if high else 'l'}{last}{'.' if tail else ''}"


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, c): exact counts over all texts; task-side counters of bounded size come first."""

    def of(batches):
        have: Counter = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array([_text(w) for w in have], pa.string()), pa.array(list(have.values()), pa.int64())], names=["word", "c"])
            have.clear()
            return out

        for batch in batches:
            ends = 0
            for t in batch.column(0).to_pylist():
                have.update(tokens(t))
                ends += 1
                if len(have) > HELD:
                    yield flush()
            have[END.encode()] += ends
        yield flush()

    return docs.select(text).mapInArrow(of, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def exchange(bigrams: np.ndarray, classes: int, fixed: int, rounds: int = ROUNDS) -> np.ndarray:
    """The class of each unit. bigrams: counts by (unit, next unit); the first units, fixed of them, are classes alone.

    Units start in classes by turn of their frequency. Each round tries, for each unit in that order, every class, and
    moves it to the one of highest likelihood: sum of n log n over class bigrams, less that over classes on either side.
    """
    v = len(bigrams)
    free = np.argsort(-(bigrams.sum(0) + bigrams.sum(1)), kind="stable")
    free = free[free >= fixed]
    k = fixed + max(1, min(classes, len(free)))
    of = np.zeros(v, np.int64)
    of[:fixed] = np.arange(fixed)
    of[free] = fixed + np.arange(len(free)) % (k - fixed)
    member = np.zeros((v, k))
    member[np.arange(v), of] = 1
    out, into = bigrams @ member, bigrams.T @ member  # of each unit: counts to and from each class
    n = member.T @ out
    f = lambda x: x * np.log(np.maximum(x, 1e-12))
    for _ in range(rounds):
        moved = 0
        for w in free:
            a = of[w]
            own = bigrams[w, w]
            o, i = out[w], into[w]
            # take the unit out of its class
            n[a] -= o
            n[:, a] -= i
            n[a, a] += own
            ow, iw = o.sum(), i.sum()
            o_, i_ = o.copy(), i.copy()
            o_[a] -= own
            i_[a] -= own
            row, col = n.sum(1) + i_, n.sum(0) + o_  # with what other units give to it and take from it
            base = f(n)
            gain = (f(n + o_[None]) - base).sum(1) + (f(n + i_[:, None]) - base).sum(0)
            d = np.arange(k)
            gain -= f(n[d, d] + o_) - base[d, d] + f(n[d, d] + i_) - base[d, d]
            gain += f(n[d, d] + o_ + i_ + own) - base[d, d]
            gain -= f(row + ow) - f(row) + f(col + iw) - f(col)
            gain[:fixed] = -np.inf
            b = int(gain.argmax())
            if gain[b] <= gain[a] + 1e-9:
                b = a
            o, i = o_.copy(), i_.copy()
            n[b] += o
            n[:, b] += i
            n[b, b] += own
            if b != a:
                moved += 1
                of[w] = b
                out[:, a] -= bigrams[:, w]
                out[:, b] += bigrams[:, w]
                into[:, a] -= bigrams[w]
                into[:, b] += bigrams[w]
        if not moved:
            break
    return of


@dataclass(eq=False)
class Words:
    """The table of the most frequent words, with their counts, and the numbers of the common shapes; one more is all others.

    A token's number is its place in the table, or the table's size plus the number of its shape.
    """

    words: list[bytes]
    often: np.ndarray
    shapes: dict[str, int]
    least: int  # the least magnitude of counts that the table has in full
    total: int
    distinct: int
    beyond: np.ndarray  # by shape: how many words beyond the table there are, and how often they occur

    @property
    def end(self) -> int:
        return self.words.index(END.encode()) if END.encode() in self.words else -1

    def shape_of(self, word: bytes) -> int:
        return self.shapes.get(shape(word), len(self.shapes))


class Numbers(dict):
    """Word -> number; shapes of words beyond the table are remembered up to a bound."""

    def __init__(self, table: Words):
        super().__init__((w, i) for i, w in enumerate(table.words))
        self.table, self.size, self.more = table, len(table.words), {}

    def __missing__(self, word: bytes) -> int:
        if (got := self.more.get(word)) is None:
            if len(self.more) > REMEMBERED:
                self.more = {}
            got = self.more[word] = self.size + self.table.shape_of(word)
        return got


#: The table that this process read texts with last, and its numbers.
_last: list = [None, None]


def numbers(table: Words) -> Numbers:
    if _last[0] is not table:
        _last[:] = [table, Numbers(table)]
    return _last[1]


def tabulate(counts: DataFrame, size: int = TABLE, clustered: int = CLUSTERED) -> Words:
    """The table of words, from all counts (word, c): as many magnitudes of counts, from the highest, as fit the size."""
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    # there are some hundreds of magnitudes
    sizes = {r.m: r.n for r in counts.groupBy(magnitude(F.col("c")).alias("m")).agg(F.count("*").alias("n")).collect()}
    least, room = 1 << 30, size
    for m in sorted(sizes, reverse=True):
        if (room := room - sizes[m]) < 0:
            break
        least = m
    top = counts.where((magnitude(F.col("c")) >= least) | (F.col("word") == END)).toArrow().sort_by([("c", "descending"), ("word", "ascending")])
    words, often = [w.encode() for w in top["word"].to_pylist()], top["c"].to_numpy()
    del top

    def shapes(batches):
        for batch in batches:
            n: Counter = Counter()
            d: Counter = Counter()
            for w, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                s = shape(w.encode())
                n[s] += c
                d[s] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64()), pa.array([d[s] for s in n], pa.int64())], names=["shape", "n", "d"])

    # shape() has some 3,100 values
    rare = counts.where((magnitude(F.col("c")) < least) & (F.col("word") != END)).select("word", "c")
    kinds = {r["shape"]: (r.n, r.d) for r in rare.mapInArrow(shapes, "shape string, n long, d long").groupBy("shape").agg(F.sum("n").alias("n"), F.sum("d").alias("d")).collect()}
    all_: Counter = Counter({k: n for k, (n, _) in kinds.items()})
    seeds = clustered + (END.encode() in words[:clustered])
    for w, c in zip(words[seeds:], often[seeds:].tolist()):
        if w != END.encode():
            all_[shape(w)] += c
    names = [k for k, _ in sorted(all_.items(), key=lambda x: (-x[1], x[0]))[:SHAPES]]
    number = {k: i for i, k in enumerate(names)}
    beyond = np.zeros((2, len(names) + 1))
    for k, (n, d) in kinds.items():
        beyond[:, number.get(k, len(names))] += d, n
    return Words(words, often, number, least, int(total), int(distinct), beyond)


def _some(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of some AT_ONCE bytes of text, which is its last column, by rows."""
    rows = max(1, int(batch.num_rows * AT_ONCE / max(batch.column(batch.num_columns - 1).nbytes, 1)))
    for a in range(0, batch.num_rows, rows):
        yield batch.slice(a, rows)


def read(docs: DataFrame, table: Words, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, columns to keep, ids, rare), written: each text as numbers, and its words beyond the table."""
    shared = docs.sparkSession.sparkContext.broadcast(table)  # TABLE words and a bounded number of shapes
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    lead = f"doc_id {kinds[doc_id]}" + "".join(f", {c} {kinds[c]}" for c in keep)
    names, rare_type = ["doc_id", *keep, "ids", "rare"], pa.list_(pa.struct([("word", pa.string()), ("times", pa.int32())]))

    def one(batch: pa.RecordBatch, number: Numbers) -> pa.RecordBatch:
        ids, words, times, ends = [], [], [], [0]
        for t in batch.column(batch.num_columns - 1).to_pylist():
            found = tokens(t)
            ids.append(np.fromiter(map(number.__getitem__, found), np.int32, len(found)))
            far = np.flatnonzero(ids[-1] >= number.size).tolist()
            counted = Counter([found[i] for i in far])
            words += map(_text, counted)
            times += counted.values()
            ends.append(len(words))
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, ids)]), pa.int32()), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32)))
        rare = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(words, pa.string()), pa.array(times, pa.int32())], fields=list(rare_type.value_type))).cast(rare_type)
        return pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(batch.num_columns - 1)), lists, rare], names=names)

    def of(batches):
        number = numbers(shared.value)
        for whole in batches:
            for batch in _some(whole):
                yield one(batch, number)

    return cut(docs.select(F.col(doc_id).alias("doc_id"), *keep, F.col(text).alias("_text")).mapInArrow(of, f"{lead}, ids array<int>, rare array<struct<word:string,times:int>>"))


def _sequence(lists: pa.Array, value: np.ndarray) -> np.ndarray:
    """Values of the tokens of some texts, one text after another, with START_UNIT before and END_UNIT after each."""
    size = np.diff(lists.offsets.to_numpy())
    rows = np.arange(len(size))
    ids = lists.flatten().to_numpy()
    out = np.full(len(ids) + 2 * len(size), END_UNIT, np.int64)
    out[np.cumsum(size + 2) - size - 2] = START_UNIT
    out[np.arange(len(ids)) + 2 * np.repeat(rows, size) + 1] = value[ids]
    return out


def _summed(texts: DataFrame, keys, shared) -> DataFrame:
    """(key, c): how often keys(ids, shared value) has each key; texts: (ids)."""

    def of(batches):
        have, times, parts, size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

        def gather():
            found, counts = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            both, place = np.unique(np.concatenate([have, found]), return_inverse=True)
            return both, np.bincount(place, np.concatenate([times, counts]), minlength=len(both)).astype(np.int64)

        out = lambda: pa.RecordBatch.from_arrays([pa.array(have), pa.array(times)], names=["key", "c"])
        for batch in batches:
            parts.append(keys(batch.column(0), shared.value))
            size += len(parts[-1])
            if size > 2_000_000:
                have, times = gather()
                parts, size = [], 0
                if len(have) > 10 * HELD:
                    yield out()
                    have, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        have, times = gather()
        yield out()

    return texts.select("ids").mapInArrow(of, "key long, c long").groupBy("key").agg(F.sum("c").alias("c"))


def _pairs(lists: pa.Array, shared: tuple[np.ndarray, int]) -> np.ndarray:
    value, n = shared
    at = _sequence(lists, value)
    return (at[:-1] * n + at[1:])[at[:-1] != END_UNIT]


def bigrams(texts: DataFrame, value: np.ndarray, n: int) -> np.ndarray:
    """Counts of pairs of neighbouring values, which are below n; the square of n is what comes to the driver at most."""
    got = _summed(texts, _pairs, texts.sparkSession.sparkContext.broadcast((value, n))).toArrow()
    out = np.zeros(n * n)
    out[got["key"].to_numpy()] = got["c"].to_numpy()
    return out.reshape(n, n)


def _contexts(lists: pa.Array, shared: tuple[np.ndarray, np.ndarray, int]) -> np.ndarray:
    value, asked, n = shared
    at, own = _sequence(lists, value), _sequence(lists, np.arange(2, len(value) + 2))
    place = np.flatnonzero((own >= 2) & np.append(asked, [False, False])[own - 2])
    own = (own[place] - 2) * (2 * n)
    return np.concatenate([own + at[place - 1], own + n + at[place + 1]])


def assign(texts: DataFrame, value: np.ndarray, asked: np.ndarray, move: np.ndarray, mass: np.ndarray) -> np.ndarray:
    """value with the classes of the asked numbers replaced by those that explain their neighbours best.

    That is the class c of the highest sum, over occurrences, of log P(c | class before) + log P(class after | c), less the
    logarithm of the class's mass.
    """
    n = len(move)
    shared = texts.sparkSession.sparkContext.broadcast((value, asked, n))
    got = _summed(texts, _contexts, shared)
    width = F.lit(2 * n)
    each = got.groupBy(F.floor(F.col("key") / width).alias("id")).agg(F.collect_list(F.struct((F.col("key") % width).cast("int").alias("at"), "c")).alias("m"))  # 2 n at most
    into, onto = np.log(10) * move, np.log(10) * move.T

    def best(batches):
        for batch in batches:
            lists = batch.column(1)
            flat, size = lists.flatten(), np.diff(lists.offsets.to_numpy())
            counts = np.zeros((len(size), 2 * n))
            counts[np.repeat(np.arange(len(size)), size), flat.field("at").to_numpy()] = flat.field("c").to_numpy()
            gain = counts[:, :n] @ into + counts[:, n:] @ onto - counts[:, :n].sum(1)[:, None] * np.log(np.maximum(mass, 1e-9))
            gain[:, :2] = -np.inf
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(gain.argmax(1).astype(np.int32))], names=["id", "class"])

    found = each.mapInArrow(best, "id long, class int").toArrow()  # TABLE rows at most
    value = value.copy()
    value[found["id"].to_numpy()] = found["class"].to_numpy()
    return value


@dataclass(eq=False)
class BrownModel:
    """Log10 probabilities. of: class by number; move[class, class]; mass: of each class, the sum of its words' smoothed
    counts, one more for an unknown word of each of its shapes."""

    table: Words
    of: np.ndarray
    move: np.ndarray
    mass: np.ndarray


def _moves(pairs: np.ndarray) -> np.ndarray:
    """Log10 probabilities of classes after classes; nothing moves to the start."""
    out = np.log10((pairs + ADD_CLASS) / (pairs[:, 1:].sum(1, keepdims=True) + ADD_CLASS * (len(pairs) - 1)))
    out[:, START_UNIT] = -np.inf
    return out


def _mass(table: Words, of: np.ndarray) -> np.ndarray:
    size, n = len(table.words), int(of.max()) + 1
    smoothed = np.concatenate([table.often + ADD, table.beyond[1] + ADD * (table.beyond[0] + 1)])
    mass = np.bincount(of, smoothed, minlength=max(n, 2))
    mass[START_UNIT], mass[END_UNIT] = 1, 1
    assert len(smoothed) == size + len(table.shapes) + 1
    return mass


def fit(texts: DataFrame, table: Words, clustered: int = CLUSTERED, classes: int = CLASSES, assigned: int = ASSIGNED) -> BrownModel:
    """The model of training texts (ids), as read() gives them."""
    size, end = len(table.words), table.end
    seeds = [i for i in range(min(size, clustered + 1)) if i != end][:clustered]
    first = 2 + len(seeds)
    unit = np.empty(size + len(table.shapes) + 1, np.int64)
    unit[:size] = [first + table.shape_of(w) for w in table.words]
    unit[size:] = first + np.arange(len(table.shapes) + 1)
    unit[seeds] = 2 + np.arange(len(seeds))
    if end >= 0:
        unit[end] = END_UNIT
    pairs = bigrams(texts, unit, first + len(table.shapes) + 1)
    of_unit = exchange(pairs, classes, 2)
    n = int(of_unit.max()) + 1
    member = np.zeros((len(of_unit), n))
    member[np.arange(len(of_unit)), of_unit] = 1
    of = of_unit[unit]
    asked = np.zeros(len(unit), bool)
    asked[:size] = table.often >= assigned
    asked[seeds] = False
    if end >= 0:
        asked[end] = False
    if asked.any():
        move = np.maximum(_moves(member.T @ pairs @ member), -300)
        of = assign(texts, of, asked, move, _mass(table, of))
        pairs = bigrams(texts, of, n)
    else:
        pairs = member.T @ pairs @ member
    return BrownModel(table, of, _moves(pairs), _mass(table, of))


def train(docs: DataFrame, clustered: int = CLUSTERED, classes: int = CLASSES, common: int = TABLE, assigned: int = ASSIGNED) -> tuple[BrownModel, DataFrame]:
    """The model and the table (word, c) of all counts, in the shared folder."""
    counts = cut(word_counts(docs))
    table = tabulate(counts, common, clustered)
    docs = docs.select(F.lit(0).alias("doc_id"), "text")
    return fit(read(docs, table), table, clustered, classes, assigned), counts


def score_read(rows: DataFrame, model: BrownModel, counts: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, columns to keep, n_tokens, n_known, train_tokens, base_score, score of texts as read() gives them."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    # written rows keep their partitions, so these numbers hold
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    lead = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name in ("row", "doc_id", *keep))
    names = [*(c for c in rows.columns if c in ("row", "doc_id", *keep)), "n_tokens", "n_known", "base", "own"]

    def of(batches):
        m = shared.value
        size, end = len(m.table.words), m.table.end
        log = np.append(np.log10(m.table.often + ADD), np.zeros(len(m.of) - size))  # words beyond the table are joined
        emit = log - np.log10(m.mass)[m.of]
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            at, ids = _sequence(lists, m.of), lists.flatten().to_numpy()
            length = np.diff(lists.offsets.to_numpy())
            row = np.repeat(np.arange(len(length)), length)
            total = lambda x: np.bincount(row, x, minlength=len(length))
            went = np.where(at[:-1] != END_UNIT, m.move[at[:-1], at[1:]], 0.0)
            begin = np.cumsum(length + 2) - length - 2
            moved = np.add.reduceat(went, begin) if len(went) else np.zeros(0)
            known = total(ids < size).astype(np.int64) + (end >= 0)
            base = total(log[ids]) + np.log10((m.table.often[end] if end >= 0 else 0) + ADD)
            own = moved + total(emit[ids])
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(batch.num_columns - 1)), pa.array(length.astype(np.int64) + 1), pa.array(known), pa.array(base), pa.array(own)], names=names)

    got = rows.select(*names[:-4], "ids").mapInArrow(of, f"{lead}, n_tokens bigint, n_known bigint, base double, own double")
    words = rows.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.times")
    others = counts.where(magnitude(F.col("c")) < model.table.least)
    joined = words.join(others, "word", "left").select("row", "times", F.coalesce("c", F.lit(0)).alias("c"))
    log = F.log10(F.col("c") + ADD) * F.col("times")
    sums = joined.groupBy("row").agg(F.sum(log).alias("far"), F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("far_known"))
    whole = got.join(sums, "row", "left")
    far = F.coalesce("far", F.lit(0.0))
    below = float(np.log10(max(model.table.total + ADD * (model.table.distinct + 1), ADD)))
    return whole.select(
        "doc_id",
        *keep,
        "n_tokens",
        (F.col("n_known") + F.coalesce("far_known", F.lit(0))).alias("n_known"),
        F.lit(model.table.total).cast("long").alias("train_tokens"),
        (F.col("base") + far - F.col("n_tokens") * below).alias("base_score"),
        (F.col("own") + far).alias("score"),
    )


def score(docs: DataFrame, model: BrownModel, counts: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """A row for each row of docs: doc_id, columns to keep, n_tokens, n_known, train_tokens, base_score, score."""
    return score_read(read(docs, model.table, doc_id, text, keep), model, counts, keep)


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False))
    docs = docs.select("doc_id", held.alias("held_out"), "text")
    counts = cut(word_counts(docs.where("NOT held_out")))
    table = tabulate(counts)
    rows = read(docs, table, keep=("held_out",))
    return score_read(rows, fit(rows.where("NOT held_out"), table), counts, ("held_out",))
