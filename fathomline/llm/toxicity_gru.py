"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

Each word enters as the sum of a vector of the word and the mean of vectors of its character n-grams, both hashed. Two
recurrent passes read a window of words, attention weighs their states, and a logistic unit scores the window.
Windows overlap by half and cover the whole text; the document's score is that of its highest window, put on the scale
of probabilities of documents.

Labels are of documents: training takes every window of a toxic document as toxic at first, then those that the network
itself finds to be. Every window of every training document is learnt from in every epoch; those of one document weigh
as much together as DOC_WEIGHT windows at most, so that long texts don't outweigh the others.

Nulls and empty texts score as a window without words; repeated rows score alike, and of windows of one score the first
counts. Without training rows nothing is toxic; an empty table of documents gives no rows. A column named as the score's is
replaced, all others are kept. Texts of any length are read in blocks of words, and the vectors of words are kept in a
bounded cache, so a worker's memory does not depend on the texts.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .common import labelled_sample

#: Words in a window and from one window to the next; training documents of each class at most.
WINDOW, HOP, PER_CLASS = 48, 24, 2000
#: Windows that all those of a training document weigh as much as, at most; highest ones of a clean one that weigh in full.
DOC_WEIGHT, HARD = 10, 1
#: Rows of the tables of word and n-gram vectors, width of inputs, states of each direction, lengths of n-grams.
WORDS, GRAMS, WIDTH, STATES, SPANS = 1 << 17, 1 << 17, 16, 8, (3, 4)
#: Epochs at least and at most; the mean loss of an epoch below which training ends; windows of a step, its rate, and by
#: how much later epochs go slower.
EPOCHS, MOST_EPOCHS, ENOUGH, BATCH, RATE, SLOWER = 5, 60, 0.03, 192, 0.02, 0.5
#: Words whose inputs a worker keeps, at most; windows that it scores at once; words that it reads at once; bytes of
#: words that it hashes at once.
CACHE, AT_ONCE, BLOCK, SOME = 80_000, 2048, 48_000, 1 << 18

_WORD = re.compile(r"\w+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> Iterator[str]:
    return (m.group() for m in _WORD.finditer((text or "").lower()))


def _grams(code: np.ndarray, owner: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the n-gram table, and owners, of the n-grams that begin in the first codes and lie within an owner."""
    power, rows, owners = code, [], []
    for n in range(2, max(SPANS) + 1):
        power = power[:-1] * np.uint64(257) + code[n - 1 :]
        if n in SPANS:
            inside = np.flatnonzero(owner[: len(power)][:first] == owner[n - 1 :][:first])
            rows.append((((power[inside] * _MIX) >> np.uint64(40)) % np.uint64(GRAMS)).astype(np.int32))
            owners.append(owner[inside])
    return np.concatenate(rows), np.concatenate(owners)


def _whole(code: np.ndarray, place: np.ndarray) -> np.ndarray:
    """What each byte adds to the hash of its word."""
    weight = (code + np.uint64(1)) * (place + np.uint64(1)) ** np.uint64(3) * _MIX
    return weight ^ (weight >> np.uint64(29))


def _word_row(total: np.ndarray) -> np.ndarray:
    return ((total * _MIX) >> np.uint64(35)).astype(np.int64) % WORDS


def _hashed_some(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    code = np.frombuffer(b"".join(b"\x02%b\x03" % w for w in words), np.uint8).astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    start = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(words), dtype=np.int32), size)
    rows, owners = _grams(code, owner, len(code))
    whole = np.add.reduceat(_whole(code, (np.arange(len(code)) - np.repeat(start, size)).astype(np.uint64)), start)
    return _word_row(whole), rows[np.argsort(owners, kind="stable")], np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=len(words)))])


def _hashed_long(word: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one word of any length, a part at a time."""
    raw, rows, total = np.frombuffer(b"\x02%b\x03" % word, np.uint8), [], np.zeros(1, np.uint64)
    for a in range(0, len(raw), SOME):
        code = raw[a : a + SOME + max(SPANS) - 1].astype(np.uint64)
        rows.append(_grams(code, np.zeros(len(code), np.int32), min(SOME, len(raw) - a))[0])
        total += _whole(code[:SOME], np.arange(a, a + len(code[:SOME]), dtype=np.uint64)).sum(dtype=np.uint64)
    rows = np.concatenate(rows)
    return _word_row(total), rows, np.array([0, len(rows)])


def hashed(words: Iterable[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Some of the distinct words at a time: rows of the word table, rows of the n-gram table one after another, and
    where each word's begin."""
    some, size = [], 0
    for w in words:
        w = w.encode("utf-8", "surrogatepass")
        if len(w) > SOME // 4:
            if some:
                yield _hashed_some(some)
            yield _hashed_long(w)
            some, size = [], 0
            continue
        some.append(w)
        size += len(w) + 2
        if size > SOME:
            yield _hashed_some(some)
            some, size = [], 0
    if some:
        yield _hashed_some(some)


def hashed_all(words: Iterable[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same of all words at once."""
    parts = list(hashed(words)) or [(np.zeros(0, np.int64), np.zeros(0, np.int32), np.array([0]))]
    ends = np.cumsum([0] + [len(g) for _, g, _ in parts])
    return (
        np.concatenate([w.astype(np.int32) for w, _, _ in parts]),
        np.concatenate([g for _, g, _ in parts]),
        np.concatenate([a[:-1] + e for (_, _, a), e in zip(parts, ends)] + [ends[-1:]]),
    )


def windows(n: int) -> np.ndarray:
    """Place of the first word of each window over n words; one window if there are none."""
    return np.arange(0, max(n - WINDOW + HOP, 1), HOP) if n > WINDOW else np.zeros(1, np.int64)


def window_words(codes: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the words of windows, T by B, and whether there is a word; T is the size of the largest."""
    place = np.arange(max(1, int(size.max())))[:, None]
    return codes[np.minimum(start + place, len(codes) - 1)], place < size


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


def place_in(group: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Of each row its place by key within its group, from 0."""
    order = np.lexsort((key, group))
    first = np.flatnonzero(np.concatenate([[True], group[order][1:] != group[order][:-1]]))
    out = np.empty(len(group), np.int64)
    out[order] = np.arange(len(group)) - np.repeat(first, np.diff(np.append(first, len(group))))
    return out


def summed(rows: np.ndarray, grad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows, in order, and the sum of the gradients of each."""
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    return rows[first], np.add.reduceat(grad[order], first)


@dataclass(eq=False)
class Network:
    """Parameters, with the two directions stacked on the first axis; slope and offset turn a logit into a document's."""

    p: dict[str, np.ndarray]
    slope: float = 1.0
    offset: float = 0.0

    @classmethod
    def start(cls, seed: int = 3) -> Network:
        draw = np.random.default_rng(seed)
        normal = lambda *s, by=0.3: (draw.standard_normal(s) * by).astype(np.float32)
        h = STATES
        return cls(
            {
                "word": normal(WORDS, WIDTH, by=0.02),
                "gram": normal(GRAMS, WIDTH, by=0.1),
                "wx": normal(WIDTH, 6 * h),
                "b": np.zeros(6 * h, np.float32),
                "u": normal(2, h, 3 * h),
                "a": normal(2 * h, 2 * h),
                "v": normal(2 * h),
                "o": normal(2 * h),
                "c": np.zeros(1, np.float32),
            }
        )

    def inputs(self, words: Iterable[str]) -> np.ndarray:
        """The input vectors of distinct words."""
        out = [np.zeros((0, WIDTH), np.float32)]
        for whole, grams, at in hashed(words):
            vec = np.empty((len(whole), WIDTH), np.float32)
            for i in range(0, len(whole), 4096):  # the n-grams of some words at a time
                a, b = at[i], at[min(i + 4096, len(whole))]
                vec[i : i + 4096] = self._mean(grams[a:b], at[i : i + 4097] - a)
            out.append(self.p["word"][whole] + vec)
        return np.concatenate(out)

    def _mean(self, grams: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Mean vectors of the n-grams from each place to the next."""
        total = np.zeros((len(at) - 1, WIDTH), np.float32)
        for a in range(0, len(grams), SOME):  # one word may have any number of them
            b = min(a + SOME, len(grams))
            first = np.searchsorted(at, a, "right") - 1
            inner = at[first + 1 : np.searchsorted(at, b)]
            total[first : first + len(inner) + 1] += np.add.reduceat(self.p["gram"][grams[a:b]], np.concatenate([[0], inner - a]).astype(np.int64))
        return total / np.diff(at)[:, None].astype(np.float32)

    def run(self, gates: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows. gates: T, B, 6h projected inputs, forward half first; mask: T, B, true at words."""
        p, h = self.p, STATES
        t, b = mask.shape
        # both directions step by step together, the second one from the end
        g = np.stack([gates[:, :, : 3 * h], gates[::-1, :, 3 * h :]], 1)
        on = np.stack([mask, mask[::-1]], 1)[..., None]
        state, both, saved = np.zeros((2, b, h), np.float32), np.empty((t, 2, b, h), np.float32), []
        for i in range(t):
            rec = state @ p["u"]
            zr = _sigmoid(g[i, :, :, : 2 * h] + rec[:, :, : 2 * h])
            new = np.tanh(g[i, :, :, 2 * h :] + zr[:, :, h:] * rec[:, :, 2 * h :])
            if keep:
                saved.append((state, zr, new, rec[:, :, 2 * h :]))
            state = np.where(on[i], state + zr[:, :, :h] * (new - state), state)
            both[i] = state
        states = np.concatenate([both[:, 0], both[::-1, 1]], 2)
        inner = np.tanh(states @ p["a"])
        energy = np.where(mask, inner @ p["v"], -1e9)
        energy = np.exp(energy - energy.max(0))
        attention = energy / energy.sum(0)
        pooled = np.einsum("tb,tbh->bh", attention, states)
        logit = pooled @ p["o"] + p["c"]
        return (logit, states, saved, inner, attention, pooled) if keep else logit

    def learn(self, x: np.ndarray, mask: np.ndarray, want: np.ndarray, weight: np.ndarray):
        """Gradients of the weighted logistic loss, that of the inputs x (T, B, width), and the loss, summed up."""
        p, h = self.p, STATES
        t, b = mask.shape
        logit, states, saved, inner, attention, pooled = self.run(x @ p["wx"] + p["b"], mask, keep=True)
        dl = (_sigmoid(logit) - want) * weight / b
        g = {"o": dl @ pooled, "c": dl.sum(keepdims=True), "u": np.zeros_like(p["u"])}
        dp = dl[:, None] * p["o"]
        dstate = attention[:, :, None] * dp
        da = np.einsum("tbh,bh->tb", states, dp)
        de = attention * (da - (attention * da).sum(0))
        g["v"] = np.einsum("tb,tbh->h", de, inner)
        di = de[:, :, None] * p["v"] * (1 - inner**2)
        g["a"] = np.einsum("tbi,tbj->ij", states, di, optimize=True)
        dstate += di @ p["a"].T
        dboth = np.stack([dstate[:, :, :h], dstate[::-1, :, h:]], 1)
        on = np.stack([mask, mask[::-1]], 1)[..., None]
        local, back, across = np.empty((t, 2, b, 3 * h), np.float32), np.zeros((2, b, h), np.float32), p["u"].transpose(0, 2, 1)
        for i in range(t - 1, -1, -1):
            state, zr, new, rec = saved[i]
            back = back + dboth[i]
            held = back * on[i]
            z, r = zr[:, :, :h], zr[:, :, h:]
            dn = held * z * (1 - new**2)
            local[i, :, :, :h] = held * (new - state) * z * (1 - z)
            local[i, :, :, h : 2 * h] = dn * rec * r * (1 - r)
            local[i, :, :, 2 * h :] = dn
            drec = local[i].copy()
            drec[:, :, 2 * h :] *= r
            g["u"] += state.transpose(0, 2, 1) @ drec
            back = back - held * z + drec @ across
        dgates = np.concatenate([local[:, 0], local[::-1, 1]], 2)
        g["wx"] = np.einsum("tbi,tbj->ij", x, dgates, optimize=True)
        g["b"] = dgates.sum((0, 1))
        loss = float((np.logaddexp(0, np.where(want == 1, -logit, logit)) * weight).sum())
        return g, dgates @ p["wx"].T, loss


def fit(texts: list[str], labels: list[int], seed: int = 3) -> Network:
    """Train on whole documents; a fifth of them, by turn, sets the scale of documents' scores.

    Training ends when the mean loss is small, so few documents take more epochs. Where the fifth lacks a class, all
    documents set the scale. Without documents of both classes the score is a constant on the side of the lone class
    (0 without any).
    """
    labels = np.asarray(labels, int)
    net = Network.start(seed)
    if len(set(labels.tolist())) < 2:
        net.slope, net.offset = 0.0, 4.0 if len(labels) and labels[0] == 1 else -4.0
        return net
    draw = np.random.default_rng(seed)
    ids: dict[str, int] = {}
    docs = [np.fromiter((ids.setdefault(w, len(ids)) for w in words_of(t)), np.int32) for t in texts]
    whole, grams, at = hashed_all(ids or [""])
    length = np.array([len(d) for d in docs])
    begin = np.cumsum(length) - length
    codes = np.append(np.concatenate(docs), np.int32(0))
    first = [windows(n) for n in length.tolist()]
    count = np.array([len(f) for f in first])
    owner = np.repeat(np.arange(len(docs)), count)
    start = np.concatenate(first) + begin[owner]
    size = np.minimum(begin[owner] + length[owner] - start, WINDOW)
    del docs, first, texts
    calibrate = np.arange(len(labels)) % 5 == 4
    if len(set(labels[calibrate].tolist())) < 2:
        calibrate[:] = False
    toxic, learnt = labels[owner] == 1, ~calibrate[owner]
    weight = np.minimum(1, DOC_WEIGHT / count[owner])
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step = 0

    def adam(name, rows, grad, rate):
        m, v = moment[name]
        m[rows] = 0.9 * m[rows] + 0.1 * grad
        v[rows] = 0.99 * v[rows] + 0.01 * grad**2
        net.p[name][rows] -= rate * (m[rows] / (1 - 0.9**step)) / (np.sqrt(v[rows] / (1 - 0.99**step)) + 1e-6)

    def tops(logit):
        top = np.full(len(labels), -np.inf)
        np.maximum.at(top, owner, logit)
        return top

    for epoch in range(MOST_EPOCHS):
        w, taken = weight, learnt
        if epoch >= 2:
            logit = score_windows(net, list(ids), codes, start, size)
            top = tops(logit)[owner]
            taken = learnt & ~(toxic & (logit < top) & (logit < 0))
            w = np.where(~toxic & (place_in(owner, -logit) < HARD), 1, weight)
        balance = min(0.5 / max(w[taken & toxic].sum() / w[taken].sum(), 1e-3), 5)
        w = (w * np.where(toxic, balance, 1)).astype(np.float32)
        order = draw.permutation(np.flatnonzero(taken))
        lost = 0.0
        for i in range(0, len(order), BATCH):
            pick = order[i : i + BATCH]
            words, mask = window_words(codes, start[pick], size[pick])
            step += 1
            used, place = np.unique(np.where(mask, words, 0), return_inverse=True)
            many = at[used + 1] - at[used]
            edge = np.cumsum(many) - many
            flat = grams[np.repeat(at[used] - edge, many) + np.arange(many.sum())]
            share = many[:, None].astype(np.float32)
            vec = net.p["word"][whole[used]] + np.add.reduceat(net.p["gram"][flat], edge) / share
            x = vec[place.reshape(words.shape)] * mask[:, :, None]
            g, dx, loss = net.learn(x, mask, toxic[pick].astype(np.float32), w[pick])
            lost += loss
            rate = RATE / (1 + epoch * SLOWER)
            for name, grad in g.items():
                adam(name, slice(None), np.clip(grad, -1, 1), rate)
            _, dv = summed(place.reshape(-1), (dx * mask[:, :, None]).reshape(-1, WIDTH))
            adam("word", *summed(whole[used], dv), rate)
            adam("gram", *summed(flat, np.repeat(dv / share, many, 0)), rate)
        if epoch + 1 >= EPOCHS and lost < ENOUGH * w[order].sum():
            break
    top = tops(score_windows(net, list(ids), codes, start, size))
    judged = calibrate if calibrate.any() else ~calibrate
    s, y = top[judged], labels[judged]
    cut = max(np.unique(s), key=lambda c: ((s >= c)[y == 1].mean() - (s >= c)[y == 0].mean(), -abs(c)))
    below = s[s < cut]
    middle = (cut + below.max()) / 2 if len(below) else cut - 1
    net.slope, net.offset = 1.0, float(np.log(0.3 / 0.7) - middle)
    return net


def score_windows(net: Network, vocabulary: list[str], codes: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Logits of windows over places in a list of distinct words."""
    return _score(net, net.inputs(vocabulary or [""]), codes, start, size)


def _score(net: Network, table: np.ndarray, codes: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    out = np.empty(len(start), np.float32)
    order = np.argsort(-size, kind="stable")  # short windows together take fewer steps
    for i in range(0, len(order), AT_ONCE):
        some = order[i : i + AT_ONCE]
        words, mask = window_words(codes, start[some], size[some])
        out[some] = net.run(table[words] @ net.p["wx"] + net.p["b"], mask)
    return out


class Scorer:
    """Scores documents; keeps the inputs of words it has seen, up to a bound."""

    def __init__(self, net: Network):
        self.net, self.ids, self.rows = net, {}, np.zeros((1 << 12, WIDTH), np.float32)

    def __call__(self, texts) -> np.ndarray:
        top = np.full(len(texts), -np.inf)
        owners, blocks, size = [], [], 0
        for k, text in enumerate(texts):
            for block in self._blocks(text):
                owners.append(k)
                blocks.append(block)
                size += len(block)
                if size > 2 * BLOCK:
                    self._some(owners, blocks, top)
                    owners, blocks, size = [], [], 0
        if blocks:
            self._some(owners, blocks, top)
        # rounded, as sums in single precision depend on what is scored together
        return np.round(_sigmoid(np.clip(top * self.net.slope + self.net.offset, -40, 40)), 5)

    def _blocks(self, text: str | None) -> Iterator[list[str]]:
        """The words of a text in blocks, each with the words that the next begins with, as far as windows reach."""
        words = words_of(text)
        block = list(itertools.islice(words, BLOCK + WINDOW))
        while len(block) == BLOCK + WINDOW:
            yield block[: BLOCK + WINDOW - HOP]
            block = block[BLOCK:] + list(itertools.islice(words, BLOCK))
        yield block

    def _some(self, owners: list[int], blocks: list[list[str]], top: np.ndarray) -> None:
        if len(self.ids) > CACHE:
            self.ids = {}
        ids, had = self.ids, len(self.ids)
        length = np.array([len(b) for b in blocks])
        codes = np.fromiter((ids.setdefault(w, len(ids)) for b in blocks for w in b), np.int32, length.sum())
        codes = np.append(codes, np.int32(0))
        if len(ids) > len(self.rows):
            grown = np.zeros((max(len(ids), 2 * len(self.rows)), WIDTH), np.float32)
            grown[:had] = self.rows[:had]
            self.rows = grown
        if len(ids) > had:
            self.rows[had : len(ids)] = self.net.inputs(itertools.islice(ids, had, None))
        first = [windows(n) for n in length.tolist()]
        of = np.repeat(np.arange(len(blocks)), [len(f) for f in first])
        begin = np.cumsum(length) - length
        start = np.concatenate(first) + begin[of]
        logit = _score(self.net, self.rows, codes, start, np.minimum(begin[of] + length[of] - start, WINDOW))
        np.maximum.at(top, np.array(owners)[of], logit)


#: The network that this process scored with last, and its scorer.
_last: list = [None, None]


def scorer(net: Network) -> Scorer:
    """The scorer of a network; the last one is kept in the process, with its words."""
    if _last[0] is not net:
        _last[:] = [net, Scorer(net)]
    return _last[1]


def train(docs: DataFrame, labels: DataFrame, modulus: int = 4, held_out: int = 2, per_class: int = PER_CLASS) -> Network:
    """Fit on at most per_class labelled documents of each class, none of them held out."""
    got = labelled_sample(docs, labels, "toxic", modulus, held_out, per_class).toPandas().sort_values("doc_id")
    return fit(got.text.tolist(), got.label.tolist())


def score_column(net: Network, text: Column | str) -> Column:
    """The score of each text, from 0 to 1."""
    shared = SparkSession.active().sparkContext.broadcast(net)  # a fixed number of parameters

    @F.pandas_udf(DoubleType())
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(scorer(shared.value)(texts), dtype=float)

    return of(text)


def score_toxicity(docs: DataFrame, net: Network, text: str = "text", score: str = "score") -> DataFrame:
    """All rows and columns of docs with a column of scores, which replaces one of that name."""
    return docs.withColumn(score, score_column(net, text))


def keep_clean(docs: DataFrame, net: Network, text: str = "text", below: float = 0.3) -> DataFrame:
    """The rows whose score is under the bound, with the columns they had."""
    return docs.where(score_column(net, text) < below)


def query(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    net = train(docs, labels)
    scored = score_toxicity(docs.select("doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False)).alias("held_out"), "text"), net)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
