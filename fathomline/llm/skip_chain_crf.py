"""Personal data by a skip-chain conditional random field.

Four kinds are looked for: email, ip, card, phone. Plain patterns find base spans, which always stay. The field adds
spans that the patterns miss, as two cards, or a phone and an address, written side by side. (A phone without its prefix
far from its full form stays out where documents repeat too little to teach that repeats share a label.)

Nodes are the tokens of a text that hold a digit or an @; other tokens can be of no kind. A node has a label, none or a
kind, and potentials of its own (lengths, separators, marks, the check digit). Nodes next to each other in the text are
joined in a chain. Nodes at any distance that repeat or resemble each other are joined by skip edges: all nodes of one
key (the digits alone, or the token in small letters; the last seven digits; a mail's part before the @) meet in one
hidden label of the key, so the edges are as many as the nodes, however often a token is repeated. Loopy message
passing, damped, gives each node's probabilities, with nodes under base spans held at their label.

Weights are learned by pseudo-likelihood: a node's label given its neighbours'. All features are discrete, so a node is
one of a bounded number of patterns, and Spark counts the patterns of all documents; the driver fits some hundred
weights to the counts. Texts are read once, into a table of nodes.

Null and empty texts have no spans. Equal rows are each returned, with equal spans; a null id is kept. Texts are read
whole, in time proportional to their length. Tokens with fewer than four letters and digits have no skip edges. Without
any node nothing is learned and nothing added; an empty table gives no rows. Other columns aren't read.
"""

from __future__ import annotations

import bisect
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut

KINDS = ("email", "ip", "card", "phone")
#: Probability from which on a node is given a kind.
SURE = 0.9
#: Rounds of messages at most, the part of a message that is kept, and the change at which messages stop.
ROUNDS, DAMPING, STILL = 40, 0.3, 1e-3
#: Weight of the penalty on squared weights, and steps of the fit.
PENALTY, STEPS = 1e-4, 600
#: Nodes that messages are passed among at once.
AT_ONCE = 200_000

_HEAD = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_MAIL = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*")
_EDGE_LEFT, _EDGE_RIGHT = re.compile(r"[^0-9A-Za-z+(]*"), re.compile(r"[0-9A-Za-z)]")
_DIGITS = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    double = sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])
    return (double + sum(map(int, digits[-1::-2]))) % 10 == 0


def _octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """((kind, start, end), ...) by kind and start; and the places of runs of digits too long for a card or a phone."""
    out, long = [], []
    end, at = 0, text.find("@")
    while at >= 0:
        a = at
        while a > end and text[a - 1] in _HEAD:
            a -= 1
        if a < at and (m := _MAIL.match(text, at)):
            end = m.end()
            out.append((0, a, end))
        at = text.find("@", at + 1)
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if _octets(m[0])]
    for m in _CARD.finditer(text):
        if m.end() - m.start() < 16:
            continue
        d = _DIGITS.sub("", m[0])
        if len(d) > 19:
            long.append(m.span())
        elif len(d) >= 16 and luhn(d):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        n = len(_DIGITS.sub("", m[0]))
        if n > 15:
            long.append(m.span())
        elif n >= 8:
            out.append((3, m.start(), m.end()))
    return out, long


# nodes

#: Digits of a token, by the largest number of each class; 16 to 19 digits are two classes, by their check digit.
_LENGTHS = (0, 2, 5, 6, 7, 10, 14, 15)
N_LENGTHS, N_MARKS = len(_LENGTHS) + 3, 5
N_SHAPES = N_LENGTHS * N_MARKS * 16
NONE, UNKNOWN = 0, 5


def shape(token: str) -> int:
    """A token's class: its number of digits, the marks between them, letters, @, a leading + and brackets."""
    d = _DIGITS.sub("", token)
    n = len(d)
    size = bisect.bisect_left(_LENGTHS, n) if n <= 15 else len(_LENGTHS) + (2 if n > 19 else int(luhn(d)))
    letters = any(c.isalpha() for c in token)
    dots, dashes = token.count("."), token.count("-")
    quad = dots == 3 and not dashes and not letters and re.fullmatch(r"[0-9]+(\.[0-9]+){3}", token) is not None and _octets(token)
    marks = 4 if quad else 3 if dots and dashes else 2 if dots else 1 if dashes else 0
    return (size * N_MARKS + marks) * 16 + letters * 8 + ("@" in token) * 4 + token.startswith("+") * 2 + ("(" in token)


def keys(token: str) -> tuple[str | None, str | None]:
    """The keys under which a token meets those that repeat it and those that resemble it."""
    d = _DIGITS.sub("", token)
    if "@" in token:
        return token.lower(), "m:" + token.split("@")[0].lower() if token.index("@") >= 4 else None
    if any(c.isalpha() for c in token):
        low = token.lower()
        return (low, "m:" + low) if len(low) >= 4 else (None, None)
    if len(d) < 4:
        return None, None
    return (token if "." in token else d), ("d:" + d[-7:] if len(d) >= 7 else None)


def nodes(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, str, int, int]]]:
    """(base spans, nodes); a node: start, end, label, near (whether it follows the last node directly), as a tuple
    (start, end, token, label, near)."""
    base, long = base_spans(text)
    out, last = [], -1
    for m in _TOKEN.finditer(text):
        raw = m[0]
        a = _EDGE_LEFT.match(raw).end()
        b = len(raw)
        while b > a and not _EDGE_RIGHT.match(raw, b - 1):
            b -= 1
        if a < b:
            near = last >= 0 and text[last : m.start()].isspace()
            out.append([m.start() + a, m.start() + b, raw[a:b], NONE, int(near)])
            last = m.end()
    starts = [n[0] for n in out]
    for kind, a, b in [*((UNKNOWN, a, b) for a, b in long), *((k + 1, a, b) for k, a, b in reversed(base))]:
        i = max(bisect.bisect_right(starts, a) - 1, 0)
        while i < len(out) and out[i][0] < b:
            if out[i][1] > a:
                out[i][3] = kind
            i += 1
    return base, [tuple(n) for n in out]


def node_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, digest, base, nodes): a row for each row of docs, from one reading of its text."""
    kind = docs.schema[doc_id].dataType.simpleString()
    base_type = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
    node_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("token", pa.string()), ("label", pa.int32()), ("near", pa.int32())]))

    def of(batches):
        for batch in batches:
            found = [nodes(t) if t else ([], []) for t in batch.column(1).to_pylist()]
            base = [[dict(zip(("kind", "start", "end"), s)) for s in f[0]] for f in found]
            some = [[dict(zip(("start", "end", "token", "label", "near"), n)) for n in f[1]] for f in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(base, base_type), pa.array(some, node_type)], names=["doc_id", "digest", "base", "nodes"])

    ddl = f"doc_id {kind}, digest bigint, base array<struct<kind:int,start:int,end:int>>, nodes array<struct<start:int,end:int,token:string,label:int,near:int>>"
    return docs.select(doc_id, text, F.xxhash64(text)).mapInArrow(of, ddl)


# learning


def _majority(labels: Counter, own: int) -> int:
    """The most frequent label of a key's other nodes; unknown without others or where two are as frequent."""
    rest = labels.copy()
    rest[own] -= 1
    top = [x for x in rest.most_common(2) if x[1] > 0]
    return UNKNOWN if not top or (len(top) == 2 and top[0][1] == top[1][1]) else top[0][0]


def patterns(of_doc: list[dict]) -> Iterator[tuple[int, int]]:
    """Of each node with a known label its pattern and that label."""
    by_key: list[dict[str, Counter]] = [{}, {}]
    named = [keys(n["token"]) for n in of_doc]
    for n, pair in zip(of_doc, named):
        if n["label"] != UNKNOWN:
            for k in (0, 1):
                if pair[k] is not None:
                    by_key[k].setdefault(pair[k], Counter())[n["label"]] += 1
    for i, (n, pair) in enumerate(zip(of_doc, named)):
        if n["label"] == UNKNOWN:
            continue
        before = of_doc[i - 1]["label"] if n["near"] else UNKNOWN
        after = of_doc[i + 1]["label"] if i + 1 < len(of_doc) and of_doc[i + 1]["near"] else UNKNOWN
        skips = [_majority(by_key[k][pair[k]], n["label"]) if pair[k] is not None else UNKNOWN for k in (0, 1)]
        code = shape(n["token"])
        for x in (before, after, *skips):
            code = code * 6 + x
        yield code, n["label"]


def pattern_counts(table: DataFrame) -> list[tuple[int, int, int]]:
    """(pattern, label, times) over all documents; patterns are fewer than N_SHAPES * 6^4, and some hundreds in practice."""

    def of(batches):
        got: Counter = Counter()
        for batch in batches:
            for some in batch.column(0).to_pylist():
                got.update(patterns(some))
        if got:
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in got], pa.int64()), pa.array([y for _, y in got], pa.int32()), pa.array(got.values(), pa.int64())], names=["code", "label", "n"])

    rows = table.where(F.size("nodes") > 0).select("nodes").mapInArrow(of, "code bigint, label int, n bigint").groupBy("code", "label").agg(F.sum("n").alias("n")).collect()
    return sorted((r["code"], r["label"], r["n"]) for r in rows)


class Weights:
    """own: of each shape the labels' potentials; chain: of a label and the next; skip: of agreement with a key's label."""

    def __init__(self, own: np.ndarray, chain: np.ndarray, skip: np.ndarray):
        self.own, self.chain, self.skip = own, chain, skip


def _shape_features() -> np.ndarray:
    """Of each shape its features: length and marks together, length, marks, and four signs."""
    code = np.arange(N_SHAPES)
    both, signs = code // 16, code % 16
    size, marks = both // N_MARKS, both % N_MARKS
    hot = [np.eye(n)[x] for n, x in ((N_LENGTHS * N_MARKS, both), (N_LENGTHS, size), (N_MARKS, marks))]
    return np.hstack([*hot, *(((signs >> k) & 1)[:, None] for k in range(4)), np.ones((N_SHAPES, 1))])


def learn(counts: list[tuple[int, int, int]]) -> Weights:
    """Weights that make each node's label likeliest, given its neighbours' labels."""
    features, labels = _shape_features(), len(KINDS) + 1
    theta = [np.zeros((features.shape[1], labels)), np.zeros((labels, labels)), np.zeros(2)]
    if counts:
        code, y, n = (np.array(c) for c in zip(*counts))
        parts = []
        for _ in range(4):
            parts.append(code % 6)
            code = code // 6
        same, like, after, before = parts[1], parts[0], parts[2], parts[3]
        x, share = features[code], n / n.sum()
        onehot = np.vstack([np.eye(labels), np.zeros(labels)])
        p, q, skips = onehot[before], onehot[after], (onehot[same], onehot[like])
        moment, square = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
        for step in range(1, STEPS + 1):
            own, chain, skip = theta
            score = x @ own + p @ chain + q @ chain.T + skip[0] * skips[0] + skip[1] * skips[1]
            score = np.exp(score - score.max(1, keepdims=True))
            off = (score / score.sum(1, keepdims=True) - onehot[y]) * share[:, None]
            slopes = [x.T @ off, p.T @ off + off.T @ q, np.array([(off * s).sum() for s in skips])]
            for t, g, m, v in zip(theta, slopes, moment, square):
                g = g + PENALTY * t
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                t -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        theta[2] = np.maximum(theta[2], 0)
    return Weights(features @ theta[0], theta[1], theta[2])


# inference


def _norm(x: np.ndarray) -> np.ndarray:
    top = x.max(1, keepdims=True)
    return x - top - np.log(np.exp(x - top).sum(1, keepdims=True))


def _send(belief: np.ndarray, potential: np.ndarray) -> np.ndarray:
    """Messages over edges with a potential of (sender's label, receiver's label), in logarithms."""
    top = belief.max(1, keepdims=True)
    return _norm(np.log(np.exp(belief - top) @ np.exp(potential) + 1e-300) + top)


def beliefs(shapes: np.ndarray, held: np.ndarray, left: np.ndarray, links: list[tuple[np.ndarray, np.ndarray]], w: Weights) -> np.ndarray:
    """Probabilities of each node's labels: left are the nodes that the next follows; links (node, key) of both kinds.

    held is a node's label where it is known, else UNKNOWN.
    """
    n, labels = len(shapes), len(KINDS) + 1
    own = w.own[shapes].copy()
    known = held != UNKNOWN
    own[known] = -40.0
    own[known, held[known]] = 0.0
    right = left + 1
    forward, backward = np.zeros((len(left), labels)), np.zeros((len(left), labels))
    stars = []
    for k, (node, key) in enumerate(links):
        stars.append({"node": node, "key": key, "keys": int(key.max()) + 1 if len(key) else 0, "potential": np.eye(labels) * w.skip[k], "in": np.zeros((len(node), labels)), "out": np.zeros((len(node), labels))})

    def total() -> np.ndarray:
        b = own.copy()
        b[right] += forward  # a node has one node at most to each side
        b[left] += backward
        for s in stars:
            np.add.at(b, s["node"], s["out"])
        return b

    for _ in range(ROUNDS):
        b, change = total(), 0.0
        # forward messages leave out what came back over the same edge, and so on
        new = {"f": _send(b[left] - backward, w.chain), "b": _send(b[right] - forward, w.chain.T)}
        for s in stars:
            if not len(s["node"]):
                continue
            up = _send(b[s["node"]] - s["out"], s["potential"])
            hub = np.zeros((s["keys"], labels))
            np.add.at(hub, s["key"], up)
            down = _send(hub[s["key"]] - up, s["potential"])
            down = DAMPING * s["out"] + (1 - DAMPING) * down
            change = max(change, float(np.abs(down - s["out"]).max()))
            s["out"] = down
        for name, old in (("f", forward), ("b", backward)):
            if len(old):
                fresh = DAMPING * old + (1 - DAMPING) * new[name]
                change = max(change, float(np.abs(fresh - old).max()))
                old[:] = fresh
        if change < STILL:
            break
    return np.exp(_norm(total()))


def _trim(kind: int, start: int, token: str) -> tuple[int, int]:
    """A token's place without brackets that aren't a phone's."""
    if kind == 0:
        return start, start + len(token)
    a = re.search(r"[+(0-9]" if kind == 3 else r"[0-9]", token).start()
    b = max(i for i, c in enumerate(token) if c.isdigit()) + 1
    return start + a, start + b


def added_spans(of_doc: list[dict], probability: np.ndarray) -> list[tuple[int, int, int]]:
    """Spans of nodes that are surely of a kind and not under a base span; neighbours of one number are one span."""
    out: list[tuple[int, int, int, str]] = []
    last = -2
    for i, n in enumerate(of_doc):
        kind = int(probability[i].argmax())
        if n["label"] not in (NONE, UNKNOWN) or kind == NONE or probability[i, kind] < SURE:
            continue
        d = _DIGITS.sub("", n["token"])
        if kind != 1 and not d:
            continue
        a, b = _trim(kind - 1, n["start"], n["token"]) if d else (n["start"], n["end"])
        if kind in (3, 4) and out and last == i - 1 and n["near"] and out[-1][0] == kind - 1 and len(out[-1][3] + d) <= (19 if kind == 3 else 15):
            out[-1] = (kind - 1, out[-1][1], b, out[-1][3] + d)
        else:
            out.append((kind - 1, a, b, d))
        last = i
    return [(k, a, b) for k, a, b, d in out if (k == 0) or (k == 1 and d) or (k == 2 and 16 <= len(d) <= 19 and luhn(d)) or (k == 3 and 7 <= len(d) <= 15)]


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, digest, base, spans): a row for each row of docs; spans have (kind, start, end), base ones and added ones.

    kind is the place in KINDS; start and end count code points.
    """
    table = cut(node_table(docs, doc_id, text))
    w = learn(pattern_counts(table))
    span_type = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))

    def block(some: list[list[dict]]) -> list[list[tuple[int, int, int]]]:
        flat = [n for of_doc in some for n in of_doc]
        if not flat:
            return [[] for _ in some]
        near = np.array([n["near"] for n in flat])
        links: list[tuple[list, list]] = [([], []), ([], [])]
        numbers: dict = {}
        i = 0
        for d, of_doc in enumerate(some):
            for n in of_doc:
                for k, key in enumerate(keys(n["token"])):
                    if key is not None:
                        links[k][0].append(i)
                        links[k][1].append(numbers.setdefault((k, d, key), len(numbers)))
                i += 1
        held = np.array([n["label"] if n["label"] not in (NONE, UNKNOWN) else UNKNOWN for n in flat])
        got = beliefs(np.array([shape(n["token"]) for n in flat]), held, np.flatnonzero(near) - 1, [(np.array(a, np.int64), np.array(b, np.int64)) for a, b in links], w)
        ends = np.cumsum([len(x) for x in some])
        return [added_spans(x, got[e - len(x) : e]) for x, e in zip(some, ends)]

    def of(batches):
        for batch in batches:
            all_nodes, base = batch.column(3).to_pylist(), batch.column(2).to_pylist()
            spans: list = []
            a = size = 0
            for i, x in enumerate(all_nodes):
                size += len(x)
                if size >= AT_ONCE or i + 1 == len(all_nodes):
                    spans += block(all_nodes[a : i + 1])
                    a, size = i + 1, 0
            out = [[dict(zip(("kind", "start", "end"), s)) for s in sorted({(b["kind"], b["start"], b["end"]) for b in old} | set(new))] for old, new in zip(base, spans)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(out, span_type)], names=["doc_id", "digest", "base", "spans"])

    ddl = f"doc_id {table.schema['doc_id'].dataType.simpleString()}, digest bigint, base array<struct<kind:int,start:int,end:int>>, spans array<struct<kind:int,start:int,end:int>>"
    return table.mapInArrow(of, ddl)


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    names = F.array(*map(F.lit, KINDS))

    def line(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s.kind + 1), s.start, s.end)), ",")

    def count(kind: int):
        # Spark would take a second parameter of the lambda, with a default or without, for the place in the array
        return F.size(F.filter("base", lambda s: s.kind == kind)).cast("bigint")

    counts = (count(k).alias(f"n_{name}") for k, name in enumerate(KINDS))
    return find(docs).select("doc_id", *counts, F.sha2(line("base"), 256).alias("base_sha256"), line("spans").alias("spans"))
