"""op11, op12, op13: against SQL, brute force and plain patterns, on odd rows and on no rows."""

import collections
import hashlib
import itertools
import math
import re
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fathomline.llm import importance, lexical_bmw, queries, skip_chain_crf, sql

DATA = "/root/testdata/sf0.001"
LOWER = {i: i + 32 for i in range(65, 91)}


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, "quick brown FOX"), (2, "lorem"), (3, None), (4, ""), (5, "漢字 words"), (1, "lazy dog"), (1, "lazy dog"), (None, "one here"), (6, "zzz nothing of it")]
    return spark.createDataFrame(rows, "item_id long, text string").withColumns({c: F.lit("clash") for c in ("doc_id", "score", "rank", "term", "segment")})


@pytest.mark.parametrize("name", ["op11_block_max_wand", "op12_importance_resampling"])
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    want = con.sql(sql.ORACLE[name])
    columns = sorted(want.columns)
    got = queries.queries()[name](spark, DATA)
    assert sorted(got.columns) == columns
    rows = sorted((tuple(r[want.columns.index(c)] for c in columns) for r in want.fetchall()), key=repr)
    assert rows and rows == sorted((tuple(r[c] for c in columns) for r in got.collect()), key=repr)


# op11


def ranking(docs, items, top=10):
    """Every document scored for every item, in Python's whole numbers."""
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    held = [(i, collections.Counter(term.findall((t or "").translate(LOWER)))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, total = len(held), sum(c.total() for _, c in held)
    df = collections.Counter(t for _, c in held for t in c)
    of_item = collections.defaultdict(set)
    for i, t in items:
        of_item[i] |= set(term.findall((t or "").translate(LOWER)))
    out = []
    for item, terms in of_item.items():
        scored = []
        for i, c in held:
            m = 10 + (90 * c.total() * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, k + 1, None if none else i, -s) for k, (s, none, i) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("segment,block", [(64, 2), (4000, 4), (1 << 25, 64)])
def test_search_on_odd_rows(spark, odd_docs, no_docs, items, monkeypatch, segment, block):
    monkeypatch.setattr(lexical_bmw, "SEGMENT", segment)
    monkeypatch.setattr(lexical_bmw, "BLOCK", block)
    monkeypatch.setattr(lexical_bmw, "QUERIES", 2)
    got = sorted((tuple(r) for r in lexical_bmw.query(spark, odd_docs, items).collect()), key=repr)
    want = ranking([(r.doc_id, r.text) for r in odd_docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert got == want and {i for i, *_ in got} == {1, 2, 5, 6, None}
    assert lexical_bmw.query(spark, no_docs, items).count() == 0 == lexical_bmw.query(spark, odd_docs, items.limit(0)).count()


def test_a_whole_index_finds_the_same(spark, items):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    asked = lexical_bmw.item_terms(spark.read.parquet(f"{DATA}/benchmark.parquet"))
    one = lexical_bmw.search(lexical_bmw.index(docs), asked).orderBy("item_id", "rank").collect()
    assert one == lexical_bmw.query(spark, docs, spark.read.parquet(f"{DATA}/benchmark.parquet")).orderBy("item_id", "rank").collect()


def made(rng, n_docs, dfs):
    """Posting blocks of some terms over n_docs documents, as search() hands them on, and plain postings."""
    length = rng.integers(5, 400, n_docs)
    blocks, plain = [], []
    for df in dfs:
        d = np.sort(rng.choice(n_docs, df, replace=False))
        tf = np.minimum(rng.geometric(0.6, df), length[d])
        plain.append((d, tf))
        parts = [slice(a, a + lexical_bmw.BLOCK) for a in range(0, df, lexical_bmw.BLOCK)]
        kept = [lexical_bmw.competitive(tf[p], length[d[p]]) for p in parts]
        blocks.append(
            {
                "first": np.array([d[p][0] for p in parts]),
                "last": np.array([d[p][-1] for p in parts]),
                "n": np.array([len(d[p]) for p in parts]),
                "offset": np.cumsum([0] + [len(k) for k in kept[:-1]]),
                "tf": np.concatenate([tf[p][k] for p, k in zip(parts, kept)]),
                "length": np.concatenate([length[d[p]][k] for p, k in zip(parts, kept)]),
                "payload": [lexical_bmw.encode_block(d[p], tf[p], length[d[p]]) for p in parts],
            }
        )
    return length, blocks, plain


@pytest.mark.parametrize("seed", range(6))
def test_blocks_are_skipped_and_nothing_is_lost(seed):
    rng = np.random.default_rng(seed)
    n = 60_000
    dfs = [36_000, 21_000, 900, 120, 3] if seed % 2 else [45_000, 27_000, 60]
    length, blocks, plain = made(rng, n, dfs)
    weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) for df in dfs])
    docs, scores, opened = lexical_bmw.best(weights, blocks, 10, 1, n, int(length.sum()))
    full = np.zeros(n, np.int64)
    for w, (d, tf) in zip(weights, plain):
        full[d] += w * (10**9 * tf // (1000 * tf + 8 * (10 + 90 * length[d] * n // length.sum())))
    order = np.lexsort((np.arange(n), -full))[:10]
    assert docs.tolist() == order.tolist() and scores.tolist() == full[order].tolist()
    assert opened < 0.6 * sum(len(b["first"]) for b in blocks)


@given(st.lists(st.tuples(st.integers(0, 10**6), st.integers(1, 10**5), st.integers(1, 10**7)), min_size=1, max_size=70, unique_by=lambda x: x[0]))
@settings(max_examples=60, deadline=None)
def test_blocks_round_trip(postings):
    d, tf, length = (np.array(c, np.int64) for c in zip(*sorted(postings)))
    got = lexical_bmw.decode_block(int(d[0]), len(d), lexical_bmw.encode_block(d, tf, length))
    assert all((a == b).all() for a, b in zip(got, (d, tf, length)))
    best = lexical_bmw.competitive(tf, length)
    score = lambda t, n: 10**9 * t // (1000 * t + 8 * (10 + n))
    assert score(tf[best], length[best]).max() == score(tf, length).max()


# op12


def resampled(docs, target, longest=1):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def features(t):
        w = word.findall((t or "").translate(LOWER))
        return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % 10_000 for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    of_doc = [(i, *features(t)) for i, t in docs]
    s, t = collections.Counter(b for *_, f in of_doc for b in f), collections.Counter(b for x in target for b in features(x)[1])
    big_s, big_t = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000)))) for b in range(10_000)]
    rows = []
    for i, n, f in of_doc:
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        rows.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((-r[4], r[0] is not None, r[0] or 0) for r in rows if r[1] >= 20)
    drawn = fit[: 10 * len(fit) // 100]
    return rows, drawn


@pytest.mark.parametrize("longest", [1, 3])
def test_resampling_on_odd_rows(spark, odd_docs, no_docs, items, longest):
    # enough rows of 20 words that some are drawn, equal ones among them
    more = spark.range(40).select((F.col("id") % 25 + 100).alias("doc_id"), F.concat_ws(" ", F.expr("transform(sequence(0, 24), i -> concat('w', (i * id) % 17))"), F.lit("quick fox")).alias("text"))
    docs = odd_docs.unionByName(more, allowMissingColumns=True)
    rows, drawn = resampled([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in items.collect()], longest)
    got = importance.ranked(importance.weigh(docs, items, longest=longest)).collect()
    assert sorted([(r.doc_id, r.n_features, r.weight, r.score) for r in got], key=repr) == sorted([(i, n, w, s) for i, _, n, w, s in rows], key=repr)
    placed = sorted((r["rank"], -r.score, r.doc_id) for r in got if r["rank"] is not None)
    assert drawn and [(r, s, i) for r, s, i in placed] == [(k + 1, s, i) for k, (s, _, i) in enumerate(drawn)]
    assert importance.query(spark, no_docs, items).count() == 0
    assert importance.query(spark, docs, items.limit(0)).count() == docs.count()
    kept = importance.draw(docs, items, longest=longest)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for _, _, i in drawn}


def test_buckets_of_longer_runs(spark):
    words = "one two three two".split()
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    row = spark.createDataFrame([(words,)], "w array<string>").select(importance.run_buckets(F.col("w"), 3, 1000).alias("b")).first()
    assert row.b == [zlib.crc32(r.encode()) % 1000 for r in runs]


# op13

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
            fine = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 16 <= len(d) <= 19 and sum(x - 9 * (x > 9) for x in doubled) % 10 == 0,
                "phone": 8 <= len(d) <= 15,
            }[kind]
            if fine:
                out.append((k, *m.span()))
    return out


@given(st.text(alphabet="ab.-_%+@0123 459()é\n", max_size=80) | st.text(alphabet="0123456789 -", max_size=60) | st.text(alphabet="12.", max_size=40))
@settings(max_examples=1500, deadline=None)
def test_base_spans_are_those_of_the_plain_patterns(text):
    assert skip_chain_crf.base_spans(text)[0] == plain_spans(text)


def test_base_spans_of_long_texts_take_linear_time():
    for text in ("x" * 400_000, "1" * 400_000, "1." * 200_000, "+1" + " " * 200_000, "a@" * 100_000, "1 " * 200_000):
        skip_chain_crf.nodes(text)


def told(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: (r.text, r) for r in skip_chain_crf.query(spark, df).join(df.withColumnRenamed("text", "_t"), "doc_id").withColumnRenamed("_t", "text").collect()}


def cards(n):
    """Numbers of 16 digits that pass the check."""
    out = []
    for i in itertools.count(10**14 * 45 + 7):
        out += [f"{i}{c}" for c in "0123456789" if skip_chain_crf.luhn(f"{i}{c}")]
        if len(out) >= n:
            return out


def test_the_field_adds_what_patterns_miss(spark):
    numbers = cards(60)
    rows = [(i, f"pay with {c} or call +1 (2{i:02d}) 555-{i:04d} soon, mail a.{i}x@site.org from 10.0.{i}.7 at 9.5 on page {i}") for i, c in enumerate(numbers)]
    two = f"first {numbers[0]} {numbers[1]} end"
    rows += [
        (100, two),
        (101, f"see {numbers[2]} and again {numbers[2]} {numbers[3]} and 1234567890123456 1234567890123456"),
        (102, "ring +1 (222) 555-0199 now " + "word " * 3000 + " then (222) 555-0199 again"),
        (103, "no numbers here, chapter 3 of 4.5 pages in 2019"),
        (104, "the user a.7x wrote as a.7x@site.org today"),
    ]
    got = told(spark, rows)
    spans = {i: [(k, t[int(a) : int(b)]) for k, a, b in (s.split(":") for s in r.spans.split(",") if s)] for i, (t, r) in got.items()}
    assert spans[100] == [("card", numbers[0]), ("card", numbers[1])] and got[100][1].n_card == 0
    assert spans[101] == [("card", numbers[2])] * 2 + [("card", numbers[3])]
    # the form without its prefix is not found from so few documents, see the README; its full form is
    assert spans[102][0] == ("phone", "+1 (222) 555-0199")
    assert spans[103] == []
    for i, (t, r) in got.items():
        base = [":".join((skip_chain_crf.KINDS[k], str(a), str(b))) for k, a, b in plain_spans(t)]
        assert set(base) <= set(r.spans.split(",")) | {""} and r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        if i < 60:
            assert r.spans.split(",") == base


def test_counts_are_of_each_kind(spark):
    number = cards(1)[0]
    texts = ["a@b.c d@e.f x@y.z", "+49 30 1234567 and 1.2.3.4", "1.2.3.4 a@b.c 5.6.7.8", f"{number}, +49 30 1234567", "nothing"]
    got = told(spark, list(enumerate(texts)))
    for i, text in enumerate(texts):
        kinds = collections.Counter(k for k, _, _ in plain_spans(text))
        assert [got[i][1][f"n_{name}"] for name in skip_chain_crf.KINDS] == [kinds[k] for k in range(4)]


def test_messages_are_exact_on_a_tree():
    """Two nodes in a chain and two of one key: no loop, so the probabilities are those of the whole sum."""
    rng = np.random.default_rng(3)
    w = skip_chain_crf.Weights(rng.normal(size=(skip_chain_crf.N_SHAPES, 5)), rng.normal(size=(5, 5)), np.array([1.3, 0.4]))
    shapes = np.array([3, 90, 200])
    links = [(np.array([1, 2]), np.array([0, 0])), (np.zeros(0, np.int64), np.zeros(0, np.int64))]
    free = skip_chain_crf.UNKNOWN
    for held in ([free, free, free], [free, free, 3]):
        got = skip_chain_crf.beliefs(shapes, np.array(held), np.array([0]), links, w)
        want = np.zeros((3, 5))
        for a, b, c, h in itertools.product(range(5), repeat=4):
            if all(x in (free, y) for x, y in zip(held, (a, b, c))):
                p = math.exp(w.own[3, a] + w.own[90, b] + w.own[200, c] + w.chain[a, b] + 1.3 * (b == h) + 1.3 * (c == h))
                for node, y in enumerate((a, b, c)):
                    want[node, y] += p
        assert np.allclose(got, want / want.sum(1, keepdims=True), atol=2e-3)


def test_learning_follows_the_gradient_of_the_pseudo_likelihood(spark):
    """Weights fitted to counts predict the labels better than any small change of them."""
    rng = np.random.default_rng(1)
    counts = sorted({(int(s) * 1296 + int(c), int(y)): int(n) for s, c, y, n in zip(rng.integers(0, 300, 60), rng.integers(0, 1296, 60), rng.integers(0, 5, 60), rng.integers(1, 50, 60))}.items())
    counts = [(c, y, n) for (c, y), n in counts]
    w = skip_chain_crf.learn(counts)
    agree = collections.Counter()
    for c, y, n in counts:
        parts = [c // 6**k % 6 for k in range(4)]
        score = w.own[c // 1296] + (w.chain[parts[3]] if parts[3] < 5 else 0) + (w.chain[:, parts[2]] if parts[2] < 5 else 0)
        for k, part in ((0, parts[1]), (1, parts[0])):
            if part < 5:
                score = score + w.skip[k] * (np.arange(5) == part)
        agree[int(score.argmax()) == y] += n
    assert agree[True] > 0.7 * agree.total()


def test_personal_data_on_odd_rows(spark, odd_docs, no_docs):
    got = skip_chain_crf.query(spark, odd_docs).collect()
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(r.doc_id for r in odd_docs.select("doc_id").collect())
    assert all(r.spans == "" and r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in got)
    assert skip_chain_crf.query(spark, no_docs).count() == 0
