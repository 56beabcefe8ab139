"""op2, op6, op7, op8, op9: against brute force, on odd rows and on no rows."""

import collections
import hashlib
import math
import re
import struct
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fathomline.llm import bpe, brown_lm, queries, simhash_mih, token_counts, winnowing

DATA = "/root/testdata/sf0.001"
LOWER = {i: i + 32 for i in range(65, 91)}


@pytest.fixture(scope="module")
def tokenizer():
    import tiktoken

    path, pattern = bpe.production()
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})


# op2


def test_bpe_matches_the_library(spark, odd_docs, no_docs, tokenizer):
    for docs in (spark.read.parquet(f"{DATA}/documents.parquet"), odd_docs):
        texts = docs.select("doc_id", "text").collect()
        got = collections.Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.query(spark, docs).collect())
        want = collections.Counter()
        for r in texts:
            ids = tokenizer.encode_ordinary(r.text or "")
            want[(r.doc_id, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())] += 1
        assert got == want
    assert bpe.query(spark, no_docs).count() == 0


def test_bpe_round_trip_keeps_columns(spark, odd_docs):
    path, pattern = bpe.production()
    out = bpe.decode(bpe.encode(odd_docs, path, pattern), path, pattern)
    assert set(out.columns) == set(odd_docs.columns)
    assert all(r.decoded == (r.text or "").encode() for r in out.collect())


def test_bpe_folds_agree(spark, tokenizer):
    path, pattern = bpe.production()
    words = ["a", "hello", " world", "naïve", "漢字漢字", "aaaaaaaaaaaaaaaa", "x" * 40, "!?!?", " 12345", "ẞß"]
    got = bpe.encode_words(spark.createDataFrame([(w,) for w in words], "word string"), path).collect()
    assert all(list(r.ids) == tokenizer.encode_ordinary(r.word) for r in got)
    ranks = bpe.read_ranks(path)
    for w in ("ab" * 3000, "é" * 700, "$" * 999):
        pieces = [w.encode()[i : i + 1] for i in range(len(w.encode()))]
        assert bpe._fold_long(list(pieces), ranks) == tokenizer._encode_single_piece(w.encode())
        assert b"".join(bpe.codec(path, pattern).pieces[i] for i in bpe._fold_long(pieces, ranks)) == w.encode()


def test_bpe_ids_do_not_depend_on_the_cache(monkeypatch, tokenizer):
    path, pattern = bpe.production()
    monkeypatch.setattr(bpe, "CACHE", 2)
    codec = bpe.Codec(path, pattern)
    for text in ("a b c a b c", "one two three two one", "ẞß 漢字 漢字 a"):
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == tokenizer.encode_ordinary(text) and len(codec.seen) <= 2


# op7


def test_token_histogram(spark, odd_docs, no_docs, tokenizer):
    lengths = collections.Counter(len(tokenizer.encode_ordinary(r.text or "")) for r in odd_docs.select("text").collect())
    n, total = sum(lengths.values()), sum(k * v for k, v in lengths.items())
    rows = token_counts.query(spark, odd_docs).collect()
    assert {r.context_limit for r in rows} == set(lengths)
    for r in rows:
        fit = sum(v for k, v in lengths.items() if k <= r.context_limit)
        kept = sum(v * min(k, r.context_limit) for k, v in lengths.items())
        assert (r.docs, r.docs_fit, r.docs_over, r.tokens_total, r.tokens_kept, r.tokens_lost) == (lengths[r.context_limit], fit, n - fit, total, kept, total - kept)
        assert math.isclose(r.quantile, fit / n)
    table = spark.createDataFrame(list(lengths.items()), "length long, docs long")
    for r in token_counts.at_limits(table, [1, 16, 10**6]).collect():
        assert r.tokens_kept == sum(v * min(k, r.context_limit) for k, v in lengths.items())
    half = token_counts.quantiles(table, [0.5]).first().length
    assert sum(v for k, v in lengths.items() if k <= half) >= n / 2 > sum(v for k, v in lengths.items() if k < half)
    assert token_counts.query(spark, no_docs).count() == 0
    assert [tuple(r) for r in token_counts.limits(table, block=2).orderBy("context_limit").collect()] == [tuple(r) for r in token_counts.limits(table).orderBy("context_limit").collect()]


# op6


def _windows_hit(docs, items):
    find = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
    low = lambda t: find((t or "").translate(LOWER))
    windows = collections.defaultdict(set)
    for i, t in items:
        w = low(t)
        for k in range(max(len(w) - 9, 1) if w else 0):
            windows[tuple(w[k : k + 10])].add(str(i))
    out = []
    for i, t in docs:
        w, hit, found = low(t), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[x]
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return collections.Counter(out)


def test_winnowing_against_brute_force(spark, odd_docs, no_docs):
    draw = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(12)] + ["Ä", "b1"]
    text = lambda n: " ".join(draw.choice(vocabulary, n))
    items = [(i, text(int(draw.integers(0, 25)))) for i in range(30)] + [(30, None), (31, ""), (3, "w1 w2"), (32, "w1 w2"), (None, text(12)), (33, "brown fox jumps")]
    docs = [(i, text(int(draw.integers(0, 400)))) for i in range(60)]
    docs += [(100 + k, f"{text(5)} {t} {text(5)}") for k, (_, t) in enumerate(items) if t] + [(0, docs[0][1])] * 2 + [(None, None), (None, items[5][1])]
    items = [x for x in items if x[0] is not None] + [(40, items[4][1])]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert collections.Counter(map(tuple, winnowing.query(spark, frame, bench).collect())) == _windows_hit(docs, items)
    odd = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert collections.Counter(map(tuple, winnowing.query(spark, odd_docs, bench).collect())) == _windows_hit(odd, items)
    assert winnowing.query(spark, no_docs, bench).count() == 0
    assert winnowing.query(spark, odd_docs, bench.limit(0)).where("contaminated").count() == 0
    kept = winnowing.keep_clean(odd_docs, bench)
    assert kept.columns == odd_docs.columns and kept.count() == sum(v for k, v in _windows_hit(odd, items).items() if not k[5])


def test_extension_reaches_both_ends():
    doc, item = list("abcdefghijklmnop"), list("xxcdefghijklmnxx")
    assert winnowing.extend(doc, 5, item, 5, 0) == (-3, 12)
    assert winnowing.extend(doc[:9], 5, item[:9], 5, 0) is None
    assert winnowing.extend(["a", "b"], 0, ["a", "b"], 0, 2) == (0, 2)


# op9


def _fingerprint(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if x]
    shingles = [" ".join(w[i : i + 4]) for i in range(max(len(w) - 3, 1))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def _components(prints):
    distinct = sorted(set(prints))
    root = dict(zip(distinct, distinct))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if bin(a ^ b).count("1") <= 4:
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {p: top(p) for p in distinct}


@pytest.mark.parametrize("heavy", [0, 2, 2000])
def test_links_find_all_components(spark, heavy):
    draw = np.random.default_rng(2)
    values = set(int(x) for x in draw.integers(0, 2**63, 60))
    for base in list(values)[:6]:  # chains and dense groups
        v = base
        for _ in range(12):
            v ^= sum(1 << int(b) for b in draw.choice(64, 4, replace=False))
            values |= {v, base ^ sum(1 << int(b) for b in draw.choice(64, 3, replace=False))}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    roots = _components(values)
    groups = collections.defaultdict(set)
    for v, r in roots.items():
        groups[r].add(signed(v))
    nodes = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    for plan in (p for _, p in simhash_mih.PLANS):
        got = simhash_mih.components(simhash_mih.cut(simhash_mih.links(nodes, heavy, plan))).collect()
        found = collections.defaultdict(set)
        for r in got:
            found[r.root].add(r.node)
        assert sorted(map(sorted, found.values())) == sorted(sorted(g) for g in groups.values() if len(g) > 1)


def test_simhash_query(spark, odd_docs, no_docs):
    for docs in (odd_docs, spark.read.parquet(f"{DATA}/documents.parquet")):
        rows = docs.select("doc_id", "text").collect()
        prints = [_fingerprint(r.text) for r in rows]
        roots, least = _components(prints), {}
        for r, p in zip(rows, prints):
            if r.doc_id is not None:
                least[roots[p]] = min(least.get(roots[p], r.doc_id), r.doc_id)
        want = collections.Counter((r.doc_id, f"{p:016x}", least.get(roots[p])) for r, p in zip(rows, prints))
        assert collections.Counter(map(tuple, simhash_mih.query(spark, docs).collect())) == want
        kept = simhash_mih.keep_one(docs)
        assert kept.columns == docs.columns and kept.count() == len(set(roots.values()))
    assert simhash_mih.query(spark, no_docs).count() == simhash_mih.keep_one(no_docs).count() == 0


# op8


def test_language_model(spark, odd_docs, no_docs):
    tokens = lambda t: [w for w in re.split(r"[\x20\x09-\x0D]+", (t or "").translate(LOWER)) if w] + ["\n"]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    for docs in (spark.read.parquet(f"{DATA}/documents.parquet"), odd_docs):
        rows = docs.select("doc_id", "text").collect()
        c = collections.Counter(w for r in rows if not held(r.doc_id) for w in tokens(r.text))
        n, v = sum(c.values()), len(c)
        want = collections.Counter()
        for r in rows:
            w = tokens(r.text)
            want[(r.doc_id, held(r.doc_id), len(w), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 4))] += 1
        got = brown_lm.query(spark, docs).collect()
        assert collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
        assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert brown_lm.query(spark, no_docs).count() == 0


def test_language_model_beats_single_words(spark):
    got = queries.op8_brown_class_lm(spark, DATA).where("held_out").toPandas()
    assert got.score.sum() > got.base_score.sum()


def test_small_table_gives_the_same_counts(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model, counts = brown_lm.train(docs)
    small, counts2 = brown_lm.train(docs, common=2000)
    key = lambda m, c: {(r.doc_id, r.n_known, round(r.base_score, 5)) for r in brown_lm.score(docs, m, c).collect()}
    assert key(model, counts) == key(small, counts2)


@pytest.mark.parametrize("given", [{}, {"common": 300, "clustered": 50, "classes": 7, "assigned": 3}])
def test_scores_against_counts_one_by_one(spark, odd_docs, given):
    """Scores from the classes of words alone: bigrams of classes and counts of words counted text by text."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").unionByName(odd_docs.select(F.col("doc_id") + 10**6, "text").toDF("doc_id", "text"))
    train = docs.where("doc_id % 3 <> 0 AND doc_id <> 1000009")
    model, counts = brown_lm.train(train, **given)
    table = model.table
    place = {w: i for i, w in enumerate(table.words)}

    def class_of(word):
        i = place.get(word)
        return int(model.of[i if i is not None else len(place) + table.shapes.get(brown_lm.shape(word), len(table.shapes))])

    split = lambda t: [w.encode() for w in re.split(r"[\x20\x09-\x0D]+", (t or "").translate(LOWER)) if w]
    words, pairs, mass = collections.Counter(), collections.Counter(), collections.Counter()
    for r in train.collect():
        found = split(r.text)
        words.update(found)
        classes = [0, *map(class_of, found), 1]
        pairs.update(zip(classes, classes[1:]))
    n = len(model.move)
    for w, c in words.items():
        mass[class_of(w)] += c + brown_lm.ADD
    for s in range(len(table.shapes) + 1):
        mass[int(model.of[len(place) + s])] += brown_lm.ADD
    follow = collections.Counter()
    for (a, _), c in pairs.items():
        follow[a] += c

    def score(text):
        found = split(text)
        classes = [0, *map(class_of, found), 1]
        moved = sum(math.log10((pairs[p] + brown_lm.ADD_CLASS) / (follow[p[0]] + brown_lm.ADD_CLASS * (n - 1))) for p in zip(classes, classes[1:]))
        return moved + sum(math.log10((words[w] + brown_lm.ADD) / mass[c]) for w, c in zip(found, classes[1:]))

    got = brown_lm.score(docs, model, counts).collect()
    want = collections.Counter((r.doc_id, round(score(r.text), 3)) for r in docs.collect())
    assert collections.Counter((r.doc_id, round(r.score, 3)) for r in got) == want
    assert np.allclose((10 ** model.move[:, 1:]).sum(1), 1)


def test_words_are_assigned_to_the_class_of_their_neighbours(spark):
    draw = np.random.default_rng(0)
    kinds = [[f"{k}{i}z" for i in range(12)] for k in "abc"]
    text = lambda: " ".join(kinds[j % 3][min(int(draw.geometric(0.25)) - 1, 11)] for j in range(60))
    docs = spark.createDataFrame([(i, text()) for i in range(200)], "doc_id long, text string")
    model, _ = brown_lm.train(docs, clustered=9, classes=4, assigned=1)
    found = {w.decode(): int(model.of[i]) for i, w in enumerate(model.table.words)}
    assert all(len({found[w] for w in k if w in found}) == 1 for k in kinds) and len({found[k[0]] for k in kinds}) == 3


def test_exchange_leaves_no_better_single_move():
    def likelihood(m, of, k):
        one = np.zeros((len(m), k))
        one[np.arange(len(m)), of] = 1
        n = one.T @ m @ one
        f = lambda x: (x * np.log(np.maximum(x, 1e-12))).sum()
        return f(n) - f(n.sum(1)) - f(n.sum(0))

    for seed in range(4):
        draw = np.random.default_rng(seed)
        m = draw.poisson(3, (16, 16)) * (draw.random((16, 16)) < 0.4).astype(float)
        of = brown_lm.exchange(m, 4, 2, rounds=60)
        best = likelihood(m, of, 6)
        for w in range(2, 16):
            for c in range(2, 6):
                other = of.copy()
                other[w] = c
                assert likelihood(m, other, 6) <= best + 1e-6
