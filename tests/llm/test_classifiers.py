"""op1 and op5: held-out accuracy, odd rows, no rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathomline.llm import quality_bt, queries, toxicity_gru
from fathomline.llm.common import labelled_sample

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 0, 1), (6, 1, 1), (None, 0, 0), (8, 0, 0), (9, None, None)], "doc_id long, quality int, toxic int")


def test_quality_held_out(spark):
    got = queries.op1_quality_bradley_terry(spark, DATA)
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = got.join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id").toPandas()
    assert got.count() == 1000 and rows.score.between(0, 1).all()
    assert ((rows.score >= 0.5) == (rows.predicted == 1)).all()
    held = rows[rows.held_out]
    assert (held.predicted == held.quality).mean() > 0.95


def test_toxicity_held_out(spark):
    got = queries.op5_toxicity_gru(spark, DATA)
    rows = got.join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id").toPandas()
    assert got.count() == 1000 and rows.score.between(0, 1).all()
    assert ((rows.score >= 0.3) == (rows.predicted == 1)).all()
    held = rows[rows.held_out]
    assert (held.predicted == held.toxic).mean() > 0.9


def test_sample_keeps_held_out_rows_away(spark, odd_docs, labels):
    got = {(r.doc_id, r.label) for r in labelled_sample(odd_docs, labels, "quality", 3, 1, 10).collect()}
    import zlib

    assert got and all(zlib.crc32(str(i).encode()) % 3 != 1 for i, _ in got)
    assert len({i for i, _ in got}) == len(got)


def test_odd_rows(spark, odd_docs, no_docs, labels):
    model = quality_bt.train(odd_docs, labels)
    net = toxicity_gru.train(odd_docs, labels)
    for scored in (quality_bt.score_quality(odd_docs, model), toxicity_gru.score_toxicity(odd_docs, net)):
        rows = scored.collect()
        assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
        same = {r.score for r in rows if r.text is not None and r.text.startswith("the quick")}
        assert len(same) == 1
        assert len({r.score for r in rows if not r.text}) == 1  # null and empty alike
    assert quality_bt.score_quality(no_docs, model).count() == toxicity_gru.score_toxicity(no_docs, net).count() == 0
    assert quality_bt.keep_quality(odd_docs, model).columns == odd_docs.columns


def test_without_training_rows(spark, odd_docs, no_docs, labels):
    assert quality_bt.query(spark, odd_docs, labels.limit(0)).where("score BETWEEN 0 AND 1").count() == odd_docs.count()
    assert toxicity_gru.query(spark, odd_docs, labels.limit(0)).where("predicted = 0").count() == odd_docs.count()
    assert toxicity_gru.query(spark, no_docs, labels).count() == quality_bt.query(spark, no_docs, labels).count() == 0


def test_ranking_is_learnt_from_pairs():
    draw = np.random.default_rng(0)
    x = draw.standard_normal((400, 5))
    y = (x @ [1, -2, 0, 0, 0.5] > 0).astype(int)
    model = quality_bt.fit(x, y)
    assert ((model.score(x) >= 0.5) == y).mean() > 0.95
    assert np.argmax(np.abs(model.weights)) == 1


def test_windows_cover_every_word():
    for n in (0, 1, 47, 48, 49, 72, 73, 500):
        first = toxicity_gru.windows(n)
        assert set().union(*(range(a, min(a + toxicity_gru.WINDOW, n)) for a in first)) == set(range(n)) and (np.diff(first) == toxicity_gru.HOP).all()


def test_blocks_have_the_windows_of_the_text(monkeypatch):
    monkeypatch.setattr(toxicity_gru, "BLOCK", 96)
    scorer = toxicity_gru.Scorer(toxicity_gru.Network.start())
    for n in (0, 1, 48, 49, 95, 96, 97, 143, 144, 145, 168, 169, 240, 241, 500):
        words = [f"w{i}" for i in range(n)]
        whole = [tuple(words[a : a + toxicity_gru.WINDOW]) for a in toxicity_gru.windows(n)]
        parts = [tuple(b[a : a + toxicity_gru.WINDOW]) for b in scorer._blocks(" ".join(words)) for a in toxicity_gru.windows(len(b))]
        assert parts == whole


def _inputs_one_by_one(net, word):
    """The input of a word by the definition of its hashes."""
    raw, mask = b"\x02" + word.encode() + b"\x03", (1 << 64) - 1
    mix = int(toxicity_gru._MIX)
    total = 0
    for i, c in enumerate(raw):
        x = (c + 1) * (i + 1) ** 3 * mix & mask
        total = (total + (x ^ x >> 29)) & mask
    rows = []
    for n in toxicity_gru.SPANS:
        for i in range(len(raw) - n + 1):
            x = 0
            for c in raw[i : i + n]:
                x = (x * 257 + c) & mask
            rows.append(((x * mix & mask) >> 40) % toxicity_gru.GRAMS)
    return net.p["word"][((total * mix & mask) >> 35) % toxicity_gru.WORDS] + net.p["gram"][rows].mean(0)


def _score_one_by_one(net, text):
    """The score of a text by the definition of the network, one window and one word at a time."""
    words, h, best = list(toxicity_gru.words_of(text)), toxicity_gru.STATES, -np.inf
    sigmoid = lambda v: 1 / (1 + np.exp(-v))
    starts = [0] if len(words) <= 48 else [a for a in range(0, len(words), 24) if a == 0 or a + 24 < len(words)]
    for a in starts:
        x = [_inputs_one_by_one(net, w) for w in words[a : a + 48]]
        states = [[None, None] for _ in x]
        for d, order in ((0, range(len(x))), (1, range(len(x) - 1, -1, -1))):
            s = np.zeros(h)
            for i in order:
                g = (x[i] @ net.p["wx"] + net.p["b"])[3 * h * d : 3 * h * (d + 1)]
                r = s @ net.p["u"][d]
                z, reset = sigmoid(g[:h] + r[:h]), sigmoid(g[h : 2 * h] + r[h : 2 * h])
                s = (1 - z) * s + z * np.tanh(g[2 * h :] + reset * r[2 * h :])
                states[i][d] = s
        s = np.array([np.concatenate(p) for p in states]).reshape(-1, 2 * h)
        weight = np.exp(np.tanh(s @ net.p["a"]) @ net.p["v"])
        pooled = (weight[:, None] * s).sum(0) / weight.sum() if len(s) else np.zeros(2 * h)
        best = max(best, float(pooled @ net.p["o"] + net.p["c"][0]))
    return sigmoid(best * net.slope + net.offset)


def test_scores_against_the_definition(monkeypatch):
    net = toxicity_gru.fit(["you utter fool " + "day " * k for k in range(40)] + ["good day " * k for k in range(40)], [1] * 40 + [0] * 40)
    texts = ["", None, "fool", "good " * 47 + "fool " * 30, " ".join(f"w{i}" for i in range(200)), "Ünïcode 漢字 " * 9, "x" * 300 + " good " + "fool" * 90]
    want = [_score_one_by_one(net, t) for t in texts]
    assert np.allclose(toxicity_gru.Scorer(net)(texts), want, atol=2e-4)
    monkeypatch.setattr(toxicity_gru, "SOME", 64)  # words in several parts
    monkeypatch.setattr(toxicity_gru, "BLOCK", 48)
    assert np.allclose(toxicity_gru.Scorer(net)(texts), want, atol=2e-4)


def test_the_scorer_stays_in_the_process():
    from pyspark import cloudpickle

    net = toxicity_gru.Network.start()

    def of(texts):
        return toxicity_gru.scorer(net)

    kept = toxicity_gru.scorer(net)
    assert cloudpickle.loads(cloudpickle.dumps(of)).__globals__["toxicity_gru"] is toxicity_gru and toxicity_gru.scorer(net) is kept


def test_gradients_agree_with_differences():
    net = toxicity_gru.Network.start()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items() if k not in ("word", "gram")}
    draw = np.random.default_rng(1)
    x, mask = draw.standard_normal((6, 3, toxicity_gru.WIDTH)), np.arange(6)[:, None] < np.array([6, 3, 1])
    want, weight = np.array([1.0, 0, 1]), np.ones(3)

    def loss():
        z = net.run(x @ net.p["wx"] + net.p["b"], mask).astype(float)
        return float(np.mean(np.log1p(np.exp(-np.where(want == 1, z, -z)))))

    grads, _, _ = net.learn(x, mask, want, weight)
    for name, g in grads.items():
        at = tuple(draw.integers(0, s) for s in net.p[name].shape)
        old = net.p[name][at]
        net.p[name][at] = old + 1e-3
        up = loss()
        net.p[name][at] = old - 1e-3
        down = loss()
        net.p[name][at] = old
        assert abs((up - down) / 2e-3 - g[at]) < 2e-3, name


def test_scores_do_not_depend_on_the_cache(monkeypatch):
    net = toxicity_gru.fit(["you fool", "good day to you", "fool fool", "nice and calm"] * 20, [1, 0, 1, 0] * 20)
    texts = [f"word{i} fool day {i}" for i in range(50)]
    whole = toxicity_gru.Scorer(net)(texts)
    monkeypatch.setattr(toxicity_gru, "CACHE", 3)
    one = toxicity_gru.Scorer(net)
    assert np.allclose(whole, np.concatenate([one([t]) for t in texts]), atol=1e-6)
    assert F is not None
