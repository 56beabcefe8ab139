"""op3, op4, op10 and the pipeline."""

import collections
import json

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import corpus_pipeline
from fathomline.llm import html_ttr, nn_descent, queries, tool_calls

DATA = "/root/testdata/sf0.001"

# op3


def chat(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_tool_calls_in_json(spark):
    call = lambda *calls: json.dumps({"tool_calls": [{"id": i, "name": n, "arguments": a} for i, n, a in calls]})
    result = lambda i, c: json.dumps({"tool_call_id": i, "content": c})
    schemas = {"add": {"a": ("integer", True), "b": ("number", False)}, "say": {"text": ("string", True)}}
    rows = [
        (1, 0, "assistant", call(("c1", "add", {"b": 2.5, "a": 1}), ("c2", "say", {"text": "é\"x"}), ("c3", "add", {"a": "no"}))),
        (1, 1, "tool", result("c2", "said")),
        (1, 2, "tool", result("c1", "3")),
        (1, 2, "tool", result("c1", "3")),
        (1, 3, "tool", result("c1", "4")),
        (1, 4, "assistant", call(("c4", "say", {"text": {"$ref": "c1"}}), ("c5", "unknown", {}), ("c6", "say", {"text": "x", "after": {"$ref": "c7"}}))),
        (1, 5, "assistant", call(("c7", "say", {"text": "later", "after": {"$ref": "c4"}}))),
        (1, 5, "assistant", call(("x1", "say", {"text": "1", "after": {"$ref": "x2"}}), ("x2", "say", {"text": "2", "after": {"$ref": "x1"}}), ("x3", "say", {"text": "3", "after": {"$ref": "nowhere"}}))),
        (1, 6, "tool", result("none", "lost")),
        (1, 7, "tool", "{not json"),
        (2, 0, "user", None),
        (2, 1, "assistant", "hello"),
        (None, 0, "user", "x"),
        (3, None, "user", "x"),
    ]
    links = tool_calls.link(chat(spark, rows), schemas | tool_calls.SCHEMAS).collect()
    got = {(r.conv_id, r.call_id): r for r in links if (r.conv_id, r.call_id, r.name) != (1, "c1", None)}
    (again,) = (r for r in links if (r.conv_id, r.call_id, r.name) == (1, "c1", None))
    assert (again.turn, again.n_results, json.loads(again.line)) == (3, 2, {"id": "c1", "result": "4", "valid": False})
    c1, c2 = got[1, "c1"], got[1, "c2"]
    assert (c1.valid, c1.n_results, c1.result_turn, c1.place) == (True, 2, 2, 1)
    assert json.loads(c1.line) == {"arguments": '{"a":1,"b":2.5}', "id": "c1", "name": "add", "result": "3", "valid": True}
    assert list(json.loads(c1.line)) == sorted(json.loads(c1.line)) and ": " not in c1.line
    assert json.loads(json.loads(c2.line)["arguments"]) == {"text": 'é"x'}
    assert not got[1, "c3"].valid and got[1, "c3"].n_results == 0
    assert got[1, "c4"].ordered and not got[1, "c4"].valid  # the reference is an object, not a string
    assert not got[1, "c5"].valid
    assert [got[1, c].level for c in ("c1", "c4", "c7", "c6", "x1", "x2", "x3")] == [0, 1, 2, 3, -1, -1, -1]
    assert got[1, "c6"].ordered and got[1, "c4"].place < got[1, "c7"].place < got[1, "c6"].place < min(got[1, x].place for x in ("x1", "x2", "x3"))
    assert not any(got[1, x].ordered for x in ("x1", "x2", "x3"))
    assert got[1, "none"].name is None and json.loads(got[1, "none"].line)["result"] == "lost"
    assert json.loads(got[2, "turn:0"].line)["result"] == "hello"
    assert {k[0] for k in got} == {1, 2}
    places = [r.place for k, r in got.items() if k[0] == 1]
    assert sorted([*places, again.place]) == list(range(1, len(places) + 2))


def test_the_result_of_a_call_is_not_older_than_it(spark):
    call, result = json.dumps({"tool_calls": [{"id": "c", "name": "say", "arguments": {}}]}), lambda x: json.dumps({"tool_call_id": "c", "content": x})
    told = lambda *rows: sorted((r.turn, r.name, r.n_results, r.ordered, json.loads(r.line).get("result")) for r in tool_calls.link(chat(spark, [(1, t, "x", m) for t, m in rows])).fillna("", ["name"]).collect())
    assert told((0, result("old")), (1, call), (2, result("a")), (3, result("b"))) == [(0, "", 3, True, "old"), (1, "say", 3, True, "a"), (3, "", 3, True, "b")]
    assert told((0, result("old")), (1, result("older")), (2, call)) == [(0, "", 2, True, "old"), (2, "say", 2, False, "older")]


def brute_links(rows, schemas):
    """Links of messages by the definition: (conv, turn, seq, id, name, level, ordered, results, result turn, valid, line)."""
    kinds = {"integer": lambda v: isinstance(v, int) and not isinstance(v, bool), "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool), "string": lambda v: isinstance(v, str)}
    out = collections.Counter()
    for conv in {r[0] for r in rows}:
        calls, results = [], collections.defaultdict(set)
        for c, turn, _, text in set(rows):
            if c == conv:
                got = json.loads(text)
                calls += [(turn, k, x["id"], x["name"], x["arguments"]) for k, x in enumerate(got.get("tool_calls", []))]
                if "tool_call_id" in got:
                    results[got["tool_call_id"]].add((turn, got["content"]))
        ids = {x[2] for x in calls}
        refs = lambda v: {v["$ref"]} if isinstance(v, dict) and "$ref" in v else set().union(*map(refs, v.values())) if isinstance(v, dict) else set()
        first = {i: min(x[0] for x in calls if x[2] == i) for i in ids}

        def ranked(id_):
            """Results in the order in which they are preferred."""
            had = sorted(results.get(id_, ()))
            return [r for r in had if r[0] >= first.get(id_, 0)] + [r for r in had if r[0] < first.get(id_, 0)][::-1]

        level = {i: None for i in range(len(calls))}
        for _ in range(len(calls) + 1):
            for i, x in enumerate(calls):
                need = refs(x[4])
                if level[i] is None and need <= ids:
                    below = [level[j] for j, y in enumerate(calls) if y[2] in need]
                    if None not in below:
                        level[i] = 1 + max(below) if need else 0
        for i, (turn, k, id_, name, arguments) in enumerate(calls):
            had = ranked(id_)
            valid = name in schemas and all((p in arguments and kinds[t](arguments[p])) if need else p not in arguments or kinds[t](arguments[p]) for p, (t, need) in schemas[name].items())
            line = {"arguments": json.dumps(arguments, sort_keys=True, separators=(",", ":")), "id": id_, "name": name, "valid": valid} | ({"result": had[0][1]} if had else {})
            lv = -1 if level[i] is None else level[i]
            out[(conv, turn, k, id_, name, lv, lv >= 0 and not (had and had[0][0] < turn), len(had), had[0][0] if had else None, valid, json.dumps(line, sort_keys=True, separators=(",", ":")))] += 1
        for id_ in results:
            for turn, content in ranked(id_)[1 if id_ in ids else 0 :]:
                out[(conv, turn, -1, id_, None, 0, True, len(results[id_]), turn, False, json.dumps({"id": id_, "result": content, "valid": False}, sort_keys=True, separators=(",", ":")))] += 1
    return out


@pytest.mark.parametrize("seed", range(3))
def test_generated_calls_against_a_plain_linker(spark, seed):
    """Chains, cycles, missing and clashing identifiers, several results, one very long text and a turn of many calls."""
    draw = np.random.default_rng(seed)
    schemas = {"add": {"a": ("integer", True), "b": ("number", False)}, "say": {"text": ("string", True)}}
    rows = []
    for conv in range(25):
        pool = [f"c{i}" for i in range(int(draw.integers(2, 9)))]
        for turn in range(int(draw.integers(1, 14))):
            if draw.random() < 0.45:
                rows.append((conv, turn, "tool", json.dumps({"tool_call_id": str(draw.choice(pool)), "content": f"r{draw.integers(0, 3)}"})))
                continue
            calls = []
            for _ in range(int(draw.integers(1, 40 if conv == 0 else 4))):
                name = str(draw.choice(["add", "say", "other"]))
                arguments = {"a": [1, -7, "no"][draw.integers(0, 3)], "text": "t" * (60_000 if conv == 1 and turn == 0 else 3)}
                if draw.random() < 0.5:
                    arguments["b"] = [0.5, 2, "x"][draw.integers(0, 3)]
                if draw.random() < 0.4:
                    arguments["use"] = {"$ref": str(draw.choice([*pool, "gone"] if draw.random() < 0.2 else pool))}
                calls.append({"id": str(draw.choice(pool)), "name": name, "arguments": arguments})
            rows.append((conv, turn, "assistant", json.dumps({"tool_calls": calls})))
    rows += rows[:7]
    got = tool_calls.link(chat(spark, rows), schemas).collect()
    found = collections.Counter((r.conv_id, r.turn, r.seq, r.call_id, r.name, r.level, r.ordered, r.n_results, r.result_turn, r.valid, json.dumps(json.loads(r.line), sort_keys=True, separators=(",", ":"))) for r in got)
    assert found == brute_links(rows, schemas)
    for conv in range(25):
        order = [(r.level < 0, r.level, r.turn, r.seq) for r in sorted((r for r in got if r.conv_id == conv), key=lambda r: r.place)]
        assert order == sorted(order) and sorted(r.place for r in got if r.conv_id == conv) == list(range(1, len(order) + 1))


def test_places_do_not_depend_on_blocks(spark, monkeypatch):
    rows = chat(spark, [(c, t, "user" if t % 2 == 0 else "assistant", f"t{t}") for c in (1, 2) for t in range(40)])
    key = lambda: sorted((r.conv_id, r.place, r.call_id) for r in tool_calls.link(rows).collect())
    whole = key()
    monkeypatch.setattr(tool_calls, "BLOCK", 3)
    assert key() == whole and [p for c, p, _ in whole if c == 1] == list(range(1, 21))
    assert tool_calls.link(rows.limit(0)).count() == 0


def test_extra_columns_are_ignored(spark):
    rows = chat(spark, [(1, 0, "user", "a"), (1, 1, "assistant", "b")]).withColumns({c: F.lit(1) for c in ("line", "place", "call_id", "valid", "name")})
    assert tool_calls.link(rows).count() == 1


# op4


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def brute(rows, queries_, k=10):
    good = {}
    for i, v, *_ in rows:
        if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            v = [float(np.float32(x)) for x in v]
            good[i] = min(good.get(i, v), v)
    out = {}
    for q in queries_:
        if q in good:
            d = sorted((float(np.sqrt(sum((a - b) ** 2 for a, b in zip(good[q], v)))), i) for i, v in good.items() if i != q and len(v) == len(good[q]))[:k]
            out[q] = [(i, s) for s, i in d]
    return out


def test_nearest_of_odd_vectors(spark):
    draw = np.random.default_rng(0)
    rows = [(i, draw.standard_normal(3).tolist(), 0) for i in range(300)]
    rows += [(1000 + i, [1.0, 2.0, 3.0], 1) for i in range(40)]  # many equal ones
    rows += [(2000, None, 0), (2001, [0.0, 0.0, 0.0], 0), (2002, [float("nan"), 1.0, 1.0], 0), (2003, [None, 1.0, 1.0], 0), (2004, [float("inf"), 1.0, 1.0], 0), (2005, [1.0, 2.0], 0), (3000, [1.0, 2.5], 0), (3100, [7.0], 0), (2007, [0.0, 2.0], 0), (None, [1.0, 1.0, 1.0], 0), (2006, [], 0)]
    rows += [rows[5], (7, [9.0, 9.0, 9.0], 0)]
    got = collections.defaultdict(list)
    for r in sorted(nn_descent.nearest(vectors(spark, rows).withColumns({"score": F.lit(1), "rank": F.lit(2), "node": F.lit(3)}), F.col("vec_id") % 100 == 0).collect(), key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((r.vec_id, r.score))
    want = {q: w for q, w in brute(rows, range(0, 3200, 100)).items() if w}
    assert set(got) == set(want) and 3000 in want and 3100 not in want
    for q, found in want.items():
        assert [i for i, _ in got[q]] == [i for i, _ in found]
        assert np.allclose([s for _, s in got[q]], [s for _, s in found], atol=1e-12)


def test_nearest_of_few_or_none(spark):
    rows = [(0, [1.0, 0.0, 0.0], 0), (1, [0.0, 1.0, 0.0], 0), (100, [0.0, 1.0, 0.0], 0)]
    got = {(r.query_id, r["rank"]): r.vec_id for r in nn_descent.query(spark, vectors(spark, rows)).collect()}
    assert got == {(0, 1): 1, (0, 2): 100, (100, 1): 1, (100, 2): 0}
    assert nn_descent.query(spark, vectors(spark, rows[:1])).count() == 0
    assert nn_descent.query(spark, vectors(spark, rows[:0])).count() == 0


def recall_of(got, x, asked, k=10):
    hits = 0
    for i in asked:
        d = ((x - x[i]) ** 2).sum(1)
        d[i] = np.inf
        hits += len(got[i] & set(np.argpartition(d, k)[:k].tolist()))
    return hits / (k * len(asked))


def found_by(df):
    got = collections.defaultdict(set)
    for a, b in df.collect():
        got[a].add(b)
    return got


def test_recall(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").toPandas()
    assert rows.vec_id.tolist() == list(range(len(rows)))
    x = np.array(rows.embedding.tolist(), float)
    got = found_by(queries.op4_nearest_nn_descent(spark, "/root/testdata/sf0.1").select("query_id", "vec_id"))
    assert recall_of(got, x, range(0, len(x), 100)) >= 0.9


def made(spark, n, width, path):
    """Uniform vectors, the hardest case, as a table of some partitions."""
    x = np.random.default_rng(n).standard_normal((n, width)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    import pyarrow as pa
    import pyarrow.parquet as pq

    flat = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(x.ravel()))
    pq.write_table(pa.table({"vec_id": np.arange(n), "embedding": flat}), path, row_group_size=n // 8)
    return x.astype(float), spark.read.parquet(str(path)).repartition(8)


@pytest.mark.parametrize("n, width", [(10_000, 24), (50_000, 16)])
def test_descent_and_search_have_to_work(spark, tmp_path, n, width):
    """Leaves hold a few hundredths of the nodes, so most neighbours come from the descent and the search."""
    x, rows = made(spark, n, width, tmp_path / "v.parquet")
    asked = range(0, n, 500)
    leaf = {"trees": 3, "leaf": 256}
    vectors = nn_descent.cut(nn_descent.nodes(nn_descent.taking_part(rows, "vec_id", "embedding"), 11))
    first = found_by(nn_descent.keep_nearest(nn_descent.first_graph(vectors, n, 24, **leaf).withColumn("new", F.lit(True)), 10).where("a % 500 = 0").select("a", "b"))
    graph = nn_descent.build(vectors, n, **leaf)
    best = Window.partitionBy("a").orderBy("d")
    after = found_by(graph.withColumn("n", F.row_number().over(best)).where("n <= 10 AND a % 500 = 0").select("a", "b"))
    got = found_by(nn_descent.nearest(rows, F.col("vec_id") % 500 == 0, **leaf).select("query_id", "vec_id"))
    found = [recall_of(f, x, asked) for f in (first, after, got)]
    print("recall of leaves, descent, search:", found)
    assert found[0] < 0.6 and found[1] > found[0] + 0.2 and found[2] >= 0.9


def test_the_beam_grows_until_recall_holds(spark, tmp_path):
    x, rows = made(spark, 3000, 24, tmp_path / "v.parquet")
    for given in ({"beam": 1, "trees": 1, "leaf": 64, "rounds": 0}, {"beam": 4, "trees": 1, "leaf": 8, "rounds": 0, "k": 10}):
        got = found_by(nn_descent.nearest(rows, F.col("vec_id") % 50 == 0, small=10, **given).select("query_id", "vec_id"))
        assert recall_of(got, x, range(0, 3000, 50)) >= 0.9


def test_searches_write_nothing_for_each_step(spark, tmp_path, monkeypatch):
    """Each shard's graph is searched within a task: before, every step of all searches was joined, ranked and written."""
    x, rows = made(spark, 3000, 24, tmp_path / "v.parquet")
    cut, written = nn_descent.cut, []

    def counted(df):
        written.append(cut(df))
        return written[-1]

    monkeypatch.setattr(nn_descent, "cut", counted)
    monkeypatch.setattr(nn_descent, "SHARD", 700, raising=False)
    got = found_by(nn_descent.nearest(rows, F.col("vec_id") % 50 == 0, small=10, leaf=128, rounds=2).select("query_id", "vec_id"))
    assert recall_of(got, x, range(0, 3000, 50)) >= 0.9
    assert len(written) <= 9  # nodes, queries, three graphs, index, queries, sample, truth; 17 before
    edges = next(w for w in written if "a" in w.columns)
    shards = edges.select(*(nn_descent._shard(c, 5).alias(c) for c in "ab")).distinct().collect()
    assert len(shards) == 5 and all(a == b for a, b in shards)


def test_nearest_of_clusters_across_shards(spark, monkeypatch):
    """Clusters that no edge joins, some of them near enough for squares to cancel out, dealt over shards."""
    draw = np.random.default_rng(12)
    centres = draw.standard_normal((60, 8))
    x = (centres[np.arange(3000) % 60] + 1e-4 * draw.standard_normal((3000, 8))).astype(np.float32)
    monkeypatch.setattr(nn_descent, "SHARD", 700, raising=False)
    rows = vectors(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)])
    got = found_by(nn_descent.nearest(rows, F.col("vec_id") % 100 == 0, small=10, leaf=128).select("query_id", "vec_id"))
    assert recall_of(got, x.astype(float), range(0, 3000, 100)) >= 0.9


def test_brute_force_in_blocks(spark, monkeypatch):
    draw = np.random.default_rng(5)
    x = draw.standard_normal((90, 4))
    nodes = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "node long, vector array<float>")
    asked = nodes.where("node < 20").select(F.col("node").alias("query"), F.col("vector").alias("q"))
    monkeypatch.setattr(nn_descent, "NODES", 13)
    monkeypatch.setattr(nn_descent, "QUERIES", 6)
    got = found_by(nn_descent.exact(nodes, asked, 7, 90, 20).select("query", "node"))
    assert {q: set(np.argsort(((x - x[q]) ** 2).sum(1))[:7].tolist()) for q in range(20)} == got


def test_descent_improves_a_poor_graph(spark):
    draw = np.random.default_rng(3)
    x = draw.standard_normal((400, 6))
    nodes = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "node long, vector array<double>")
    pairs = [(i, int(j), float(((x[i] - x[j]) ** 2).sum())) for i in range(400) for j in draw.choice(400, 8, replace=False) if i != j]
    graph = nn_descent.cut(nn_descent.keep_nearest(spark.createDataFrame(pairs, "a long, b long, d float").withColumn("new", F.lit(True)), 8))
    total = lambda g: g.agg(F.avg("d")).first()[0]
    first = total(graph)
    for _ in range(4):
        graph = nn_descent.cut(nn_descent.descend(graph, nodes, 8, 6))
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    np.fill_diagonal(d, np.inf)
    best = np.sort(d, 1)[:, :8].mean()
    assert total(graph) < best * 1.1 < first


# op10


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<html><body></body></html>", ""),
        ("plain words", "plain words"),
        ("<nav>menu</nav><article><h1>T</h1><p>One &amp; two<p>Three\n  four<br>five</article><footer>f</footer>", "T\nOne & two\nThree four\nfive"),
        ("<body><header>Site</header><main><header><h1>H</h1></header><p>Body text here.</p><aside>side</aside><form>f</form></main>", "H\nBody text here."),
        ("<div id=page><div class='sidebar'>x</div><div class=content><p>Long enough text for an article, with words.</p><p>More.</p></div><div class=comments><p>reader comment that is quite long as well, really</p></div></div>", "Long enough text for an article, with words.\nMore."),
        ("<article><p>a<b>b</b><i> c</i><script>x='<p>'</script><style>p{}</style><!-- no --></p></article>", "ab c"),
        ("<article><p>&lt;tag&gt; &#233; &nbsp;x</p><div class='ad'>buy</div><ul><li>1<li>2</ul></article>", "<tag> é x\n1\n2"),
        ("<p>never closed <b>bold", "never closed bold"),
        ("<div class='post tag-news side-by-side'><p>kept text</p><p style='display: none'>no</p><div class=tags>x</div><ol class=commentlist><li>c</ol></div>", "kept text"),
        ("<div class=cookie-notice>we use cookies</div><div><p>text</p></div>", "text"),
    ],
)
def test_pages(page, text):
    assert html_ttr.extract(page) == text


def test_page_rows(spark):
    rows = spark.createDataFrame([(1, "u", "<article><p>x</p></article>", "old"), (1, "u", "<article><p>x</p></article>", "old"), (2, None, None, None), (None, "v", "<p>" + "long " * 50_000, "t")], "page_id long, url string, html string, text string")
    got = html_ttr.query(spark, rows).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 249_999), (1, 1), (1, 1), (2, 0)]
    assert html_ttr.query(spark, rows.limit(0)).count() == 0
    assert set(html_ttr.main_text(rows).columns) == set(rows.columns)


def test_deep_and_broken_pages():
    for page in ("<div>" * 20_000 + "x", "<b>" * 20_000 + "y", "</x>" * 20_000 + "z"):
        assert html_ttr.extract(page) in "xyz"


def test_pages_of_the_table(spark):
    import html
    import re

    for r in queries.op10_html_text_to_tag(spark, DATA).join(spark.read.parquet(f"{DATA}/pages.parquet").select("page_id", "html"), "page_id").collect():
        body = re.search(r"<article>(.*?)(</article>|<footer>)", r.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)\b[^>]*>", body))
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


# pipeline


def test_pipeline(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, seen, DATA)
        assert out.columns == docs.columns, name
        out = nn_descent.cut(out)
        assert 0 < out.count() <= seen.count()
        seen = out
    last = corpus_pipeline.run(spark, DATA)
    assert {r.doc_id for r in last.select("doc_id").collect()} == {r.doc_id for r in seen.select("doc_id").collect()}
    assert last.where("octet_length(ids) <> 4 * n_tokens OR decoded_sha256 <> sha2(encode(text, 'UTF-8'), 256)").count() == 0


def test_pipeline_stages_take_odd_rows(spark, odd_docs, no_docs):
    plain = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, plain, DATA).count() <= plain.count()
        assert stage(spark, plain.limit(0), DATA).count() == 0
