"""Pages, vectors and the pipeline."""

import html
import math
import re
from collections import Counter

import numpy as np
import pytest
from test_text_operators import _brute_components, _rules_by_hand

import corpus_pipeline
from reviewlake.llm import html_tree, permutation_index, queries
from reviewlake.llm.dom import parse
from pyspark.sql import functions as F


def _article(page):
    inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
    return "\n\n".join(b for b in blocks if b)


def test_extracts_articles(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = {r["page_id"]: r for r in html_tree.extract_pages(pages).collect()}
    for page in pages.collect():
        assert found[page["page_id"]]["text"] == _article(page["html"])
        assert found[page["page_id"]]["n_chars"] == len(found[page["page_id"]]["text"])


SENTENCE = "The committee met in the old hall on Tuesday and spoke for hours about the new bridge over the river. "


def test_other_layouts(spark, sf_dir):
    """Pages without an article tag, and noise inside the article; potentials from the ordinary pages."""
    body = f"<h1>Bridge over the river</h1><p>{SENTENCE * 2}</p><p>{SENTENCE * 3}</p><p>It is &lt;done&gt;&nbsp;now. {SENTENCE}</p>"
    noise = {
        "menu": '<ul class="menu"><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul>',
        "side": f'<aside><p>Related: {SENTENCE}</p></aside>',
        "cookie": f'<div class="cookie-notice"><p>We use cookies. {SENTENCE}</p></div>',
        "comments": f'<section id="comments"><div class="comment"><p>I think so too. {SENTENCE}</p></div></section>',
        "form": '<form><label>Mail</label><input name="m"><button>Send</button></form>',
        "footer": f"<footer><p>&copy; 2020 The Paper. All rights reserved. {SENTENCE}</p></footer>",
        "script": "<script>var x = '<p>no</p>';</script><style>p{}</style><!-- <p>hidden</p> -->",
    }
    page = f"<html><head><title>T</title></head><body>{noise['menu']}<div class='content'>{body}{noise['script']}</div>{noise['side']}{noise['cookie']}{noise['comments']}{noise['form']}{noise['footer']}</body></html>"
    inside = f"<html><body><article>{body}{noise['side']}{noise['comments']}{noise['form']}</article>{noise['footer']}</body></html>"
    want = "\n\n".join(["Bridge over the river", (SENTENCE * 2).strip(), (SENTENCE * 3).strip(), f"It is <done> now. {SENTENCE}".strip()])
    ordinary = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    odd = spark.createDataFrame([(-1, "u", page), (-2, "u", inside), (-3, None, None), (-4, "u", ""), (-5, "u", "just < words & more"), (-6, "u", "<p" * 5)], ordinary.schema)
    model = html_tree.fit(ordinary)
    assert html_tree.main_text(page, model) == want
    assert html_tree.main_text(inside, model) == want
    rows = odd.withColumn("text", F.lit("clash")).unionByName(odd.withColumn("text", F.lit("clash")))
    found = Counter((r["page_id"], r["text"]) for r in html_tree.extract_pages(rows).collect())
    assert found[-3, ""] == 2 and found[-4, ""] == 2 and sum(found.values()) == 12
    assert html_tree.extract_pages(odd.limit(0)).count() == 0


def test_parser_is_tolerant():
    text = lambda page: [n.text for n in parse(page) if n.text is not None]
    assert text("<p><b>One<br>two<br><p>Three</b> four</p></div>five<li>six<li>seven") == ["One two", "Three four", "five", "six", "seven"]
    assert text("a<b>b</b>c &amp; d<div>e</div> f &copy") == ["abc & d", "e", "f ©"]
    assert text('<a title="x > y">link</a> <!-- no > --><script>if (a < b) {}</script>z') == ["link z"]
    assert text("<p>" * 3000 + "deep") == ["deep"]


def test_parser_keeps_text_around_and_in_embedded_elements():
    text = lambda page: [n.text for n in parse(page) if n.text is not None]
    assert text('<p>one <svg class="i" viewBox="0 0 1 1"/>two</p><p>three</p>') == ["one two", "three"]
    assert text("<p>one<svg><path d='m'/></svg> two</p><svg/><p>three</p><svg></svg>") == ["one two", "three"]
    assert text("<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be, <math/>so</p><p>end</p>") == ["Let x=1 be, so", "end"]
    assert text("<p>a</p><noscript><p>in noscript</p></noscript><object data='x'>in object</object>b") == ["a", "in noscript", "in object", "b"]
    for name in ("svg", "template", "iframe", "textarea"):
        assert text(f"<p>before</p><{name}><p>after</p>") == ["before", "after"]
        assert text(f"<p>before</p><{name}>gone</{name}><p>after</p>") == ["before", "after"]
    assert text("<svg-icon>kept</svg-icon><p>end</p>") == ["kept", "end"]
    assert text("a<script>if (x) {") == ["a"]


def test_messages_give_exact_marginals():
    model = html_tree.TreeModel({})
    nodes = parse("<div class='ad'>Buy now</div><div><p>A long sentence stands here, it ends.</p><a>x</a></div>")
    own = []
    for i, node in enumerate(nodes):
        score = [0.0, 0.0, 0.0 if node.text is None else -60.0]
        for feature in html_tree.node_features(nodes, i) if i else ():
            weight = 1 if node.text is None else html_tree.TEXT_WEIGHT
            score = [a + weight * b for a, b in zip(score, model.own.get(feature, (0, 0, 0)))]
        own.append([math.exp(s - max(score)) for s in score])
    total, content = 0.0, [0.0] * len(nodes)
    for states in np.ndindex(*(3,) * len(nodes)):
        p = (0.15, 0.15, 0.7)[states[0]]
        for i, s in enumerate(states):
            p *= own[i][s] * (model.edge[states[nodes[i].parent]][s] if i else 1)
        total += p
        for i, s in enumerate(states):
            content[i] += p * (s == 0)
    assert np.allclose(model.marginals(nodes), np.array(content) / total, atol=1e-9)


def _brute_search(rows, k):
    clean = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    out = {}
    for q, x in clean:
        if q % 20 == 0:
            scored = sorted(((-(x * y).sum(), i) for i, y in clean if i != q))[:k]
            out[q] = [(i, -s) for s, i in scored]
    return out


def test_nearest_neighbours_of_awkward_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[5][1]) for i in range(40)]
    rows += [(2000, None), (2020, []), (2040, [0.0] * 8), (2060, [float("nan")] + [1.0] * 7), (2080, [None] + [1.0] * 7), (2100, [float("inf")] + [1.0] * 7), (None, [1.0] * 8)]
    vectors = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "vec_id long, embedding array<float>, score string, rank string")
    found = permutation_index.search(vectors, F.col("vec_id") % 20 == 0, k=20, pivots=16, places=8)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    want = _brute_search(rows, 20)
    assert set(got) == set(want)
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], atol=1e-12)
    few = permutation_index.search(vectors.where("vec_id < 3"), F.col("vec_id") % 20 == 0, k=20)
    assert few.count() == 2
    assert permutation_index.search(vectors.limit(0), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("sizes", [(1e25, 1e25), (1e-30, 1e-30), (1e-20, 1e25)])
def test_vectors_of_any_finite_size_take_part(spark, sizes):
    rng = np.random.default_rng(1)
    scale = np.exp(rng.uniform(*np.log(sizes), 200))
    rows = [(i, (rng.normal(size=8) * scale[i]).astype(np.float32).tolist()) for i in range(200)]
    found = permutation_index.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0, k=20, pivots=16, places=8)
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = _brute_search(rows, 20)
    assert {q: [i for i, _ in some] for q, some in got.items()} == {q: [i for i, _ in some] for q, some in want.items()}
    assert all(np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-9, atol=0) for q in want)


def test_recall_with_a_real_cut(spark):
    sf_dir = "/root/testdata/sf0.1"
    found = permutation_index.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)
    got = {}
    for r in found.collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").toPandas()
    ids, matrix = table["vec_id"].to_numpy(), np.stack(table["embedding"]).astype(float)
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        scores = matrix @ matrix[q]
        scores[q] = -np.inf
        best = set(ids[np.argsort(-scores)[:20]].tolist())
        hits, total = hits + len(best & got[int(ids[q])]), total + 20
    assert hits / total >= 0.9


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    after = {}
    current = docs
    for name, stage in corpus_pipeline.STAGES:
        current = stage(spark, current, sf_dir).persist()
        after[name] = current.collect()
        if name != "encoding":
            assert current.columns == docs.columns
    first = {r["doc_id"] for r in after["toxicity"]}
    assert not [d for d, r in labels.items() if r["toxic"] == 0 and d not in first]
    ruled = {r["doc_id"] for r in after["quality_rules"]}
    assert all(not _rules_by_hand(r["text"])[5] for r in after["quality_rules"]) and ruled <= first
    groups = _brute_components([(r["doc_id"], r["text"]) for r in after["quality_rules"]], 80, 5)
    single = [r["doc_id"] for r in after["near_duplicates"]]
    assert sorted(single) == sorted({c for _, _, c in groups})
    mixed = Counter(r["doc_id"] for r in after["mixing"])
    assert set(mixed) == set(single) and max(mixed.values()) <= 5
    assert Counter(r["doc_id"] for r in after["encoding"]) == mixed


def test_mixing_stage_leaves_columns_of_any_name(spark, sf_dir):
    rows = [(i, f"some words of row {i}", "ab"[i % 2], f"note {i}", i) for i in range(20)]
    named = spark.createDataFrame(rows, "doc_id long, text string, source string, mix_note string, _mix_block long")
    got = corpus_pipeline.mix_sources(spark, named, sf_dir)
    assert got.schema == named.schema
    assert set(map(tuple, got.collect())) == set(rows)


def test_pipeline_run_and_registration(spark, sf_dir):
    import __spark_entry__ as entry

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality_rules", "near_duplicates", "mixing", "encoding"]
    registered = entry.queries()
    assert set(queries.QUERIES) | {"pipeline"} <= set(registered)
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql_oracles_name_a_query(name):
    assert name in queries.QUERIES
