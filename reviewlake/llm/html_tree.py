"""Main text of web pages by a tree-structured graphical model over the DOM.

Every element and every block of text is a node with a state: content, boilerplate, or (elements only)
mixed, which holds both. A parent's state shapes its children's through a table of potentials, and each
node has potentials of its own from its tag, class and text. Messages are passed from the leaves to the root
and back, which gives exact marginals on a tree; a block of text is kept when content is more likely than not.

Labelled pages are those that mark their article themselves (``article``, ``main``): the blocks inside
are content, apart from what carries an unmistakable mark of something else. Potentials are counts over such
pages, added to documented prior counts that stand for marks which training pages may lack.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reviewlake.llm.dom import Node, parse
from reviewlake.llm.linear import bounded
from reviewlake.llm.texts import ship_package, slices, text_column

#: Documented bound on the labelled pages that the potentials are counted on.
MOST_TRAINING_PAGES = 4_000
CONTENT, BOILER, MIXED = 0, 1, 2
MARKS = set("article main".split())
ASIDE = set("nav header footer aside form button select dialog menu fieldset".split())
#: Fixed words of class, id and role that mark boilerplate or content.
NOISE = re.compile(
    r"\b(nav|navbar|navigation|menu|breadcrumbs?|footer|header|masthead|banner|side-?bar|aside|widget|related|recommended|"
    r"promo|promoted|sponsor(ed)?|ads?|advert\w*|adbox|cookies?|consent|notice|notification|alert|popup|modal|newsletter|"
    r"subscribe|signup|login|search|share|sharing|social|comments?|commentlist|replies|respond|disqus|pagination|pager|"
    r"copyright|legal|disclaimer|hidden|toolbar|contentinfo|complementary|form|skip)\b"
)
SUBJECT = re.compile(r"\b(article|content|post|entry|story|main|body|text)\b")
#: Prior counts (content, boilerplate, mixed) of a node's features.
PRIOR = {
    "tag:nav": (0.02, 200, 0.02), "tag:header": (1, 40, 0.5), "tag:footer": (0.02, 200, 0.02), "tag:aside": (0.05, 200, 0.02),
    "tag:form": (0.05, 200, 0.02), "tag:button": (0.05, 100, 0.02), "tag:select": (0.05, 100, 0.02), "tag:menu": (0.05, 100, 0.1),
    "tag:dialog": (0.05, 100, 0.02), "tag:fieldset": (0.05, 100, 0.02), "hint:noise": (0.2, 400, 0.1), "hint:subject": (60, 2, 60),
    "tag:article": (60, 2, 40), "tag:main": (60, 2, 60), "leaf:p": (60, 20, 0), "leaf:li": (20, 40, 0), "leaf:head": (30, 15, 0),
    "links:most": (2, 80, 0), "links:none": (100, 40, 0), "words:20": (40, 10, 0), "words:80": (60, 2, 0), "stop:yes": (80, 20, 0),
    "stop:no": (20, 60, 0), "legal:yes": (0.2, 60, 0),
}
#: Prior counts of (parent state -> child state), over content, boilerplate, mixed.
PRIOR_EDGES = ((60, 1.5, 1.5), (0.3, 100, 0.6), (30, 30, 20))
#: No trained table may make a child's state more certain than this, so strong marks can still win.
MOST_CERTAIN = 0.995
#: What a block's own text says is several views of one thing, so each view counts in part.
TEXT_WEIGHT = 0.3
LEGAL = re.compile(r"©|\bcopyright\b|all rights reserved", re.I)
HEADS = set("h1 h2 h3 h4 h5 h6".split())


def node_features(nodes: list[Node], i: int) -> list[str]:
    """Names of what a node shows by itself."""
    node = nodes[i]
    if node.text is None:
        found = [f"tag:{node.tag}"] if node.tag in MARKS or node.tag in ASIDE else []  # a div or p alone says nothing
        if node.hint:
            found.append("hint:noise" if NOISE.search(node.hint) else "hint:subject" if SUBJECT.search(node.hint) else "hint:other")
        return found
    tag, words = nodes[node.parent].tag, node.text.count(" ") + 1
    size = next(n for n in (80, 20, 8, 3, 0) if words >= n)
    part = node.linked / len(node.text)
    return [
        f"leaf:{'head' if tag in HEADS else tag}",
        f"words:{size}",
        f"links:{'most' if part > 0.5 else 'some' if part > 0 else 'none'}",
        f"stop:{'yes' if node.text[-1] in '.!?…。' else 'no'}",
        *(["legal:yes"] if LEGAL.search(node.text) else []),
    ]


def weak_labels(nodes: list[Node]) -> list[int] | None:
    """State of each node of a page that marks one article, else None."""
    marked = [i for i, n in enumerate(nodes) if n.tag in MARKS]
    outer = [i for i in marked if not any(j in marked for j in _above(nodes, i))]
    if len(outer) != 1:
        return None
    inside, noise = [False] * len(nodes), [False] * len(nodes)
    for i, node in enumerate(nodes[1:], 1):
        inside[i] = inside[node.parent] or i == outer[0]
        noise[i] = noise[node.parent] or node.tag in ASIDE or bool(node.hint and NOISE.search(node.hint))
    below = [[0, 0] for _ in nodes]
    for i in range(len(nodes) - 1, 0, -1):
        if nodes[i].text is not None:
            below[i][0 if inside[i] and not noise[i] else 1] += 1
        for k in (0, 1):
            below[nodes[i].parent][k] += below[i][k]
    return [MIXED if c and b else CONTENT if c else BOILER for c, b in below]


def _above(nodes: list[Node], i: int) -> Iterator[int]:
    while (i := nodes[i].parent) > 0:
        yield i


class TreeModel:
    """Log potentials: ``own[feature]`` per state, ``edge[parent][child]``."""

    def __init__(self, counts: dict[str, tuple[float, float, float]]):
        none = (0, 0, 0)
        names = [f for f in {*PRIOR, *counts} if not f.startswith("edge:")]
        totals = [sum(PRIOR.get(f, none)[s] + counts.get(f, none)[s] for f in names) + 50 for s in range(3)]
        self.own = {}
        for feature in names:
            both = [a + b for a, b in zip(PRIOR.get(feature, none), counts.get(feature, none))]
            logs = [math.log((c + 0.05) / t) for c, t in zip(both, totals)]
            middle = sum(logs) / 3
            self.own[feature] = [max(-5.0, min(5.0, v - middle)) for v in logs]
        self.edge = []
        for parent in range(3):
            row = [a + b for a, b in zip(PRIOR_EDGES[parent], counts.get(f"edge:{parent}", (0, 0, 0)))]
            row = [max(c, 1e-3) / sum(row) for c in row]
            row = [max(p, (1 - MOST_CERTAIN) / 2) for p in row]
            row = [p / sum(row) for p in row]
            self.edge.append(row)

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Probability of content for each node: messages up in reverse page order, then down in page order."""
        own = []
        for i, node in enumerate(nodes):
            score = [0.0, 0.0, 0.0 if node.text is None else -60.0]
            for feature in node_features(nodes, i) if i else ():
                if found := self.own.get(feature):
                    weight = 1.0 if node.text is None else TEXT_WEIGHT
                    score = [a + weight * b for a, b in zip(score, found)]
            top = max(score)
            own.append([math.exp(s - top) for s in score])
        edge = self.edge
        up: list[list[float]] = [[]] * len(nodes)
        gathered = [list(x) for x in own]
        for i in range(len(nodes) - 1, 0, -1):
            a, b, c = gathered[i]
            message = [e[0] * a + e[1] * b + e[2] * c for e in edge]
            total = sum(message)
            up[i] = message = [m / total for m in message]
            mine = gathered[nodes[i].parent]
            product = [max(x * y, 1e-290) for x, y in zip(mine, message)]
            total = sum(product)
            gathered[nodes[i].parent] = [p / total for p in product]
        # the root holds everything: it is mixed unless its children say otherwise
        belief: list[list[float]] = [[]] * len(nodes)
        root = [g * p for g, p in zip(gathered[0], (0.15, 0.15, 0.7))]
        belief[0] = [g / sum(root) for g in root]
        for i in range(1, len(nodes)):
            above = [b / max(u, 1e-300) for b, u in zip(belief[nodes[i].parent], up[i])]
            down = [sum(above[p] * edge[p][s] for p in range(3)) for s in range(3)]
            product = [g * d for g, d in zip(gathered[i], down)]
            total = sum(product) or 1.0
            belief[i] = [p / total for p in product]
        return [b[CONTENT] for b in belief]


def main_text(page: str | None, model: TreeModel) -> str:
    """Kept blocks in page order, joined by two line feeds; empty if none."""
    nodes = parse(page)
    if len(nodes) == 1:
        return ""
    chance = model.marginals(nodes)
    return "\n\n".join(n.text for n, p in zip(nodes, chance) if n.text is not None and p > 0.5)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: Counter = Counter()
    for batch in batches:
        for page in text_column(batch, "html"):
            nodes = parse(page)
            states = weak_labels(nodes)
            if states is None:
                continue
            for i in range(1, len(nodes)):
                for feature in node_features(nodes, i):
                    found[feature, states[i]] += 1
                found[f"edge:{states[nodes[i].parent]}", states[i]] += 1
    yield pa.RecordBatch.from_pydict(
        {"feature": [f for f, _ in found], "state": [s for _, s in found], "n": list(found.values())},
        schema=pa.schema([("feature", pa.string()), ("state", pa.int32()), ("n", pa.int64())]),
    )


def fit(pages: DataFrame, most_pages: int = MOST_TRAINING_PAGES, most_features: int = 2_000) -> TreeModel:
    """Count potentials on a bounded sample of pages; what returns are a few counts per tag and feature."""
    keyed = pages.select(F.col("page_id").cast("long").alias("doc_id"), "html").where(F.col("html").rlike("(?i)<(article|main)\\b"))
    sample = bounded(keyed, most_pages).select("html")
    counted = sample.mapInArrow(_counts, "feature string, state int, n long").groupBy("feature").agg(
        *(F.sum(F.when(F.col("state") == s, F.col("n")).otherwise(0)).alias(f"s{s}") for s in range(3)), F.sum("n").alias("n")
    )
    rows = counted.orderBy(F.desc("n"), "feature").limit(most_features).collect()
    return TreeModel({r["feature"]: (r["s0"], r["s1"], r["s2"]) for r in rows})


def extract_pages(pages: DataFrame, most_pages: int = MOST_TRAINING_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) of every page, from its whole html.

    NULL or empty html, and pages in which no block is likely content, give an empty text. Repeated rows
    give repeated results; without labelled pages the prior counts decide alone; other columns are ignored.
    """
    ship_package(pages.sparkSession)
    model = pages.sparkSession.sparkContext.broadcast(fit(pages, most_pages))
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html", 16 << 20):
            texts = [main_text(page, model.value) for page in text_column(batch, "html")]
            kept = [batch.column(batch.schema.get_field_index(c)) for c in ("page_id", "url")]
            yield pa.RecordBatch.from_arrays(
                [kept[0].cast(pa.int64()), kept[1].cast(pa.string()), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], schema=schema
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
