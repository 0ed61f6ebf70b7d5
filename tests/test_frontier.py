"""Following stored pages to a fixpoint."""

import json

import pytest
from pyspark.sql import functions as F

from reviewlake.operators import frontier
from reviewlake.sources import sinks


def _links(pages):
    """Links of a page are the words of its html."""
    return pages.select(F.explode(F.split("html", " ")).alias("page_url")).where("page_url <> ''")


@pytest.mark.parametrize("max_bytes", [0, 1 << 20])
def test_chains_cycles_and_missing_pages(spark, max_bytes):
    chain = [(f"c{i}", f"c{i + 1}") for i in range(6)]
    pages = chain + [("a", "b a"), ("b", "a gone"), ("b", "a gone"), ("island", "a"), (None, "c0"), ("empty", ""), ("null", None)]
    archive = spark.createDataFrame(pages, "url string, html string").repartition(3)
    seeds = spark.createDataFrame([("a",), ("a",), ("c0",), ("c3",), ("empty",), ("null",), (None,), ("never",)], "url string")
    reached = frontier.reach(seeds, archive, _links, max_bytes=max_bytes)
    want = {"a": 0, "b": 1, "gone": 2, "c0": 0, "c1": 1, "c2": 2, "c3": 0, "c4": 1, "c5": 2, "c6": 3, "empty": 0, "null": 0, "never": 0}
    rows = reached.collect()
    assert len(rows) == len(want) and {r["url"]: r["depth"] for r in rows} == want
    assert {r["url"] for r in frontier.missing_pages(reached).collect()} == {"gone", "c6", "never"}
    with pytest.raises(RuntimeError):
        frontier.reach(seeds, archive, _links, max_rounds=2)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "url string, html string")
    assert frontier.reach(none, none).count() == 0
    assert [tuple(r) for r in frontier.reach(spark.createDataFrame([("x",)], "url string"), none).collect()] == [("x", 0, False)]


def test_review_pages_become_named_documents(spark, tmp_path):
    paging = {"totalItems": 5, "byPage": {"1": ["i", "j"]}}
    first = {"products": {"reviewsById": {"1": {"reviewText": "good"}}, "reviewsByPid": {"p": [paging]}}}
    page = lambda value: f"<html>\n<script>s({json.dumps(value)});</script>\n</html>"
    base = "https://shop.example/p/"
    pages = [(base, page(first)), (base + "reviews?page=2", page({"reviewText": "two"})), ("https://shop.example/q/", "<html></html>")]
    archive = spark.createDataFrame(pages, "url string, html string")
    seeds = archive.select("url").where("url NOT LIKE '%page%'")
    reached = frontier.reach(seeds, archive)
    assert {r["url"] for r in frontier.missing_pages(reached).collect()} == {base + "reviews?page=3"}
    good, rejects = frontier.named_documents(reached, archive)
    assert [tuple(r) for r in rejects.collect()] == [("https://shop.example/q/", 0)]
    path = sinks.write_named(good, str(tmp_path / "named"), "name", "json")
    stored = {r["name"]: json.loads(r["value"]) for r in spark.read.parquet(path).collect()}
    assert stored == {"https___shop.example_p_.json": first, "https___shop.example_p_reviews_page_2.json": {"reviewText": "two"}}
