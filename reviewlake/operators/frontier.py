"""From stored pages to named documents: follow the further pages that stored ones announce, until nothing new turns up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from reviewlake.functions.text import safe_name
from reviewlake.operators.pages import extract_embedded_json, further_pages, paging, parse_products
from reviewlake.operators.placement import BROADCAST_BYTES, fits_broadcast, stage

Links = Callable[[DataFrame], DataFrame]


def review_pages(stored: DataFrame) -> DataFrame:
    """(page_url) of the review pages that product pages (url, html) announce; a page without usable JSON announces none."""
    good, _ = extract_embedded_json(stored)
    return further_pages(paging(parse_products(good))).select("page_url")


def reach(seeds: DataFrame, archive: DataFrame, links: Links = review_pages, max_rounds: int = 100, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(url, depth, stored): every URL that the seeds lead to, the fewest steps to it, and whether ``archive`` holds it.

    ``seeds`` has url, ``archive`` (url, html), ``links`` makes rows (page_url) from archive rows. A round parses only pages
    that are wanted for the first time and drops URLs that are known, so cycles end and each page is parsed once.
    Rounds are written to the shared folder. Rows with url NULL are left out; a URL that is not stored leads nowhere.
    Too many rounds raise RuntimeError instead of leaving URLs out.
    """
    wanted = stage(seeds.select("url").where("url IS NOT NULL").distinct(), "wanted")
    pages = archive.select("url", "html")
    known = wanted.withColumn("depth", F.lit(0))
    depth = 0
    while not wanted.isEmpty():
        if depth == max_rounds:
            raise RuntimeError(f"no end after {max_rounds} rounds")
        depth += 1
        asked = F.broadcast(wanted) if fits_broadcast(wanted, max_bytes) else wanted
        named = links(pages.join(asked, "url", "left_semi")).select(F.col("page_url").alias("url"))
        wanted = stage(named.where("url IS NOT NULL").distinct().join(known, "url", "left_anti"), "wanted")
        known = known.unionByName(wanted.withColumn("depth", F.lit(depth)))
    held = pages.select("url").distinct().withColumn("stored", F.lit(True))
    return known.join(held, "url", "left").select("url", "depth", F.coalesce("stored", F.lit(False)).alias("stored"))


def missing_pages(reached: DataFrame) -> DataFrame:
    """(url, depth) of what has yet to be fetched."""
    return reached.where(~F.col("stored")).select("url", "depth")


def named_documents(reached: DataFrame, archive: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((url, name, json) of the stored pages reached, their rejects (url, matches)).

    The name is the file name for the URL. A URL that ``archive`` holds several times gives as many rows.
    """
    pages = archive.select("url", "html").join(reached.where("stored").select("url"), "url", "left_semi")
    good, rejects = extract_embedded_json(pages)
    return good.select("url", safe_name("url").alias("name"), "json"), rejects.select("url", "matches")
