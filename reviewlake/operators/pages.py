"""Stored product pages: find the embedded JSON, parse it, and list the further review pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from reviewlake.functions.text import extra_page_urls, first_of_first, key_count, page_count, strip_fragment
from reviewlake.sources.documents import PRODUCT_DOC

# The key that marks the wanted JSON line.
SIGNATURE = "reviewText"


def json_matches(html: str | Column, signature: str = SIGNATURE) -> Column:
    """All matches of a brace span that contains the quoted signature, at most one per line.

    On one line the widest span runs from the first opening to the last closing brace, so the
    signature only has to be searched in that span. The anchored pattern is linear in the line
    length, also on minified lines with many braces.
    """
    text = F.col(html) if isinstance(html, str) else html
    quoted = F.lit(f'"{signature}"')
    lines = F.filter(F.split(text, "\n"), lambda line: F.contains(line, quoted))
    spans = F.transform(lines, lambda line: F.regexp_extract(line, r"(?s)^[^{]*(\{.*\})", 1))
    return F.filter(spans, lambda span: F.contains(span, quoted))


def extract_embedded_json(
    pages: DataFrame, html: str = "html", signature: str = SIGNATURE, name: str = "json"
) -> tuple[DataFrame, DataFrame]:
    """(pages with exactly one match in ``name``, rejected pages with their number of ``matches``).

    A page without HTML is rejected with 0 matches.
    """
    found = pages.withColumn("_found", json_matches(html, signature))
    matches = F.coalesce(key_count("_found"), F.lit(0))
    good = found.where(matches == 1).withColumn(name, F.get("_found", F.lit(0))).drop("_found")
    rejects = found.where(matches != 1).withColumn("matches", matches.cast("bigint")).drop("_found")
    return good, rejects


def parse_products(pages: DataFrame, column: str = "json", schema: T.StructType = PRODUCT_DOC, name: str = "doc") -> DataFrame:
    """Add the JSON text as a nested value; malformed text gives NULL fields."""
    return pages.withColumn(name, F.from_json(F.col(column), schema))


def parse_loose(pages: DataFrame, column: str = "json", name: str = "doc") -> tuple[DataFrame, DataFrame]:
    """(rows with the JSON text as a variant in ``name``, rejected rows): no schema is declared.

    Any JSON value counts, also ``null``, a number or a list. Missing or malformed text is rejected, and so is a
    value with anything but blanks behind it, which the parser alone would ignore: only one whole value stays
    valid both inside a list and inside an object.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), column, F.lit("]")))
    held = F.try_parse_json(F.concat(F.lit('{"v":'), column, F.lit("}")))
    parsed = pages.withColumn(name, F.when(listed.isNotNull() & held.isNotNull(), F.try_parse_json(column)))
    return parsed.where(F.col(name).isNotNull()), parsed.where(F.col(name).isNull()).drop(name)


def loose_fields(pages: DataFrame, fields: dict[str, tuple[str, str]], doc: str = "doc") -> DataFrame:
    """Add a column per field from (path, type); NULL where the path is missing or its value is not of the type."""
    return pages.withColumns({name: F.try_variant_get(doc, path, kind) for name, (path, kind) in fields.items()})


def paging(pages: DataFrame, doc: str = "doc") -> DataFrame:
    """Add (total, per_page, pages) from the first entry of ``products.reviewsByPid``."""
    stem = first_of_first(f"{doc}.products.reviewsByPid")
    first_page = stem.getField("byPage").getItem("1")
    numbered = pages.withColumn("total", stem.getField("totalItems")).withColumn("per_page", key_count(first_page))
    return numbered.withColumn("pages", page_count("total", "per_page"))


def further_pages(pages: DataFrame, url: str = "url", count: str = "pages") -> DataFrame:
    """(url, page_url): one row for each of pages 2..n, built from the URL without its fragment."""
    stripped = pages.select(strip_fragment(url).alias("url"), F.col(count).alias("_pages"))
    return stripped.select("url", F.explode(extra_page_urls("url", "_pages")).alias("page_url"))
