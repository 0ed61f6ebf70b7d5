"""String and URL expressions. Word characters are Unicode letters, numbers and the underscore."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Patterns that decide what a token is, the same in every query.
WORD = r"[\p{L}\p{N}_]{2,}"
LEXICAL = r"\p{N}+(?:[.,]\p{N}+)+|[\p{L}\p{M}\p{N}_]+|[^\p{Z}\p{C}\p{L}\p{M}\p{N}_]"
NON_LETTERS = r"[^\p{L}]+"


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def word_tokens(column: str | Column) -> Column:
    """Lower-cased runs of at least two word characters, in text order."""
    return F.regexp_extract_all(F.lower(_col(column)), F.lit(WORD), F.lit(0))


def lexical_tokens(column: str | Column) -> Column:
    """Words, numbers and single punctuation or symbol characters, in text order."""
    return F.regexp_extract_all(_col(column), F.lit(LEXICAL), F.lit(0))


def shifted(column: str, count: int) -> Column:
    """Array of structs: each element together with the ``count - 1`` that follow it (NULL past the end).

    Every shifted copy is one ``slice``, so the cost is linear in the array length; fields are
    named w0, w1 and so on.
    """
    copies = [_col(column).alias("w0")]
    for k in range(1, count):
        copies.append(F.slice(_col(column), k + 1, F.greatest(F.size(column), F.lit(1))).alias(f"w{k}"))
    return F.arrays_zip(*copies)


def letters_only(column: str | Column) -> Column:
    """Lower-cased letters with one blank between words and around the text."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(_col(column)), NON_LETTERS, " ")), F.lit(" "))


def brand_key(column: str | Column) -> Column:
    """Lower-cased brand; NULL becomes the empty string."""
    return F.coalesce(F.lower(_col(column)), F.lit(""))


def title_and_text(title: str | Column, text: str | Column) -> Column:
    """Title, a blank, text; NULL when either is NULL."""
    return F.concat(_col(title), F.lit(" "), _col(text))


def joined(tokens: str | Column) -> Column:
    return F.array_join(_col(tokens), " ")


def strip_fragment(url: str | Column) -> Column:
    """URL without ``#`` and what follows it."""
    return F.regexp_replace(_col(url), "#.*$", "")


def safe_name(url: str | Column) -> Column:
    """File name for a URL: everything but word characters, ``-`` and ``.`` becomes ``_``."""
    return F.concat(F.regexp_replace(_col(url), r"[^\p{L}\p{N}_\-.]", "_"), F.lit(".json"))


def page_count(total: str | Column, per_page: str | Column) -> Column:
    """Pages needed for ``total`` items; NULL when a page holds nothing."""
    return F.ceil(_col(total) / F.nullif(_col(per_page), F.lit(0))).cast("bigint")


def extra_page_urls(url: str | Column, pages: str | Column) -> Column:
    """URLs of pages 2..n, as an array that is empty for one page or none."""
    numbers = F.sequence(F.lit(1), F.greatest(F.coalesce(_col(pages), F.lit(1)), F.lit(1)).cast("int"))
    base = strip_fragment(url)
    return F.transform(
        F.filter(numbers, lambda k: k >= 2), lambda k: F.concat(base, F.lit("reviews?page="), k.cast("string"))
    )


def first_of_first(mapping: str | Column) -> Column:
    """First element of the first value of a map of arrays; NULL when there is none."""
    return F.get(F.get(F.map_values(_col(mapping)), F.lit(0)), F.lit(0))


def key_count(mapping: str | Column) -> Column:
    """Number of entries of a map or array; NULL for NULL."""
    return F.when(_col(mapping).isNotNull(), F.size(_col(mapping)))
