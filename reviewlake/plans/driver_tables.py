"""The shared tables seen as review tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewlake.functions.text import lexical_tokens
from reviewlake.operators.placement import spread

CATEGORIES = ("tv", "phone", "appliance")
#: More lines than a text can have, so line ids never collide.
LINES_PER_DOCUMENT = 1 << 32
LINES_PER_PAGE = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table for text-heavy work, spread over the cores when its files have too few splits."""
    return spread(table(spark, sf_dir, name))


def reviews(documents: DataFrame) -> DataFrame:
    """Documents as reviews: first line as title, source as brand; category and rating are stand-ins."""
    category = F.element_at(F.array(*[F.lit(c) for c in CATEGORIES]), (F.col("doc_id") % 3 + 1).cast("int"))
    return documents.select(
        F.col("doc_id").alias("id"),
        "text",
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
        F.upper("source").alias("brand_name"),
        category.alias("category"),
        (F.col("n_chars") % 5 + 1).cast("int").alias("rating"),
        F.col("lang").alias("language"),
    )


def product_docs(documents: DataFrame) -> DataFrame:
    """Each document as a nested product page whose reviews are its lines, keyed by an id per line."""
    lines = F.split("text", "\n")
    entry = lambda line, i: F.struct(
        (F.col("doc_id") * LINES_PER_DOCUMENT + i).cast("string").alias("key"),
        F.struct(
            line.alias("reviewText"),
            F.substring_index(line, " ", 3).alias("title"),
            (F.length(line) % 5 + 1).cast("int").alias("rating"),
            F.struct(F.struct((F.length(line) % 60 + 18).cast("string").alias("value")).alias("age")).alias("contextDataValues"),
        ).alias("value"),
    )
    detail = F.struct(
        F.col("doc_id").cast("string").alias("pid"), F.upper("source").alias("brandName"), F.concat(F.lit("item "), F.col("doc_id")).alias("name")
    )
    page = lambda p: F.struct(
        (p + 1).cast("string").alias("key"), F.slice(lines, p * LINES_PER_PAGE + 1, F.lit(LINES_PER_PAGE)).alias("value")
    )
    last_page = F.floor((F.size(lines) - 1) / LINES_PER_PAGE).cast("int")
    by_page = F.map_from_entries(F.transform(F.sequence(F.lit(0), last_page), page))
    paging = F.struct(F.size(lines).cast("int").alias("totalItems"), by_page.alias("byPage"))
    products = F.struct(
        F.map_from_entries(F.transform(lines, entry)).alias("reviewsById"),
        F.create_map(F.col("doc_id").cast("string"), detail).alias("detailsByPid"),
        F.create_map(F.col("doc_id").cast("string"), F.array(paging)).alias("reviewsByPid"),
    )
    return documents.select("doc_id", products.alias("products"))


# The forms of the stand-in lexicon that stand for two words.
CONTRACTIONS = [
    ("fr", "du", "de", "le"),
    ("fr", "des", "de", "les"),
    ("es", "del", "de", "el"),
    ("de", "zum", "zu", "dem"),
]
SUFFIXES = "(tion|ment|eaux|ing|ed|es|en|er|s)$"


def derived_lexicon(documents: DataFrame) -> DataFrame:
    """A lexicon from the corpus itself: every form of three or more letters, its lemma by suffix rule."""
    forms = documents.select(F.col("lang").alias("language"), F.explode(lexical_tokens("text")).alias("token"))
    forms = forms.select("language", F.lower("token").alias("form")).distinct()
    forms = forms.where((F.length("form") >= 3) & F.col("form").rlike(r"^\p{L}+$"))
    two = F.lit(None).cast("array<struct<word_idx:int,lemma:string,upos:string>>")
    for language, form, first, second in CONTRACTIONS:
        words = F.array(
            F.struct(F.lit(0).alias("word_idx"), F.lit(first).alias("lemma"), F.lit("ADP").alias("upos")),
            F.struct(F.lit(1).alias("word_idx"), F.lit(second).alias("lemma"), F.lit("DET").alias("upos")),
        )
        two = F.when((F.col("language") == language) & (F.col("form") == form), words).otherwise(two)
    stem = F.when(F.length("form") >= 6, F.regexp_replace("form", SUFFIXES, "")).otherwise(F.col("form"))
    upos = F.when(stem != F.col("form"), "VERB").when(F.length("form") <= 3, "DET").otherwise("NOUN")
    one = F.array(F.struct(F.lit(0).alias("word_idx"), stem.alias("lemma"), upos.alias("upos")))
    return forms.select("language", "form", F.inline(F.coalesce(two, one)))
