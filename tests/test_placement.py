"""Joins and orderings that must not depend on size, skew or partitioning."""

import pytest
from pyspark.sql import functions as F

from reviewlake.operators import language, placement, ranking, vectorize


def _skewed(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 200))
    return spark.range(6_000).select("id", key.alias("key"))


def _lookup(spark):
    pairs = [("hot", 1), ("hot", 2)] + [(f"k{i}", i) for i in range(0, 200, 2)] + [(None, 0)]
    return spark.createDataFrame(pairs, "key string, value int")


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot_by", [None, "value"])
def test_lookup_join_without_broadcast_gives_the_same_rows(spark, how, hot_by):
    big, small = _skewed(spark), _lookup(spark)
    plain = big.join(small, "key", how)
    split = placement.lookup_join(big, small, "key", how, hot_by=hot_by, max_bytes=0)
    order = ["id", "key", "value"]
    assert sorted(map(str, split.select(order).collect())) == sorted(map(str, plain.select(order).collect()))


def test_lookup_join_takes_out_only_dominant_keys(spark):
    frequency = _skewed(spark).groupBy("key").agg(F.count("*").alias("_n"))
    assert [r["key"] for r in placement._hot_keys(frequency, 0.5).collect()] == ["hot"]
    even = spark.range(5_000).select(F.col("id").alias("key"), F.lit(1).cast("bigint").alias("_n"))
    assert placement._hot_keys(even, 0.5) is None
    big, small = spark.range(500), spark.range(0, 500, 2)
    assert placement.lookup_join(big, small, "id", "left", max_bytes=0).count() == 500


def test_null_keys_of_a_left_lookup_survive(spark):
    big = spark.range(300).select("id", F.when(F.col("id") % 3 > 0, F.col("id")).alias("key"))
    small = spark.range(300).select(F.col("id").alias("key"), F.lit(1).alias("n"))
    got = placement.lookup_join(big, small, "key", "left", hot_by="n", max_bytes=0)
    assert got.count() == 300 and got.where("n is null").count() == 100


def test_pin_small_stages_what_is_too_big(spark):
    rows = spark.range(100)
    assert sorted(r["id"] for r in placement.pin_small(rows, "t", max_rows=10).collect()) == list(range(100))
    assert "broadcast" in placement.pin_small(rows, "t")._jdf.queryExecution().analyzed().toString().lower()


def test_shared_folder_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert placement.shared_folder(spark) == configured


def test_global_index_is_the_sort_order(spark):
    rows = spark.range(5_000).select((F.col("id") * 7919 % 5_003).alias("n")).repartition(9)
    got = {r["n"]: r["idx"] for r in ranking.global_index(rows, "n").collect()}
    assert got == {n: i for i, n in enumerate(sorted(got))}


def test_numbering_within_a_dominant_group(spark):
    rows = spark.range(9_000).select("id", F.when(F.col("id") % 10 > 0, "big").otherwise("small").alias("g"))
    hashed = ranking.hashed_rows(rows, "id", "g", 1)
    numbered = ranking.numbered_in_group(hashed, ranking.prefix_counts(hashed))
    for group, size in (("big", 8_100), ("small", 900)):
        assert sorted(r["_rn"] for r in numbered.where(F.col("_g") == group).collect()) == list(range(size))


TEXTS = [(1, "the cat ate the dog and the dog ate the cat"), (2, "the dog saw a cat"), (3, "the end of the dog"), (4, "nothing here"), (5, "")]


def test_tfidf_is_the_same_with_and_without_broadcast(spark, monkeypatch):
    docs = spark.createDataFrame(TEXTS, "id int, text string")
    fitted = vectorize.fit_vocabulary(docs, "id", "text", (1, 3), min_df=1, max_df=1.0)
    fast = {(r["id"], r["term"]): round(r["value"], 9) for r in vectorize.transform(docs, "id", "text", fitted).collect()}
    counted = vectorize.term_counts(docs, "id", "text", (1, 3))
    joined = placement.lookup_join(counted, fitted.terms, "term", hot_by="df", max_bytes=0)
    assert joined.count() == len(fast)
    monkeypatch.setattr(vectorize, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(placement, "fits_broadcast", lambda df, max_bytes=0: False)
    slow = {(r["id"], r["term"]): round(r["value"], 9) for r in vectorize.transform(docs, "id", "text", fitted).collect()}
    assert slow == fast


def test_language_is_the_same_with_and_without_broadcast(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language.fit_profiles(docs.select("text", F.col("lang").alias("language")))
    fast = language.identify(docs, model, "doc_id").collect()
    slow = language.identify(docs, model, "doc_id", max_bytes=0).collect()
    assert sorted(map(tuple, fast)) == sorted(map(tuple, slow))
