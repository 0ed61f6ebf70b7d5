import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reviewlake.operators import checks, split, vectorize


def _docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, text string")


def _bags(counted):
    bags = {}
    for r in counted.collect():
        bags.setdefault(r["id"], {})[r["term"]] = r["tf"]
    return bags


def test_bag_of_words(spark):
    bags = _bags(vectorize.term_counts(_docs(spark, "food was good", "food was bad"), "id", "text"))
    assert bags == {0: {"food": 1, "was": 1, "good": 1}, 1: {"food": 1, "was": 1, "bad": 1}}


def test_word_order_shows_in_bigrams(spark):
    bags = _bags(vectorize.term_counts(_docs(spark, "cat ate dog", "dog ate cat"), "id", "text", (1, 2)))
    words = {"cat": 1, "ate": 1, "dog": 1}
    assert bags == {0: {**words, "cat ate": 1, "ate dog": 1}, 1: {**words, "dog ate": 1, "ate cat": 1}}


def test_ngrams_against_brute_force(spark):
    text = "aa bb aa bb cc dd aa bb"
    words = text.split()
    want = Counter(" ".join(words[i : i + n]) for n in range(2, 5) for i in range(len(words) - n + 1))
    assert _bags(vectorize.term_counts(_docs(spark, text, "zz"), "id", "text", (2, 4))) == {0: dict(want)}
    with pytest.raises(ValueError):
        vectorize.ngrams(_docs(spark, text), "id", "text", (0, 1))


def test_pruning_bounds(spark):
    texts = ["rare often most", "often most all", "often most all", "often most all", "all most xx"]
    frequencies = vectorize.doc_freq(vectorize.term_counts(_docs(spark, *texts), "id", "text"))
    kept = lambda **kw: {r["term"] for r in vectorize.prune(frequencies, 5, **kw).collect()}
    assert kept() == {"often", "all"}
    assert kept(max_df=5) == {"often", "all", "most"}
    assert kept(min_df=0.9, max_df=1.0) == {"most"}
    assert kept(min_df=1, max_df=1.0, max_features=2) == {"most", "all"}


def test_tfidf_values_and_norm(spark):
    docs = _docs(spark, "aa bb bb", "aa cc", "aa", "")
    fitted = vectorize.fit_vocabulary(docs, "id", "text", (1, 1), min_df=1, max_df=1.0)
    assert fitted.n_docs == 4
    got = {(r["id"], r["term"]): r["value"] for r in vectorize.transform(docs, "id", "text", fitted).collect()}
    idf = lambda df: math.log(5 / (1 + df)) + 1
    a, b = idf(3), 2 * idf(1)
    assert got[0, "bb"] == pytest.approx(b / math.hypot(a, b))
    for doc in (0, 1, 2):
        assert sum(v * v for (i, _), v in got.items() if i == doc) == pytest.approx(1.0)


def test_repeated_document_keys_are_refused(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "c d")], "id int, text string")
    with pytest.raises(checks.CheckFailed):
        vectorize.fit_vocabulary(docs, "id", "text")


def test_fit_on_train_ignores_test_terms(spark):
    docs = spark.createDataFrame([(1, "aa bb", "train"), (2, "aa bb", "train"), (3, "aa cc cc", "test"), (4, "cc", "test")], "id int, text string, train_test string")
    fit = lambda on: {r["term"] for r in vectorize.tfidf_vectorize(docs, "id", "text", (1, 1), max_df=1.0, fit_on=on).collect()}
    assert fit("train") == {"aa", "bb"}
    assert fit("all") == {"aa", "bb", "cc"}
    with pytest.raises(ValueError):
        fit("test")


def test_vectors_keep_empty_documents(spark):
    docs = _docs(spark, "aa bb", "aa", "")
    fitted = vectorize.fit_vocabulary(docs, "id", "text", (1, 1), min_df=1, max_df=1.0, indexed=True)
    vectors = vectorize.to_vectors(vectorize.transform(docs, "id", "text", fitted), docs, "id", 2)
    got = {r["id"]: r["features"] for r in vectors.collect()}
    assert got[2].size == 2 and got[2].numNonzeros() == 0
    assert got[0].norm(2) == pytest.approx(1.0) and list(got[0].indices) == [0, 1]
    assert {r["term"]: r["idx"] for r in fitted.terms.collect()} == {"aa": 0, "bb": 1}


def test_split_sizes_and_repeatability(spark):
    rows = spark.range(1_000).select("id", F.when(F.col("id") < 700, 5).otherwise(F.col("id") % 4 + 1).alias("rating"))
    first = split.stratified(rows, seed=1)
    sizes = {(r["rating"], r["train_test"]): r["count"] for r in first.groupBy("rating", "train_test").count().collect()}
    assert sum(v for (_, side), v in sizes.items() if side == "test") == 250
    for rating, n in {5: 700, 1: 75, 2: 75, 3: 75, 4: 75}.items():
        assert abs(sizes[rating, "test"] - 0.25 * n) < 1
    again = split.stratified(rows.repartition(13), seed=1)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()))
    other = split.stratified(rows, seed=2)
    assert sorted(map(tuple, first.collect())) != sorted(map(tuple, other.collect()))


def test_split_with_null_and_single_row_strata(spark):
    rows = spark.range(101).select("id", F.when(F.col("id") % 2 == 0, F.lit(None)).when(F.col("id") == 1, 9).otherwise(1).alias("rating"))
    parts = split.stratified(rows)
    assert parts.count() == 101 and parts.where("train_test = 'test'").count() == 26


def test_split_keeps_copies_of_a_key_together(spark):
    rows = spark.range(3_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("id"), F.lit(1).alias("rating"))
    assert split.stratified(rows).groupBy("id").agg(F.count_distinct("train_test").alias("sides")).where("sides > 1").count() == 0


def test_labels(spark):
    rows = spark.createDataFrame([(1, 3), (2, 4), (3, None)], "id int, rating int")
    assert [r["positive_review"] for r in split.binary_label(rows).orderBy("id").collect()] == [0, 1, 0]
    labelled = split.label_membership(rows, rows.where("id = 2"))
    assert {r["id"]: r["train_test"] for r in labelled.collect()} == {1: "test", 2: "train", 3: "test"}
    train, test = split.parts(labelled)
    assert train.count() == 1 and test.count() == 2
