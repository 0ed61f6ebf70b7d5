import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from reviewlake.config import Settings, settings
from reviewlake.functions import text as tx
from reviewlake.operators import checks, cleaning, keyed, profile
from reviewlake.sources.documents import PRODUCT_DOC, read_documents, read_stage
from reviewlake.sources.sinks import batch_ids, write_documents, write_files, write_named, write_stage

REVIEW = {"reviewText": "Hyvä", "title": "Ok", "rating": 5, "contextDataValues": {"age": {"value": "25to34"}}}


def _docs(spark, tmp_path, docs):
    path = tmp_path / "docs.json"
    path.write_text("\n".join(json.dumps(d) for d in docs))
    return read_documents(spark, str(path))


def test_targets():
    assert settings(" test ") == Settings("_test", 20)
    assert settings("PROD").limit is None and settings("prod").table("gold") == "reviews_gold"
    with pytest.raises(ValueError):
        settings("dev")


def test_unwind_drops_documents_without_reviews(spark, tmp_path):
    details = {"11": {"pid": "11", "brandName": "LG", "name": "first"}, "12": {"pid": "12", "brandName": "X", "name": "second"}}
    docs = [
        {"products": {"reviewsById": {"9": REVIEW, "x7": REVIEW}, "detailsByPid": details}},
        {"products": {"detailsByPid": details}},
        {"products": {"reviewsById": {}, "detailsByPid": details}},
        {"products": {"reviewsById": {"10": REVIEW}}},
    ]
    rows = cleaning.normalise_ids(cleaning.unwind_reviews(_docs(spark, tmp_path, docs))).collect()
    found = {(r["id"], r["product_id"], r["brand_name"], r["product_name"]) for r in rows}
    assert found == {(9, 11, "lg", "first"), (None, 11, "lg", "first"), (10, None, "", None)}
    assert {r["reviewerAge"] for r in rows} == {"25to34"}


def test_document_limit_counts_documents(spark, tmp_path):
    docs = [{"products": {"reviewsById": {str(i * 10 + k): REVIEW for k in range(3)}}} for i in range(5)]
    path = tmp_path / "docs.json"
    path.write_text("\n".join(json.dumps(d) for d in docs))
    limited = read_documents(spark, str(path), limit=2)
    assert cleaning.unwind_reviews(limited).count() == 6


def test_dedup_prefers_the_row_with_text(spark):
    rows = spark.createDataFrame([(1, None, "t"), (1, "good", "t"), (2, "b", "t"), (None, "n", "t"), (None, "m", "t")], "id int, text string, title string")
    kept = cleaning.clean_reviews(rows).collect()
    assert {(r["id"], r["text"]) for r in kept} == {(1, "good"), (2, "b"), (None, "m"), (None, "n")}
    first = cleaning.clean_reviews(rows, order="reference").collect()
    assert {r["id"] for r in first} == {2, None}
    with pytest.raises(ValueError):
        cleaning.clean_reviews(rows, order="other")


def test_dedup_of_a_dominant_key(spark):
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("key"), F.col("id").alias("n"))
    kept = cleaning.dedup(rows, "key", "n")
    assert kept.count() == 10_001
    assert kept.where("key = 7").first()["n"] == 1


def test_stamp_can_be_given(spark):
    at = dt.datetime(2024, 5, 1)
    assert cleaning.stamp(spark.range(1), at).first()["lastModified"] == at
    assert cleaning.stamp(spark.range(3)).select("lastModified").distinct().count() == 1


def test_union_goes_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "id int, text string")
    b = spark.createDataFrame([("y", 2)], "text string, id int")
    united = cleaning.tag_and_union({"tv": a, "phone": b})
    assert {tuple(r) for r in united.select("id", "text", "category").collect()} == {(1, "x", "tv"), (2, "y", "phone")}
    assert checks.count_conserved([a, b], united) == 2
    with pytest.raises(checks.CheckFailed):
        checks.count_conserved([a], united)


def test_attach_refuses_repeated_features(spark):
    left = spark.createDataFrame([(1,), (2,)], "id int")
    right = spark.createDataFrame([(1, "fi"), (1, "en")], "id int, language string")
    with pytest.raises(checks.CheckFailed):
        keyed.attach(left, right)
    assert keyed.attach(left, right.limit(1)).count() == 1


def test_scalar_functions(spark):
    row = spark.createDataFrame(
        [("http://h/p#top", "LG", None, 25, 10, {"a": ["x", "y"]})],
        "url string, brand string, none string, total int, per int, m map<string,array<string>>",
    ).select(
        tx.strip_fragment("url"), tx.brand_key("brand"), tx.brand_key("none"), tx.title_and_text("brand", "none"),
        tx.page_count("total", "per"), tx.page_count("total", F.lit(0)), tx.first_of_first("m"), tx.key_count("m"),
        tx.extra_page_urls("url", F.lit(3)), tx.extra_page_urls("url", F.lit(1)), tx.safe_name(F.lit("https://h/ä b?x=1")),
    ).first()
    assert list(row) == [
        "http://h/p", "lg", "", None, 3, None, "x", 1,
        ["http://h/previews?page=2", "http://h/previews?page=3"], [], "https___h_ä_b_x_1.json",
    ]


@pytest.mark.parametrize("total, per_page, pages", [(25, 10, 3), (20, 10, 2), (5, 10, 1)])
def test_page_counts(spark, total, per_page, pages):
    assert spark.range(1).select(tx.page_count(F.lit(total), F.lit(per_page))).first()[0] == pages


def test_word_tokens(spark):
    assert spark.range(1).select(tx.word_tokens(F.lit("Hyvä ääni, 4K a"))).first()[0] == ["hyvä", "ääni", "4k"]


def test_profile(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 5), ("c", None)], "k string, v int")
    assert [tuple(r) for r in profile.top(rows, "k").collect()] == [("a", 2), ("b", 1), ("c", 1)]
    assert profile.summary(rows, "v").first().asDict() == {"rows": 4, "distinct_v": 4}
    bins = {r["bin"]: r["count"] for r in profile.binned_histogram(rows, "v", 4).collect()}
    assert bins == {0: 1, 1: 1, 3: 1}
    same = profile.binned_histogram(rows.withColumn("v", F.lit(3)), "v", 10).collect()
    assert [tuple(r) for r in same] == [(5, 4)]


def test_stage_tables_are_replaced_with_their_schema(spark):
    target = settings("TEST", prefix="tbl")
    write_stage(spark.createDataFrame([(1, "a"), (2, "b")], "id int, brand_name string"), "raw", target, partition_by="brand_name")
    assert read_stage(spark, "raw", target).count() == 2
    write_stage(spark.createDataFrame([(1, 2.0)], "id int, score double"), "raw", target)
    assert read_stage(spark, "raw", target).columns == ["id", "score"]


def test_ids_that_are_no_numbers_become_rejects(spark):
    ids = ["1", "1", str(2**40), "x7", None, "x7", "-5"]
    rows = spark.createDataFrame([(i, "7", "t", "u") for i in ids], "id string, product_id string, text string, title string")
    clean = cleaning.clean_reviews(cleaning.normalise_ids(cleaning.numbered_ids(rows)))
    rejected = cleaning.rejected_ids(rows)
    assert sorted(r["id"] for r in clean.collect()) == [-5, 1, 2**40]
    assert sorted(r["reason"] for r in rejected.collect()) == ["id is no number", "id is no number", "no id"]
    copies = 1
    assert rows.count() == clean.count() + copies + rejected.count()


def test_files_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(i, "b" if i % 3 else "a") for i in range(20)], "id int, brand_name string")
    path = write_files(rows, str(tmp_path / "out"), partition_by="brand_name")
    back = spark.read.schema(rows.schema).parquet(path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
    assert back.where("brand_name = 'a'").count() == 7


def test_documents_round_trip(spark, tmp_path):
    docs = spark.createDataFrame([({"reviewsById": {"1": None}, "detailsByPid": None, "reviewsByPid": None},)] * 65, PRODUCT_DOC)
    path = write_documents(docs.coalesce(1), str(tmp_path / "docs"), batch_size=30)
    assert read_documents(spark, path).count() == 65
    assert len(list((tmp_path / "docs").glob("*.json"))) == 3


def test_named_pages(spark, tmp_path):
    rows = spark.createDataFrame([("a.json", "{1}"), ("b.json", "{2}")], "name string, json string")
    path = write_named(rows, str(tmp_path / "flat"), "name", "json")
    assert {(r["name"], r["value"]) for r in spark.read.parquet(path).collect()} == {("a.json", "{1}"), ("b.json", "{2}")}
    path = write_named(rows, str(tmp_path / "named"), "name", "json", directories=True)
    assert (tmp_path / "named" / "name=a.json").is_dir()
    assert {r["value"] for r in spark.read.text(path).collect()} == {"{1}", "{2}"}


def test_batches(spark):
    rows = spark.range(65).repartition(7).withColumnRenamed("id", "doc")
    sizes = batch_ids(rows, "doc", 30).groupBy("batch").count().orderBy("batch").collect()
    assert [r["count"] for r in sizes] == [30, 30, 5]
