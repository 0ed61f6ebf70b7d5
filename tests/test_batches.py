"""Folders of document batches: round trips, pruned files, and writes that appear whole or not at all."""

import json
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reviewlake.sources import batches


def _files(path):
    return {r["file"] for r in batches.scan_batches(SESSION[0], path).select("file").distinct().collect()}


SESSION = []


@pytest.fixture(scope="module", autouse=True)
def session(spark):
    SESSION.append(spark)


@pytest.fixture
def stored(spark, tmp_path):
    rows = [(i, None if i % 9 == 0 else f"line\nbreak   é {i}") for i in range(100)]
    df = spark.createDataFrame(rows, "id long, text string").repartition(3)
    return rows, batches.write_batches(df, str(tmp_path / "docs"))


def test_round_trip_in_batches(spark, stored):
    rows, path = stored
    back = batches.read_batches(spark, path, "id long, text string")
    assert sorted(map(tuple, back.collect())) == sorted(rows, key=lambda r: r[0])
    sizes = Counter(r["file"] for r in batches.scan_batches(spark, path).collect())
    assert sum(sizes.values()) == 100 and max(sizes.values()) == 30 and sum(n < 30 for n in sizes.values()) <= 3


def test_filters_and_limits_choose_files(spark, stored):
    rows, path = stored
    wanted = sorted(_files(path))[0]
    whole = batches.scan_batches(spark, path).where(F.col("file") == wanted).count()
    text = batches.scan_batches(spark, path).where(F.contains("value", F.lit("é 41")))
    assert [json.loads(r["value"])["id"] for r in text.collect()] == [41]
    order = [name for listed in json.load(open(f"{path}/_lists.json")) for name, _ in json.load(open(f"{path}/{listed}"))]
    for name in set(order) - {wanted, order[0]}:
        os.remove(f"{path}/{name}")
    assert batches.scan_batches(spark, path).where(F.col("file").isin(wanted, "other")).count() == whole
    assert batches.scan_batches(spark, path, limit=7).count() == 7
    with pytest.raises(Exception):
        batches.scan_batches(spark, path).count()


def test_overwrite_append_and_empty(spark, stored):
    rows, path = stored
    old = _files(path)
    more = spark.createDataFrame([(7, "x")], "id long, text string")
    batches.write_batches(more, path, append=True)
    assert batches.scan_batches(spark, path).count() == 101 and _files(path) > old
    batches.write_batches(more, path)
    assert batches.scan_batches(spark, path).count() == 1 and not any(os.path.exists(f"{path}/{name}") for name in old)
    batches.write_batches(more.limit(0), path)
    assert batches.read_batches(spark, path, "id long").count() == 0


def test_failed_task_leaves_no_batch(spark, stored):
    rows, path = stored
    broken = spark.range(200).repartition(4).select("id", F.when(F.col("id") == 150, F.raise_error(F.lit("no"))).otherwise("t").alias("text"))
    before = sorted(os.listdir(path))
    with pytest.raises(Exception):
        batches.write_batches(broken, path, append=True)
    assert Counter(map(tuple, batches.read_batches(spark, path, "id long, text string").collect())) == Counter(rows)
    assert set(before) <= set(os.listdir(path))
