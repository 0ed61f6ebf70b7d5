import pytest
from pyspark.sql import functions as F

from reviewlake.operators import balance, evaluate, search


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(399).select("id", F.when(F.col("id") < 58, 0).otherwise(1).alias("label"))


def test_class_weights(rows):
    got = {r["label"]: r["weight"] for r in balance.class_weights(rows, "label").collect()}
    assert got == {0: pytest.approx(399 / (2 * 58)), 1: pytest.approx(399 / (2 * 341))}
    total = balance.attach_weights(rows, "label").agg(F.sum("weight")).first()[0]
    assert total == pytest.approx(399)


def _sizes(df):
    return {r["label"]: (r["n"], r["m"]) for r in df.groupBy("label").agg(F.count("*").alias("n"), F.sum("multiplicity").alias("m")).collect()}


@pytest.mark.parametrize(
    "strategy, want",
    [("all", {0: 58, 1: 58}), ("majority", {0: 58, 1: 58}), ("not minority", {0: 58, 1: 58}), ("not majority", {0: 58, 1: 341})],
)
@pytest.mark.parametrize("replacement", [False, True])
def test_strategies(rows, strategy, want, replacement):
    sample = balance.undersample(rows, "label", "id", strategy, replacement)
    sizes = _sizes(sample)
    assert {k: m for k, (_, m) in sizes.items()} == want
    if not replacement:
        assert {k: n for k, (n, _) in sizes.items()} == want
    assert sample.groupBy("id").count().where("count > 1").count() == 0


def test_replacement_draws_some_rows_twice(rows):
    sample = balance.undersample(rows, "label", "id", "all", True, seed=3)
    assert sample.where("multiplicity > 1").count() > 0
    again = balance.undersample(rows.repartition(5), "label", "id", "all", True, seed=3)
    assert sorted(map(tuple, sample.collect())) == sorted(map(tuple, again.collect()))
    with pytest.raises(ValueError):
        balance.undersample(rows, "label", "id", "some")


def test_three_classes(spark):
    rows = spark.range(600).select("id", F.when(F.col("id") < 60, "a").when(F.col("id") < 200, "b").otherwise("c").alias("label"))
    sizes = lambda s: {k: m for k, (_, m) in _sizes(balance.undersample(rows, "label", "id", s)).items()}
    assert sizes("majority") == {"a": 60, "b": 140, "c": 60}
    assert sizes("not minority") == {"a": 60, "b": 60, "c": 60}
    assert sizes("not majority") == {"a": 60, "b": 60, "c": 400}


def test_confusion_shows_zero_cells(spark):
    rows = spark.createDataFrame([(0, 1), (1, 1), (1, 1)], "actual int, predicted int")
    assert sorted(map(tuple, evaluate.confusion(rows).collect())) == [(0, 0, 0), (0, 1, 1), (1, 0, 0), (1, 1, 2)]
    assert evaluate.accuracy(rows).first()[0] == pytest.approx(2 / 3)
    assert evaluate.guarded_accuracy(rows).first()[0] == 0.0
    mixed = rows.unionByName(spark.createDataFrame([(0, 0)], rows.schema))
    assert evaluate.guarded_accuracy(mixed).first()[0] == pytest.approx(0.75)
    assert evaluate.compare({"a": rows, "b": mixed}).where("model = 'b' and count > 0").count() == 3


def test_trials(spark):
    trials = search.random_trials(spark, 200, seed=1)
    assert sorted(map(tuple, trials.collect())) == sorted(map(tuple, search.random_trials(spark, 200, seed=1).collect()))
    for name, values in search.SPACE.items():
        found = {r[0] for r in trials.select(name).distinct().collect()}
        assert found <= set(values) and len(found) > 1
    grid = search.grid(spark, {"a": [1, 2], "b": ["x", "y", "z"]})
    assert grid.select("a", "b").distinct().count() == grid.count() == 6
    scored = search.evaluate(grid, lambda p: p["a"] * (p["b"] == "y"), parallelism=2)
    assert search.best(scored).first()["a"] == 2
    assert search.best(scored, maximise=False).first()["trial_id"] == 0
