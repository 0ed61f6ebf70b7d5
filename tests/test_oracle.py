"""Every registered query against its SQL, over whole tables."""

import pytest
from compare import differences, duck

import __spark_entry__ as entry_points

QUERIES = entry_points.queries()
ORACLES = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), ORACLES[name], con) is None


def test_entry(spark):
    rows = entry_points.entry(spark)
    assert rows.columns == ["language", "rank", "term", "score"]
    assert rows.count() == 40


def test_forest_search_reports_every_trial(spark, sf_dir):
    rows = QUERIES["search_run"](spark, sf_dir).collect()
    assert sorted(r["trial_id"] for r in rows) == [0, 1, 2] and all(r["scored"] for r in rows)
