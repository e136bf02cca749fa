"""Every query with a SQL twin gives the twin's rows; the others run and keep their schema."""

import inspect

import duckdb
import pytest

import __spark_entry__ as entry
import check_oracle
from workload import queries

SLOW = {"gbt_scores", "random_search", "windowed_training"}  # covered on small data in test_modeling.py and below


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in check_oracle.TABLES:
        connection.execute(f"create view {t} as select * from '/root/testdata/sf0.001/{t}.parquet'")
    return connection


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - SLOW))
def test_query(spark, con, sf, name):
    line = check_oracle.compare(spark, con, name, sf)
    assert line.startswith(("ok", "rows")), line


def test_every_month_asked_for_has_a_snapshot(spark, sf, monkeypatch):
    """score_and_monitor asks for the twelve months of 1998 and trains a snapshot for each of them."""
    trained = []
    monkeypatch.setattr(queries.training, "train_snapshot", lambda *args, **_: trained.append(str(args[4])))
    monkeypatch.setattr(queries.training, "list_artifacts", lambda *_: None)
    monkeypatch.setattr(queries.monitoring, "infer", lambda spark, clk, base, artifacts, models, months, *_: months)
    asked = sorted(str(r.snapshot_date) for r in queries.QUERIES["score_and_monitor"](spark, sf).collect())
    assert asked == trained == [f"1998-{m:02}-01" for m in range(1, 13)]


@pytest.mark.parametrize("name", ["random_search", "windowed_training"])
def test_searches_take_the_whole_budget(spark, sf, monkeypatch, name):
    """100 different points for boosted trees, each cross-validated in three folds, over all rows."""
    asked = []

    class Stop(Exception):
        pass

    def candidates(space, n, seed, draw=queries.M.search_candidates):
        asked.append(draw(space, n, seed))
        raise Stop

    monkeypatch.setattr(queries.M, "search_candidates", candidates)
    with pytest.raises(Stop):
        queries.QUERIES[name](spark, sf)
    points = [tuple(sorted(p.items())) for p in asked[0]]
    assert len(points) == len(set(points)) == 100
    defaults = {k: v.default for k, v in inspect.signature(queries.M.random_search).parameters.items()}
    assert defaults["folds"] == 3 and defaults["estimator"] is None and defaults["max_rows"] is None


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "fe_20" in df.columns
