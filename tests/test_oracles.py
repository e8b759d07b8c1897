import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle_check import compare, database

SQL = oracle_sql()


@pytest.fixture(scope="module")
def con(request):
    from conftest import SF_DIR

    return database(SF_DIR)


def test_names_match():
    assert set(SQL) <= set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, sf_dir, name):
    df = queries()[name](spark, sf_dir)
    if name in SQL:
        assert compare(con, df, SQL[name]) == []
    else:
        assert df.count() > 0
    spark.catalog.clearCache()


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["ride_id", "predicted_duration"] and df.count() > 0


def test_the_flagship_scores_every_trip(spark, con, sf_dir):
    for name in ("batch_score_zones", "batch_score_zones_exact"):
        got = [r.ride_id for r in queries()[name](spark, sf_dir).collect()]
        expected = [r[0] for r in con.execute(f"SELECT ride_id FROM ({SQL['batch_score']})").fetchall()]
        assert sorted(got) == sorted(expected), name
    spark.catalog.clearCache()


def test_the_search_covers_the_full_space(spark, sf_dir):
    from kerbside.operators.search import FOREST_SPACE, TRIALS

    rows = queries()["search_full"](spark, sf_dir).collect()
    trials = [r for r in rows if r.experiment == "search"]
    best = sorted((r for r in rows if r.experiment == "best"), key=lambda r: r.test_rmse)
    assert len(trials) == TRIALS and len(best) == 5 and len(rows) == TRIALS + 5
    assert all(low <= r[p] <= high for r in rows for p, (low, high, _) in FOREST_SPACE.items())
    assert max(r.max_depth for r in trials) > 6 and max(r.n_estimators for r in trials) > 10
    assert [r.alias for r in best] == ["champion", "challenger", None, None, None] and not any(r.alias for r in trials)
    spark.catalog.clearCache()
