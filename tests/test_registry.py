from datetime import datetime

import pytest

from kerbside.operators import registry as r


@pytest.fixture
def runs(spark, tmp_path):
    path = f"{tmp_path}/runs"
    for i, (rmse, status) in enumerate([(3.0, "active"), (1.0, "deleted"), (2.0, "active"), (2.0, "active"), (None, "active")]):
        metrics = {} if rmse is None else {"rmse": rmse, "test_rmse": 10 - rmse}
        r.log_run(spark, path, "a", "LR", {"depth": i, "x": "y"}, metrics, {"developer": "d"}, f"r{i}", status)
    r.log_run(spark, path, "b", "LR", run_id="other")
    return r.read_runs(spark, path)


def test_runs_are_appended_with_text_params(runs):
    assert runs.count() == 6
    row = runs.filter("run_id = 'r2'").first()
    assert row.params == {"depth": "2", "x": "y"} and row.metrics["rmse"] == 2.0 and row.tags == {"developer": "d"}


def test_leaderboard(runs):
    assert [x.run_id for x in r.active_runs(runs, "a").orderBy("run_id").collect()] == ["r0", "r2", "r3", "r4"]
    assert [(x.run_id, x.rmse) for x in r.leaderboard(runs, "a", 3).collect()] == [("r2", 2.0), ("r3", 2.0), ("r0", 3.0)]
    assert [x.run_id for x in r.top_runs(runs, "a", 9).collect()][-1] == "r4"
    assert "TakeOrderedAndProject" in r.top_runs(runs, "a", 3)._jdf.queryExecution().executedPlan().toString()


def test_candidates(runs):
    found = {x.alias: (x.run_id, x.validation_status) for x in r.candidates(runs.filter("experiment = 'a'")).collect()}
    assert found == {"champion": ("r0", "approved"), "challenger": ("r2", "pending")}


def test_report(runs):
    report = r.run_report(runs.filter("run_id = 'r0'")).collect()
    assert {(x.kind, x.name, x.value) for x in report} == {
        ("params", "depth", "0"), ("params", "x", "y"), ("metrics", "rmse", "3.0"), ("metrics", "test_rmse", "7.0"),
    }


def test_aliases_move_and_copy(spark, tmp_path):
    path = f"{tmp_path}/aliases"
    r.set_alias(spark, path, "m", "champion", "r1", "approved", datetime(2024, 1, 1))
    r.set_alias(spark, path, "m", "challenger", "r2", "pending", datetime(2024, 1, 1))
    r.set_alias(spark, path, "m", "champion", "r3", "approved", datetime(2024, 1, 2))
    known = r.read_aliases(spark, path)
    assert r.run_by_alias(known, "m", "champion") == "r3" and r.run_by_alias(known, "m", "challenger") == "r2"
    r.set_aliases(r.copy_alias(known, "m", "champion", "prod", "current", datetime(2024, 1, 3)), path)
    known = r.read_aliases(spark, path)
    assert r.run_by_alias(known, "prod", "current") == "r3"
    # Moving the source's alias later does not move the copy.
    r.set_alias(spark, path, "m", "champion", "r4", "approved", datetime(2024, 1, 4))
    known = r.read_aliases(spark, path)
    assert r.run_by_alias(known, "prod", "current") == "r3" and r.run_by_alias(known, "m", "champion") == "r4"
    assert r.current_aliases(known).count() == 3
    with pytest.raises(LookupError):
        r.run_by_alias(known, "m", "nobody")
