import pytest

from kerbside import session


class Fake:
    """Just enough of a session to ask where shared files go."""

    def __init__(self, folder, master):
        self.conf = self
        self.sparkContext = self
        self.folder, self.master = folder, master

    def get(self, key, default):
        return self.folder if key == "spark.checkpoint.dir" else default


def test_shared_folder_comes_from_the_cluster():
    assert session.shared_root(Fake("hdfs://x/y/", "yarn")) == "hdfs://x/y"
    assert session.new_folder(Fake("hdfs://x/y", "yarn"), "runs").startswith("hdfs://x/y/runs-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(Fake("", "yarn"))


def test_local_sessions_fall_back_to_a_temp_folder():
    assert session.shared_root(Fake("", "local[2]")) == session.shared_root(Fake("", "local[2]"))


@pytest.mark.parametrize("name", ["forest_predictions", "gbt_score", "rmse_by_split", "batch_score_zones", "ols_pair_distance", "ols_group_mean", "ols_orthogonality", "pair_rmse_by_split", "alias_score"])
def test_queries_leave_no_cached_table(spark, sf_dir, name):
    from kerbside.plans.catalog import QUERIES

    spark.catalog.clearCache()
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    QUERIES[name](spark, sf_dir).collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held
