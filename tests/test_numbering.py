import pytest
from pyspark.sql import functions as F

from kerbside.operators.numbering import dense_ride_ids, source_ride_ids
from kerbside.sources.trips import with_position


@pytest.fixture
def month_files(spark, tmp_path):
    """Two months, the first of three files, with a keep flag that leaves gaps at both ends."""
    expected = []
    for month, sizes in ((1, (700, 3, 250)), (2, (400,))):
        position = dense = 0
        for i, size in enumerate(sizes):
            rows = []
            for r in range(size):
                keep = (r * 7 + i) % 3 != 0
                rows.append(("green", 2023, month, keep, f"2023/{month:02d}_{position}", f"2023/{month:02d}_{dense}"))
                position += 1
                dense += keep
            schema = "color STRING, year INT, month INT, keep BOOLEAN, by_source STRING, by_rank STRING"
            spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/m{month}/{i}.parquet")
            expected += rows
    return with_position(spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path))), expected


def test_source_ids_continue_over_files(month_files):
    table, expected = month_files
    kept = table.filter("keep")
    done = source_ride_ids(kept, table)
    assert done.filter("ride_id != by_source").count() == 0
    assert done.count() == sum(r[3] for r in expected)


def test_positions_in_several_files_need_the_scan(month_files):
    with pytest.raises(ValueError, match="all_trips"):
        source_ride_ids(month_files[0])


def test_source_ids_of_single_files_need_no_shuffle(spark, month_files, tmp_path):
    done = source_ride_ids(with_position(spark.read.parquet(f"{tmp_path}/m2/0.parquet")).filter("keep"))
    assert done.filter("ride_id != by_source").count() == 0
    assert "Exchange" not in done._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("block", [1, 7, 100, 1 << 20])
def test_dense_ids(month_files, block):
    table, expected = month_files
    done = dense_ride_ids(table.filter("keep"), block)
    assert done.filter("ride_id != by_rank").count() == 0
    assert done.select(F.countDistinct("ride_id")).first()[0] == sum(r[3] for r in expected)
