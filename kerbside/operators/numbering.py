"""Ride ids from row positions.

`source` ids use the position in the file (gaps after a filter). On single-file months they cost
nothing. `dense` ids count kept rows only.

Both avoid a global sort. Positions are split into blocks of `BLOCK` rows; the rows of a block are
numbered on their own and shifted by the number of rows in earlier blocks. A block never exceeds
`BLOCK` rows, so no task gets more, however large or uneven the months are. The shifts come from
one count per block: first summed inside each file, then over the files of a month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.functions.columns import ride_id
from kerbside.sources.trips import SOURCE_FILE, SOURCE_ROW

BLOCK = 1 << 17
# The rows that are numbered together: months of two colours are different files.
MONTH = ("color", "year", "month")
# Offsets are one row per file. Up to this many (some 20 MB of paths) go to every executor, so the
# trips stay where they were read.
MAX_BROADCAST_FILES = 100_000


def source_ride_ids(trips: DataFrame, all_trips: DataFrame | None = None) -> DataFrame:
    """Id from the position of the row in its month, counted before any filter.

    For a single file this is a projection. For months of several files pass the unfiltered scan as
    `all_trips`: the count then continues from file to file, in name order.
    """
    files = (trips if all_trips is None else all_trips).inputFiles()
    if all_trips is None and len(files) > 1:
        raise ValueError("positions restart in every file: pass the unfiltered scan as all_trips")
    if len(files) <= 1:
        return trips.withColumn("ride_id", ride_id("year", "month", SOURCE_ROW))
    offsets = _file_offsets(all_trips.groupBy(*MONTH, SOURCE_FILE).agg(F.count(F.lit(1)).alias("rows")))
    if len(files) <= MAX_BROADCAST_FILES:
        offsets = F.broadcast(offsets)
    position = F.col("file_offset") + F.col(SOURCE_ROW)
    joined = trips.join(offsets, [*MONTH, SOURCE_FILE])
    return joined.withColumn("ride_id", ride_id("year", "month", position)).drop("file_offset")


def dense_ride_ids(kept: DataFrame, block: int = BLOCK) -> DataFrame:
    """Id from the position among the kept rows of the month (0, 1, 2, ... without gaps)."""
    blocked = kept.withColumn("_block", F.floor(F.col(SOURCE_ROW) / F.lit(block)))
    key = [*MONTH, SOURCE_FILE, "_block"]

    # Reads only what the filter and the key need. One row per block.
    counts = blocked.groupBy(*key).agg(F.count(F.lit(1)).alias("rows"))
    in_file = Window.partitionBy(*MONTH, SOURCE_FILE).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    block_offsets = counts.withColumn("block_offset", F.coalesce(F.sum("rows").over(in_file), F.lit(0)))
    file_offsets = _file_offsets(counts.groupBy(*MONTH, SOURCE_FILE).agg(F.sum("rows").alias("rows")))
    offsets = block_offsets.join(file_offsets, [*MONTH, SOURCE_FILE]).select(
        *key, (F.col("block_offset") + F.col("file_offset")).alias("offset")
    )

    in_block = Window.partitionBy(*key).orderBy(SOURCE_ROW)
    numbered = blocked.withColumn("_rank", F.row_number().over(in_block) - 1)
    # The offsets join on the window's own key: broadcast while small, else already co-located.
    placed = numbered.join(offsets, key)
    position = F.col("offset") + F.col("_rank")
    return placed.withColumn("ride_id", ride_id("year", "month", position)).drop("_block", "_rank", "offset")


def _file_offsets(file_rows: DataFrame) -> DataFrame:
    """Rows in earlier files of the month. One row per file, which Spark lists on the driver anyway."""
    earlier = Window.partitionBy(*MONTH).orderBy(SOURCE_FILE).rowsBetween(Window.unboundedPreceding, -1)
    return file_rows.select(
        *MONTH, SOURCE_FILE, F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("file_offset")
    )
