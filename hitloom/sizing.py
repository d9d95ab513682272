"""Size checks that decide how a plan is laid out.

Nothing here changes a result: the checks only choose between two exact physical layouts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.schema import HIT_COUNT
from hitloom.storage import work_folder

# A dimension row (channel, curve cell, geometry) is about 100 bytes, so the bound keeps a broadcast
# below some 20 MB whatever happens to the data.
BROADCAST_ROWS = 200_000

# An event with more hits than this is not left to one task.
HOT_EVENT_ROWS = 2_000_000

# Cells of the sketch that finds keys with many rows: 16 bytes each from a task.
SKETCH_CELLS = 1 << 16


def fits(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether `df` has at most `rows` rows; counting stops at ``rows + 1``."""
    return df.limit(rows + 1).count() <= rows


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting that `df` stays within `rows`.

    A larger table comes back without the hint and is joined by a shuffle, where adaptive execution
    splits skewed partitions.
    """
    return F.broadcast(df) if fits(df, rows) else df


def hot_keys(df: DataFrame, key: str, rows: int) -> DataFrame | None:
    """Keys holding more than `rows` rows, or so many hits where `df` has their number; None if there are none.

    Keys are dealt to `SKETCH_CELLS` cells by a hash and only the cells are counted, so that a task passes on a
    bounded number of rows however many keys there are.  A key has no more rows than its cell, so none above the
    bound is missed; the keys of heavy cells, which are few as long as cells hold fewer than `rows` rows on
    average, are then counted exactly.  Null is no key.
    """
    n = F.sum(HIT_COUNT) if HIT_COUNT in df.columns else F.count(F.lit(1))
    placed = df.filter(F.col(key).isNotNull()).withColumn("_cell", F.pmod(F.xxhash64(key), F.lit(SKETCH_CELLS)))
    cells = placed.groupBy("_cell").agg(n.alias("n")).filter(F.col("n") > rows)
    heavy = cells.select("_cell").collect()  # at most SKETCH_CELLS numbers
    if not heavy:
        return None
    heavy_cells = df.sparkSession.createDataFrame(heavy, "_cell long")
    counts = placed.join(F.broadcast(heavy_cells), "_cell").groupBy(key).agg(n.alias("n"))
    path = work_folder(df.sparkSession, "hot")
    counts.filter(F.col("n") > rows).select(key).write.parquet(path)
    hot = df.sparkSession.read.parquet(path)
    return None if hot.isEmpty() else hot


def split_hot(df: DataFrame, key: str, hot: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    """Split `df` in (ordinary rows, rows of `hot` keys); the second part is None when none is hot.

    Null keys stay with the ordinary rows.
    """
    if hot is None:
        return df, None
    hot = broadcast_if_small(hot)
    return df.join(hot, key, "left_anti"), df.join(hot, key, "left_semi")
