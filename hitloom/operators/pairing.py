"""Leading and trailing edges to pulses: an as-of match without a join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitloom.schema import EVENT_KEY


def _usable(df: DataFrame, channel: list[str]) -> DataFrame:
    known = F.col("edge").isin(0, 1) & F.col("value").isNotNull()
    for name in channel:
        known = known & F.col(name).isNotNull()
    return df.filter(known)


def _pulses(closed: DataFrame, channel: list[str], leads: Column) -> DataFrame:
    return closed.filter(leads & F.col("_end").isNotNull()).select(
        *channel, (F.col("_end") - F.col("value")).alias("charge"), F.col("value").alias("timing")
    )


def pair_gathered(df: DataFrame, event_key: str = EVENT_KEY) -> DataFrame:
    """:func:`pair_edges` for hits that lie together by event, none of them too many for a task.

    One sort and one sweep per channel; only the pulses found are then made unique.
    """
    channel = [event_key, "cat", "id"]
    # Latest first, so the frame only grows and Spark sweeps it once.  At equal times the leading
    # edge comes first and does not see the trailing one.
    later = Window.partitionBy(*channel).orderBy(F.desc("value"), F.asc("edge"))
    trailing = F.when(F.col("edge") == 1, F.col("value"))
    swept = later.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    closed = _usable(df, channel).withColumn("_end", F.min(trailing).over(swept))
    return _pulses(closed, channel, F.col("edge") == 0).distinct()


def pair_edges(df: DataFrame, event_key: str = EVENT_KEY, cell: int | None = None) -> DataFrame:
    """Pulse of each leading edge: ``timing`` and the distance to the nearest later trailing edge.

    Channel by channel, ``charge`` is the smallest ``trailing - leading > 0``.  A leading edge with no
    later trailing edge gives no pulse, equal leading edges give one, and one trailing edge may close
    several pulses.

    Equal hits are merged before anything is gathered, so a channel has no more rows than there are
    distinct values: after :func:`~hitloom.operators.validate` at most ``high - low - 1``, however
    many hits were taken.  Without such a window, `cell` cuts the time axis into cells of that width
    and searches first within the cell, then over the cells, so that no task sees a whole channel.
    """
    channel = [event_key, "cat", "id"]
    edges = _usable(df, channel).groupBy(*channel, "value").agg(
        F.max(F.col("edge") == 0).alias("leads"), F.max(F.col("edge") == 1).alias("trails")
    )
    trailing = F.when(F.col("trails"), F.col("value"))
    before = (Window.unboundedPreceding, -1)

    if cell is None:
        later = Window.partitionBy(*channel).orderBy(F.desc("value")).rowsBetween(*before)
        closed = edges.withColumn("_end", F.min(trailing).over(later))
        return _pulses(closed, channel, F.col("leads"))

    edges = edges.withColumn("_cell", F.floor(F.col("value") / cell))
    within = Window.partitionBy(*channel, "_cell").orderBy(F.desc("value")).rowsBetween(*before)
    following = Window.partitionBy(*channel).orderBy(F.desc("_cell")).rowsBetween(*before)
    cells = (
        edges.groupBy(*channel, "_cell")
        .agg(F.min(trailing).alias("_first"))
        .withColumn("_next", F.min("_first").over(following))
        .select(*channel, "_cell", "_next")
    )
    closed = (
        edges.withColumn("_here", F.min(trailing).over(within))
        .filter(F.col("leads"))
        .join(cells, [*channel, "_cell"])
        .withColumn("_end", F.coalesce("_here", "_next"))
    )
    return _pulses(closed, channel, F.col("leads"))
