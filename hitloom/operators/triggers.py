"""Which trigger fired first in an event."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.operators.chunks import chunked
from hitloom.schema import EVENT_KEY


def trigger_table(hits: DataFrame, full: bool = False, event_key: str = EVENT_KEY) -> DataFrame:
    """``trig``: the id of the earliest trigger hit (smallest id at equal times) per event.

    The short form is a running minimum and keeps no list; the full form adds all ids and times in
    the same order.
    """
    by_event = hits.groupBy(event_key)
    if not full:
        first = F.min(F.struct("value", "id"))
        return by_event.agg(first.alias("_first")).select(event_key, F.col("_first.id").alias("trig"))
    ordered = F.sort_array(F.collect_list(F.struct("value", "id")))
    lists = by_event.agg(ordered.alias("_hits"))
    return lists.select(
        event_key,
        F.col("_hits.id").alias("trig_id"),
        F.col("_hits.value").alias("trig_timing"),
        F.get("_hits.id", F.lit(0)).alias("trig"),
    )


def trigger_chunks(hits: DataFrame, size: int, spread: bool = False, event_key: str = EVENT_KEY) -> DataFrame:
    """The full form of :func:`trigger_table` in rows of at most `size` hits, numbered in ``part``."""
    lists = {"_hits": (F.lit(True), ["id", "value"])}
    parts = chunked(hits, lists, size, order=["value", "id"], spread=spread, event_key=event_key)
    # The earliest trigger stands first in part 0, so the hits are not made again for it.
    first = parts.filter(F.col("part") == 0).select(F.col(event_key).alias("_event"), F.get("_hits.id", F.lit(0)).alias("trig"))
    joined = parts.join(first, parts[event_key].eqNullSafe(first["_event"]))
    return joined.select(
        event_key, "part", F.col("_hits.id").alias("trig_id"), F.col("_hits.value").alias("trig_timing"), "trig"
    )
