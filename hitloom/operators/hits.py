"""From nested events to mapped hits.  Nothing in this module shuffles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.functions import flipped_edge, in_open_window
from hitloom.schema import CHANNEL_KEY, EVENT_KEY
from hitloom.sizing import broadcast_if_small

MAPPED = ["cat", "value", "id"]

# Window applied to reference-subtracted values before pairing; fixed value.
VALUE_WINDOW = (-100000, 100000)


def explode_hits(
    events: DataFrame, event_key: str = EVENT_KEY, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per hit of nested events.

    `keep` adds event columns or the segment's ``mod``.  Events without hits give no row.
    """
    event_columns = [c for c in keep if c != "mod"]
    segment_columns = ["dev", "fp", "mod", "det"] if "mod" in keep else ["dev", "fp", "det"]
    carried = list(dict.fromkeys([event_key, *event_columns]))
    # Zipping the wanted fields lets the scan leave out the others.
    segment = F.arrays_zip(*[f"segdata.{c}" for c in [*segment_columns, "hits"]])
    segments = events.select(*carried, F.explode(segment).alias("segment"))
    hits = segments.select(
        *carried,
        *[F.col(f"segment.{c}").alias(c) for c in segment_columns],
        F.explode("segment.hits").alias("hit"),
    )
    return hits.select(
        *carried,
        *segment_columns,
        *[F.col(f"hit.{c}").alias(c) for c in ("geo", "ch", "value", "edge")],
    )


def map_channels(
    hits: DataFrame,
    channel_map: DataFrame,
    columns: Sequence[str] | None = None,
    event_key: str = EVENT_KEY,
) -> DataFrame:
    """Name the detector element of each hit; hits of unmapped channels drop out."""
    named = hits.join(broadcast_if_small(channel_map), CHANNEL_KEY)
    return named.select(*(columns or [event_key, *MAPPED]))


def validate(
    df: DataFrame, window: tuple[float, float] = VALUE_WINDOW, column: str = "value"
) -> DataFrame:
    """Rows strictly inside the window."""
    return df.filter(in_open_window(F.col(column), *window))


def flip_edges(df: DataFrame, keep_suffix: str = "a") -> DataFrame:
    """Swap the edges of categories whose trailing edge comes first."""
    return df.withColumn("edge", flipped_edge(F.col("cat"), F.col("edge"), keep_suffix))
