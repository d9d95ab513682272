"""Back to one row per event."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.schema import EVENT_KEY


def distinct_events(df: DataFrame, event_key: str = EVENT_KEY) -> DataFrame:
    """Each event once; merged before the shuffle, so a large event costs one row per task."""
    return df.select(event_key).distinct()


def pulse_list(condition: Column | None = None) -> Column:
    """Aggregate collecting pulses ordered by time, then id, then charge; empty gives null.

    One sorted list of structs keeps the arrays made from it aligned and repeatable.
    """
    pulse = F.struct("timing", "id", "charge")
    pulses = F.collect_list(pulse if condition is None else F.when(condition, pulse))
    return F.when(F.size(pulses) > 0, F.sort_array(pulses))


def collect_planes(
    pulses: DataFrame,
    planes: Mapping[str, Sequence[str]],
    event_key: str = EVENT_KEY,
) -> DataFrame:
    """Arrays ``<plane>_<quantity>`` per event for each plane (category) and its quantities.

    One aggregation serves all planes; a plane without pulses is null.  After pairing, an array has
    at most one entry per channel of the plane and value of the validated window.
    """
    lists = pulses.groupBy(event_key).agg(
        *[pulse_list(F.col("cat") == plane).alias(plane) for plane in planes]
    )
    present = [F.col(plane).isNotNull() for plane in planes]
    some = present[0]
    for condition in present[1:]:
        some = some | condition
    return lists.filter(some).select(
        event_key,
        *[
            F.col(plane)[quantity].alias(f"{plane}_{quantity}")
            for plane, quantities in planes.items()
            for quantity in quantities
        ],
    )


def assemble(
    events: DataFrame,
    parts: Mapping[str, DataFrame],
    require: str | None = None,
    event_key: str = EVENT_KEY,
) -> DataFrame:
    """All events with the columns of each part; events missing in the part `require` are dropped."""
    result = distinct_events(events, event_key)
    for name, part in parts.items():
        result = result.join(part, event_key, "inner" if name == require else "left")
    return result
