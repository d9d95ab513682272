"""Wire chambers: pulses of each plane per event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.operators.chunks import chunked
from hitloom.operators.events import collect_planes
from hitloom.plans.layout import Layout, by_layout, with_all_events
from hitloom.plans.pulses import calibrated_pulses
from hitloom.plans.two_sided import TDC_FACTOR
from hitloom.schema import EVENT_KEY


def wire_plan(
    hits: DataFrame,
    channel_map: DataFrame,
    reference_map: DataFrame,
    planes: Sequence[str],
    require: str | None = None,
    reference_id: int | None = None,
    factor: float = TDC_FACTOR,
    window: tuple[float, float] | None = None,
    dither: str = "hash",
    layout: Layout = Layout(),
    event_key: str = EVENT_KEY,
    events: DataFrame | None = None,
    chunk: int | None = None,
) -> DataFrame:
    """``<plane>_id, _timing, _charge`` arrays per event; events without plane `require` are dropped.

    `reference_id` uses that one reference for the whole event instead of one per module.  With `chunk` part k of
    an event, numbered in ``part``, holds the k-th `chunk` pulses of every plane, so that no row grows with the
    event where there is no value window; `require` then asks for that plane in the event's first part.
    """
    channel_map = channel_map.filter(F.col("cat").isin(list(planes)))

    def plan(hits: DataFrame, spread: bool) -> DataFrame:
        pulses = calibrated_pulses(
            hits,
            channel_map,
            reference_map,
            factor,
            window=window,
            dither=dither,
            layout=layout,
            spread=spread,
            event_key=event_key,
            reference_id=reference_id,
        )
        quantities = ["id", "timing", "charge"]
        if chunk is not None:
            lists = {p: (F.col("cat") == p, quantities) for p in planes}
            parts = chunked(pulses, lists, chunk, "cat", spread=spread, event_key=event_key)
            columns = [F.col(f"{p}.{q}").alias(f"{p}_{q}") for p in planes for q in quantities]
            return parts.select(event_key, "part", *columns)
        return collect_planes(pulses, {p: quantities for p in planes}, event_key)

    result = by_layout(hits, events, layout, plan, event_key)
    if require is not None:
        has = F.col(f"{require}_id").isNotNull()
        if chunk is None:
            return result.filter(has)
        return result.join(result.filter(has & (F.col("part") == 0)).select(event_key), event_key, "left_semi")
    result = with_all_events(result, hits, events, event_key)
    return result if chunk is None else result.fillna(0, ["part"])
