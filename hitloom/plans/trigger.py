"""Trigger table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from hitloom.operators.calibration import to_float
from hitloom.operators.hits import VALUE_WINDOW
from hitloom.operators.triggers import trigger_chunks, trigger_table
from hitloom.plans.layout import Layout, by_layout, with_all_events
from hitloom.plans.pulses import referenced_hits
from hitloom.plans.two_sided import TDC_FACTOR
from hitloom.schema import EVENT_KEY


def trigger_plan(
    hits: DataFrame,
    trigger_map: DataFrame,
    reference_map: DataFrame,
    full: bool = False,
    factor: float = TDC_FACTOR,
    window: tuple[float, float] = VALUE_WINDOW,
    dither: str = "hash",
    layout: Layout = Layout(),
    event_key: str = EVENT_KEY,
    events: DataFrame | None = None,
    chunk: int | None = None,
) -> DataFrame:
    """Earliest trigger of every event, null where none fired; `full` adds all ids and times.

    With `chunk` the full table has a row for every `chunk` hits of an event, numbered in ``part`` from 0, and an
    event of any size is no row of its size; an event without triggers has part 0.
    """

    def plan(hits: DataFrame, spread: bool) -> DataFrame:
        df = referenced_hits(
            hits, trigger_map, reference_map, layout, spread, event_key, merge_equal=not full, window=window
        )
        df = to_float(df, "value", factor=factor, dither=dither)
        if chunk is not None and full:
            return trigger_chunks(df, chunk, spread, event_key)
        return trigger_table(df, full, event_key)

    result = by_layout(hits, events, layout, plan, event_key)
    result = with_all_events(result, hits, events, event_key)
    return result.fillna(0, ["part"]) if chunk is not None and full else result
