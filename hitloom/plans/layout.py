"""How a plan lays its hits out over the cluster.

Ordinary events are brought together by one shuffle on the event key; windows, pairings and
aggregations then run without another.  Events too large for one task take the same operators without
that shuffle, so that each step spreads them by its own finer key.  Both give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from hitloom.operators.events import distinct_events
from hitloom.schema import EVENT_KEY
from hitloom.sizing import HOT_EVENT_ROWS, hot_keys, split_hot


@dataclass(frozen=True)
class Layout:
    """`partitions`: number of shuffle partitions of the hits, the session's default if None.
    `clustered`: the input is a table bucketed by event, so the shuffle is left out.
    `hot_rows`: an event with more hits is spread; None skips the check where the source is known to
    have no such event."""

    partitions: int | None = None
    clustered: bool = False
    hot_rows: int | None = HOT_EVENT_ROWS

    def gather(self, df: DataFrame, event_key: str = EVENT_KEY) -> DataFrame:
        """`df` with each event in one partition."""
        if self.clustered:
            return df
        if self.partitions is None:
            return df.repartition(event_key)
        return df.repartition(self.partitions, event_key)


def by_layout(
    hits: DataFrame,
    events: DataFrame | None,
    layout: Layout,
    plan: Callable[[DataFrame, bool], DataFrame],
    event_key: str = EVENT_KEY,
) -> DataFrame:
    """``plan(hits, spread)`` for the ordinary events and, if there are any, for the hot ones.

    Hits per event are counted in `events`, a narrow table of event keys
    (:func:`~hitloom.sources.read_hit_keys`), where there is one, and else in the hits.
    """
    if layout.hot_rows is None:
        return plan(hits, False)
    keys = hot_keys(hits if events is None else events, event_key, layout.hot_rows)
    ordinary, hot = split_hot(hits, event_key, keys)
    result = plan(ordinary, False)
    return result if hot is None else result.unionByName(plan(hot, True))


def with_all_events(
    result: DataFrame, hits: DataFrame, events: DataFrame | None, event_key: str = EVENT_KEY
) -> DataFrame:
    """`result` with a row for each event that has hits; `events` saves a scan of the hits for it."""
    every = distinct_events(hits if events is None else events, event_key)
    return every.join(result, event_key, "left")
