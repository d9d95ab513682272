"""One batch run: raw events in, one result table out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hitloom.operators.hits import explode_hits
from hitloom.plans.layout import Layout
from hitloom.schema import EVENT_KEY
from hitloom.sinks import write_events
from hitloom.sizing import HOT_EVENT_ROWS
from hitloom.sources import Paths, read_events, read_hit_keys


def run_batch(
    spark: SparkSession,
    paths: Paths,
    name: str,
    kind: str,
    plan: Callable[[DataFrame, Layout, DataFrame], DataFrame],
    partitions: int | None = None,
    hot_rows: int = HOT_EVENT_ROWS,
    event_key: str = EVENT_KEY,
) -> str:
    """Run `plan` over the hits of the stored events `name`; returns the path written.

    `kind` becomes the suffix of the result, `partitions` the number of parts the hits are laid out
    in by event.  `plan` takes hits, layout and event keys, as in ``lambda hits, layout, events:
    strip_plan(hits, maps, refs, curves, layout=layout, events=events)``.
    """
    source, target = paths.events(name), paths.result(name, kind)
    keys = read_hit_keys(spark, source, event_key)
    layout = Layout(partitions=partitions, hot_rows=hot_rows)
    hits = explode_hits(read_events(spark, source), event_key)
    write_events(plan(hits, layout, keys), target)
    return target
