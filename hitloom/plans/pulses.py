"""The common front of the detector plans: hits to calibrated pulses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.operators.calibration import to_float
from hitloom.operators.hits import VALUE_WINDOW, flip_edges
from hitloom.operators.pairing import pair_edges, pair_gathered
from hitloom.operators.reference import subtract_reference, subtract_tagged, tag_channels
from hitloom.plans.layout import Layout
from hitloom.schema import EVENT_KEY, MODULE_KEY

# Join keys per event and module when a hot event is spread.
HOT_SALT = 64
# Cell of the time axis when a hot event is paired without a value window.
HOT_CELL = 65536


def referenced_hits(
    hits: DataFrame,
    channel_map: DataFrame,
    reference_map: DataFrame,
    layout: Layout,
    spread: bool,
    event_key: str = EVENT_KEY,
    reference_id: int | None = None,
    first_reference: bool = False,
    merge_equal: bool = True,
    window: tuple[float, float] | None = None,
) -> DataFrame:
    """``event, cat, id, value, edge`` of mapped hits with the time reference subtracted.

    `reference_id` takes that one reference for all modules of an event.  `merge_equal` says that
    repeated rows do not count, so equal references and, in a hot event, equal hits are merged.  With `window`
    only values strictly inside it are made.
    """
    match: Sequence[str] = MODULE_KEY
    if reference_id is not None:
        reference_map = reference_map.filter(F.col("id") == reference_id)
        match = []
    tagged = tag_channels(hits, channel_map, reference_map, event_key)
    if not spread:
        gathered = layout.gather(tagged, event_key)
        return subtract_tagged(gathered, event_key, match, first_reference, merge_equal, window)
    mapped = tagged.filter(~F.col("is_reference")).drop("is_reference")
    references = tagged.filter(F.col("is_reference")).select(event_key, *MODULE_KEY, "value")
    if merge_equal:
        mapped, references = mapped.distinct(), references.distinct()
    return subtract_reference(
        mapped, references, event_key, match, first_reference, HOT_SALT, window
    ).select(event_key, "cat", "id", "value", "edge")


def calibrated_pulses(
    hits: DataFrame,
    channel_map: DataFrame,
    reference_map: DataFrame,
    factor: float,
    flip: bool = False,
    window: tuple[float, float] | None = VALUE_WINDOW,
    dither: str = "hash",
    layout: Layout = Layout(),
    spread: bool = False,
    event_key: str = EVENT_KEY,
    reference_id: int | None = None,
    first_reference: bool = False,
) -> DataFrame:
    """``event, cat, id, charge, timing``: subtract, validate, flip, pair and scale."""
    if dither == "rand":
        raise ValueError("drawn numbers depend on the layout; use hash or mid")
    df = referenced_hits(
        hits,
        channel_map,
        reference_map,
        layout,
        spread,
        event_key,
        reference_id,
        first_reference,
        window=window,
    )
    if flip:
        df = flip_edges(df)
    if spread:
        pulses = pair_edges(df, event_key, HOT_CELL if window is None else None)
    else:
        pulses = pair_gathered(df, event_key)
    return to_float(pulses, ["charge", "timing"], factor=factor, dither=dither)
