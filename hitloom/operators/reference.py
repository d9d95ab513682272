"""Time references: one channel per module measures the common start."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitloom.functions import band_cell, band_cells, in_open_window
from hitloom.operators.hits import map_channels
from hitloom.schema import CHANNEL_KEY, EVENT_KEY, MODULE_KEY
from hitloom.sizing import broadcast_if_small

# Hits of one join key that a task takes without help: only keys with more of them are salted.
SALTED_ROWS = 100_000


def time_reference(
    hits: DataFrame, reference_map: DataFrame, event_key: str = EVENT_KEY
) -> DataFrame:
    """Leading edges of the reference channels: event, value and module."""
    columns = [event_key, "value", *MODULE_KEY]
    leading = hits.filter(F.col("edge") == 0)
    return map_channels(leading, reference_map, columns)


def subtract_reference(
    mapped: DataFrame,
    references: DataFrame,
    event_key: str = EVENT_KEY,
    match: Sequence[str] = MODULE_KEY,
    first: bool = False,
    salt: int = 1,
    window: tuple[float, float] | None = None,
) -> DataFrame:
    """Replace ``value`` by its distance to the reference of the same event and module.

    A module without reference gives null; one with several gives a row for each of them, or only
    the earliest with `first`.  `match` are the columns compared besides the event.  With `salt` > 1
    the hits of one event and module are spread over that many join keys and the (few) references
    repeated for each, where the key has more than `SALTED_ROWS` hits; references of the others stand once.

    With `window` only rows whose distance lies strictly inside it are made: values are cut into cells a
    little wider than the window, a hit meets the references of two cells at most, and all others of its
    module are never paired with it.
    """
    key = [event_key, *match]
    if first:
        references = references.groupBy(key).agg(F.min("value").alias("value"))
    references = references.select(*key, F.col("value").alias("_reference"))
    columns = mapped.columns
    how = "left"
    if window is not None:
        mapped = mapped.withColumn("_cell", band_cell(F.col("value"), window))
        references = references.withColumn("_cell", F.explode(band_cells(F.col("_reference"), window)))
        key, how = [*key, "_cell"], "inner"
    if salt > 1:
        # A salted key holds more than SALTED_ROWS hits, so the broadcast has a row for so many of the input at most.
        counts = mapped.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > SALTED_ROWS)
        salted = F.broadcast(counts.select(*key, F.lit(salt).cast("long").alias("_salts")))
        salts = F.coalesce("_salts", F.lit(1).cast("long"))
        mapped = mapped.join(salted, key, "left").withColumn("_salt", F.pmod(F.xxhash64(*columns), salts))
        repeats = F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))
        references = references.join(salted, key, "left").withColumn("_salt", repeats).drop("_salts")
        key = [*key, "_salt"]
        # Spark takes an exploded table for as small as it was before, and would broadcast it.
        references = references.hint("merge")
    difference = F.col("value") - F.col("_reference")
    met = mapped.join(references, key, how)
    if window is not None:
        met = met.filter(in_open_window(difference, *window))
    return met.select(*[difference.alias("value") if c == "value" else F.col(c) for c in columns])


def subtract_by_id(
    mapped: DataFrame, references: DataFrame, reference_id: int, event_key: str = EVENT_KEY
) -> DataFrame:
    """Older form: the reference is the mapped hit with one `reference_id`, matched by event only."""
    chosen = references.filter(F.col("id") == reference_id).select(
        event_key, F.col("value").alias("_reference")
    )
    return mapped.join(chosen, event_key, "left").select(
        event_key, "id", (F.col("value") - F.col("_reference")).alias("value"), "edge"
    )


def tag_channels(
    hits: DataFrame, channel_map: DataFrame, reference_map: DataFrame, event_key: str = EVENT_KEY
) -> DataFrame:
    """Detector and reference hits in one pass over the hits, told apart by ``is_reference``.

    A channel in both maps gives a row of each kind.  Trailing edges of references are left out.
    """
    both = channel_map.select("cat", "id", *CHANNEL_KEY).withColumn("is_reference", F.lit(False))
    both = both.unionByName(
        reference_map.select("cat", "id", *CHANNEL_KEY).withColumn("is_reference", F.lit(True))
    )
    named = hits.filter(F.col(event_key).isNotNull()).join(broadcast_if_small(both), CHANNEL_KEY)
    return named.filter(~F.col("is_reference") | (F.col("edge") == 0)).select(
        event_key, *MODULE_KEY, "cat", "id", "value", "edge", "is_reference"
    )


def subtract_tagged(
    tagged: DataFrame,
    event_key: str = EVENT_KEY,
    match: Sequence[str] = MODULE_KEY,
    first: bool = False,
    merge_equal: bool = False,
    window: tuple[float, float] | None = None,
) -> DataFrame:
    """:func:`subtract_reference` on tagged hits that already lie together by event.

    The references of an event's module are found by a window, so neither side is read or shuffled
    again.  Hits without a reference, which would become null, are dropped.  `merge_equal` takes equal
    references once, for uses where repeated rows do not count.

    With `window` only rows strictly inside it are made, and a hit meets the references of two cells of
    values at most: each reference stands in the group of both, a hit in that of one.
    """
    cells = window is not None and not first
    if cells:
        own = F.array(band_cell(F.col("value"), window))
        cell = F.when(F.col("is_reference"), band_cells(F.col("value"), window)).otherwise(own)
        tagged = tagged.withColumn("_cell", F.explode(cell))
    group = Window.partitionBy(event_key, *match, *(["_cell"] if cells else []))
    reference = F.when(F.col("is_reference"), F.col("value"))
    if first:
        found = F.array_compact(F.array(F.min(reference).over(group)))
    else:
        collect = F.collect_set if merge_equal else F.collect_list
        found = collect(reference).over(group)
    difference = F.col("value") - F.col("_reference")
    met = (
        tagged.withColumn("_references", found)
        .filter(~F.col("is_reference"))
        .withColumn("_reference", F.explode("_references"))
    )
    if window is not None:
        met = met.filter(in_open_window(difference, *window))
    return met.select(event_key, "cat", "id", difference.alias("value"), "edge")
