"""Coincidences between the two ends of a strip: a band match, by a sweep of each event or by an equality join."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitloom.functions import band_cell, band_cells, pair_features
from hitloom.schema import EVENT_KEY

FEATURES = ["tdiff", "tavg", "qdiff", "qavg", "qlog", "qsqsum"]

# Time window of the shipped detector, left minus right; fixed value.
TIME_WINDOW = (-100.0, 100.0)


def match_sides(
    pulses: DataFrame,
    group: Sequence[str],
    window: tuple[float, float],
    output: str,
    compat: bool = False,
) -> DataFrame:
    """Add to each left pulse (``side = 'L'``) the features of the right pulses in its window.

    `output` is an array of structs; it is null for other rows.  The right pulses come from a range
    frame over the time axis, so a strip with many pulses is swept once and never paired in full.
    """
    low, high = window
    # Frame limits are whole numbers, so time is measured in thousandths of the window.  The frame is
    # a little wider than the window, which is then applied to the difference itself.
    unit = max(abs(low), abs(high)) / 1000 or 1.0
    frame = (
        Window.partitionBy(*group)
        .orderBy(F.col("timing") / unit)
        .rangeBetween(math.floor(-high / unit) - 1, math.ceil(-low / unit) + 1)
    )
    right = F.when(F.col("side") == "R", F.struct("timing", "charge"))

    def features(r: Column) -> Column:
        named = pair_features(F.col("timing"), r["timing"], F.col("charge"), r["charge"], compat)
        return F.struct(*[column.alias(name) for name, column in named.items()])

    inside = F.filter("_right", lambda r: (F.col("timing") - r["timing"]).between(low, high))
    return (
        pulses.withColumn("_right", F.collect_list(right).over(frame))
        .withColumn(output, F.when(F.col("side") == "L", F.transform(inside, features)))
        .drop("_right")
    )


def band_pairs(
    left: DataFrame,
    right: DataFrame,
    group: Sequence[str],
    window: tuple[float, float],
    compat: bool = False,
) -> DataFrame:
    """`group` and the features of every left/right pulse pair of a group whose difference lies in `window`.

    An equality join: time is cut into cells a little wider than the window, a left pulse goes to one cell and
    a right pulse to two, so each pair meets exactly once.  No row holds a list, and a group with many pulses
    is spread over its cells.
    """
    left = left.select(*group, "charge", "timing", band_cell(F.col("timing"), window).alias("_cell"))
    right = right.select(
        *group,
        F.col("charge").alias("_charge"),
        F.col("timing").alias("_timing"),
        F.explode(band_cells(F.col("timing"), window)).alias("_cell"),
    )
    met = left.join(right, [*group, "_cell"]).filter((F.col("timing") - F.col("_timing")).between(*window))
    named = pair_features(F.col("timing"), F.col("_timing"), F.col("charge"), F.col("_charge"), compat)
    return met.select(*group, *[named[f].alias(f) for f in FEATURES])


def strip_features(pairs: DataFrame, group: Sequence[str]) -> DataFrame:
    """The pairs of each group in one row: ``_found``, ordered by ``tdiff`` and then by the other features."""
    return pairs.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct(*FEATURES))).alias("_found"))


def two_sided(
    left: DataFrame,
    right: DataFrame,
    name: str,
    window: tuple[float, float] = TIME_WINDOW,
    event_key: str = EVENT_KEY,
    compat: bool = False,
) -> DataFrame:
    """Feature arrays per (event, id) of left/right pulses whose time difference lies in `window`.

    Both limits are included.  Columns are prefixed with `name`; arrays are ordered by ``tdiff`` and
    then by the other features.
    """
    usable = F.col(event_key).isNotNull() & F.col("id").isNotNull()
    group = [event_key, "id"]
    found = strip_features(band_pairs(left.filter(usable), right.filter(usable), group, window, compat), group)
    return found.select(
        event_key,
        F.col("id").alias(f"{name}_id"),
        *[F.col("_found")[f].alias(f"{name}_{f}") for f in FEATURES],
    )
