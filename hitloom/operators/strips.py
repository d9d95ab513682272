"""Position from charge sharing between the two strongest strips."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitloom.functions import asymmetry, strip_coordinate
from hitloom.operators.curves import interpolate
from hitloom.schema import EVENT_KEY


def strength_rank(group: Sequence[str]) -> Column:
    """Rank of a pulse by charge within `group`; equal charges go by id, then by time."""
    order = [F.desc("charge"), F.asc("id"), F.asc("timing")]
    return F.row_number().over(Window.partitionBy(*group).orderBy(*order))


def strongest_two(rank: Column) -> list[Column]:
    """Aggregates picking charge and id of the pulses ranked 1 and 2."""
    return [
        F.max(F.when(rank == 1, F.col("charge"))).alias("c0"),
        F.max(F.when(rank == 2, F.col("charge"))).alias("c1"),
        F.max(F.when(rank == 1, F.col("id"))).alias("id0"),
        F.max(F.when(rank == 2, F.col("id"))).alias("id1"),
    ]


def top2_strips(
    pulses: DataFrame, event_key: str = EVENT_KEY, by: Sequence[str] = ()
) -> DataFrame:
    """``c0, c1, id0, id1`` of the two largest charges per event (and per column in `by`).

    The rank limit is applied before the shuffle too, so each task passes on two pulses per event
    at most.
    """
    group = [event_key, *by]
    ranked = pulses.withColumn("_rank", strength_rank(group)).filter(F.col("_rank") <= 2)
    return ranked.groupBy(*group).agg(*strongest_two(F.col("_rank")))


def strip_position(
    strips: DataFrame,
    curve: DataFrame,
    center: float,
    pitch: float,
    offset: float = 0.0,
    turned: bool = False,
    event_key: str = EVENT_KEY,
) -> DataFrame:
    """``pos`` and the converted asymmetry ``c0c1_conv`` of :func:`top2_strips` rows of one plane.

    `curve` is a single curve table; an event with one strip only has a null position.
    """
    named = strips.withColumn("c0c1", asymmetry(F.col("c0"), F.col("c1")))
    # All rows use the one curve there is, whatever its name.
    curve = curve.select(F.lit("").alias("table"), "x", "y")
    converted = interpolate(named.withColumn("table", F.lit("")), curve, "c0c1", "c0c1_conv")
    pos = strip_coordinate(
        F.col("id0"),
        F.col("id1"),
        F.col("c0c1_conv"),
        F.lit(float(center)),
        F.lit(float(pitch)),
        F.lit(float(offset)),
        F.lit(-1 if turned else 1),
    )
    return converted.select(event_key, pos.alias("pos"), "c0c1_conv")
