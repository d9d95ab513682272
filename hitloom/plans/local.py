"""Detector plans on nested rows that are whole events: no hit leaves its row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.functions import asymmetry, pair_features, strip_coordinate
from hitloom.operators.curves import Curves, look_up, read_curve_points
from hitloom.operators.hits import VALUE_WINDOW
from hitloom.operators.nested import channel_table, local_pulses, pulses_of, strongest
from hitloom.operators.two_sided import FEATURES
from hitloom.plans.strip import ANODE, STRIP_FACTOR, STRIP_PLANES, StripPlane
from hitloom.plans.two_sided import TDC_FACTOR, TwoSided
from hitloom.schema import EVENT_KEY


def strip_local(
    events: DataFrame,
    channel_map: DataFrame,
    reference_map: DataFrame,
    curves: DataFrame,
    detectors: Sequence[str],
    full: bool = False,
    require: str | None = None,
    planes: Sequence[StripPlane] = STRIP_PLANES,
    factor: float = STRIP_FACTOR,
    window: tuple[float, float] = VALUE_WINDOW,
    dither: str = "hash",
    event_key: str = EVENT_KEY,
    first_reference: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """:func:`hitloom.plans.strip_plan` for nested `events`, a row for each row that has hits.

    The only joins are those of the positions with the broadcast curves, one for each plane, so the plan has
    no shuffle and runs on a stream in append mode.  `keep` are event columns to carry along.
    """
    wanted = [d + p for d in detectors for p in (ANODE, *[plane.plane for plane in planes])]
    channels = channel_table(channel_map.filter(F.col("cat").isin(wanted)), reference_map, flip=True)
    pulses = local_pulses(events, channels, factor, window, dither, event_key, first_reference, keep=keep)
    df = pulses.select(event_key, *keep, *[pulses_of(channels, c).alias(c) for c in wanted])
    ready = read_curve_points(curves)
    for d in detectors:
        for p in planes:
            df = _placed(df, d + p.plane, p.table(d), p, ready)
    columns: list[Column] = []
    for d in detectors:
        known = F.col(f"{d}{planes[0].plane}_pos").isNotNull()
        anodes = [(f"{d}{ANODE}_{q}", F.col(f"{d}{ANODE}.{q}")) for q in ("timing", "charge")]
        if not full:
            positions = [(f"{d}{p.plane}_pos", F.col(f"{d}{p.plane}_pos")) for p in planes]
            columns += [F.when(known, column).alias(name) for name, column in [*positions, *anodes]]
            continue
        columns += [column.alias(name) for name, column in anodes]
        for p in planes:
            cat = d + p.plane
            columns += [F.col(f"{cat}.{q}").alias(f"{cat}_{q}") for q in ("id", "timing", "charge")]
            columns.append(F.col(f"{cat}_pos"))
    result = df.select(event_key, *keep, *columns)
    if not full and require in detectors:
        return result.filter(F.col(f"{require}{planes[0].plane}_pos").isNotNull())
    return result


def _placed(df: DataFrame, cat: str, table: str, plane: StripPlane, curves: Curves) -> DataFrame:
    """`df` with ``<cat>_pos`` from the two strongest pulses of column `cat`."""
    columns = df.columns
    two = F.slice(strongest(cat), 1, 2)
    df = df.withColumn("_two", two)
    q = [F.get("_two", F.lit(i))["charge"] for i in (0, 1)]
    ids = [F.get("_two", F.lit(i))["id"] for i in (0, 1)]
    df = df.withColumns({"_sharing": asymmetry(*q), "_table": F.when(F.col(cat).isNotNull(), F.lit(table))})
    df = look_up(df, curves, "_sharing", "_part", "_table")
    pos = strip_coordinate(
        *ids,
        F.col("_part"),
        F.lit(float(plane.center)),
        F.lit(float(plane.pitch)),
        F.lit(float(plane.offset)),
        F.lit(-1 if plane.turned else 1),
    )
    return df.select(*columns, pos.alias(f"{cat}_pos"))


def two_sided_local(
    events: DataFrame,
    channel_map: DataFrame,
    reference_map: DataFrame,
    detectors: Sequence[TwoSided],
    full: bool = False,
    require: str | None = None,
    factor: float = TDC_FACTOR,
    window: tuple[float, float] = VALUE_WINDOW,
    dither: str = "hash",
    compat: bool = False,
    event_key: str = EVENT_KEY,
    first_reference: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """:func:`hitloom.plans.two_sided_plan` for nested `events`, a row for each strip that fired and one for an
    event with hits but without such a strip.

    A strip's two sides are matched inside the row, left pulse by right pulse; an event with so many of them
    that this counts belongs to the plan on hits.
    """
    wanted = [c for d in detectors for c in d.categories]
    channels = channel_table(channel_map.filter(F.col("cat").isin(wanted)), reference_map)
    pulses = local_pulses(events, channels, factor, window, dither, event_key, first_reference, keep=keep)
    df = pulses.select(event_key, *keep, *[pulses_of(channels, c).alias(c) for c in wanted])

    def strips(d: TwoSided) -> Column:
        _, left, right = d.categories

        def features(p: Column, r: Column) -> Column:
            named = pair_features(p["timing"], r["timing"], p["charge"], r["charge"], compat)
            return F.struct(*[named[f].alias(f) for f in FEATURES])

        def of_strip(i: Column) -> Column:
            sides = [F.filter(side, lambda p: p["id"] == i) for side in (left, right)]
            met = F.transform(
                sides[0],
                lambda p: F.transform(
                    F.filter(sides[1], lambda r: (p["timing"] - r["timing"]).between(*d.window)), lambda r: features(p, r)
                ),
            )
            return F.struct(i.alias("id"), F.sort_array(F.flatten(met)).alias("found"))

        ids = F.sort_array(F.array_intersect(F.transform(left, lambda p: p["id"]), F.transform(right, lambda p: p["id"])))
        return F.filter(F.transform(ids, of_strip), lambda s: F.size(s["found"]) > 0)

    df = df.withColumns({d.name: strips(d) for d in detectors})
    if require is not None and not full:
        for d in detectors:
            if d.name == require:
                df = df.filter(F.col(d.name + d.pad).isNotNull() & (F.size(d.name) > 0))
    for d in detectors:
        df = df.withColumn(d.name, F.explode_outer(d.name))
    columns: list[Column] = []
    for d in detectors:
        pad, left, right = d.categories
        strip = d.name + d.strip
        columns += [F.col(f"{pad}.{q}").alias(f"{pad}_{q}") for q in ("timing", "charge")]
        if full:
            columns += [F.col(f"{c}.{q}").alias(f"{c}_{q}") for c in (left, right) for q in ("id", "timing", "charge")]
        columns.append(F.col(f"{d.name}.id").alias(f"{strip}_id"))
        names = FEATURES if full else ["tdiff", "tavg", "qsqsum"]
        columns += [F.col(f"{d.name}.found.{f}").alias(f"{strip}_{f}") for f in names]
    return df.select(event_key, *keep, *columns)


def wire_local(
    events: DataFrame,
    channel_map: DataFrame,
    reference_map: DataFrame,
    planes: Sequence[str],
    require: str | None = None,
    reference_id: int | None = None,
    factor: float = TDC_FACTOR,
    window: tuple[float, float] | None = None,
    dither: str = "hash",
    event_key: str = EVENT_KEY,
    keep: Sequence[str] = (),
) -> DataFrame:
    """:func:`hitloom.plans.wire_plan` for nested `events`, a row for each row that has hits."""
    if reference_id is not None:
        reference_map = reference_map.filter(F.col("id") == reference_id)
    channels = channel_table(channel_map.filter(F.col("cat").isin(list(planes))), reference_map)
    pulses = local_pulses(events, channels, factor, window, dither, event_key, by_module=reference_id is None, keep=keep)
    df = pulses.select(event_key, *keep, *[pulses_of(channels, p).alias(p) for p in planes])
    if require is not None:
        df = df.filter(F.col(require).isNotNull())
    columns = [F.col(f"{p}.{q}").alias(f"{p}_{q}") for p in planes for q in ("id", "timing", "charge")]
    return df.select(event_key, *keep, *columns)
