"""Strip detectors: anode pulses and positions from charge sharing in each plane."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.functions import asymmetry, strip_coordinate
from hitloom.operators.curves import interpolate
from hitloom.operators.events import pulse_list
from hitloom.operators.hits import VALUE_WINDOW
from hitloom.operators.strips import strength_rank, strongest_two, top2_strips
from hitloom.plans.layout import Layout, by_layout, with_all_events
from hitloom.plans.pulses import calibrated_pulses
from hitloom.schema import EVENT_KEY


@dataclass(frozen=True)
class StripPlane:
    """Geometry of one plane; `curve` names its conversion table, with ``{det}`` filled in."""

    plane: str
    center: float
    pitch: float
    offset: float = 0.0
    turned: bool = True
    curve: str = ""

    def table(self, detector: str) -> str:
        return (self.curve or "{det}_" + self.plane + "c0").format(det=detector)


# Fixed values of the shipped detectors: centre strip, strip pitch, offset, orientation.
STRIP_PLANES = (StripPlane("x", 46.5, 2.55), StripPlane("y", 28.5, 2.58))

# Nanoseconds per time channel; fixed value.
STRIP_FACTOR = 0.09765627

ANODE = "a"


def _geometry(detectors: Sequence[str], planes: Sequence[StripPlane]) -> Column:
    """Constants of the row's plane as a struct, null for other categories."""
    entries = []
    for d in detectors:
        for p in planes:
            constants = F.struct(
                F.lit(p.table(d)).alias("table"),
                F.lit(float(p.center)).alias("center"),
                F.lit(float(p.pitch)).alias("pitch"),
                F.lit(float(p.offset)).alias("offset"),
                F.lit(-1 if p.turned else 1).alias("sign"),
            )
            entries += [F.lit(d + p.plane), constants]
    return F.create_map(*entries)[F.col("cat")]


def plane_summary(
    pulses: DataFrame,
    curves: DataFrame,
    detectors: Sequence[str],
    planes: Sequence[StripPlane] = STRIP_PLANES,
    full: bool = True,
    event_key: str = EVENT_KEY,
    spread: bool = False,
) -> DataFrame:
    """``event, cat, pulses, pos``: the pulse list and position of each plane of each event.

    All planes of all detectors share one aggregation and one curve lookup.  Without `full` only the
    anodes keep their pulses.  For events that are `spread` the two strongest pulses come from ranks
    limited before the shuffle, so that only the lists of the result itself meet in one row.
    """
    keep = None if full else F.col("cat").isin([d + ANODE for d in detectors])
    group = [event_key, "cat"]
    if spread:
        lists = pulses.groupBy(*group).agg(pulse_list(keep).alias("pulses"))
        summary = top2_strips(pulses, event_key, ["cat"]).join(lists, group)
    else:
        ranked = pulses.withColumn("_rank", strength_rank(group))
        summary = ranked.groupBy(*group).agg(
            *strongest_two(F.col("_rank")), pulse_list(keep).alias("pulses")
        )
    placed = summary.withColumn("geometry", _geometry(detectors, planes)).select(
        *summary.columns, "geometry.*", asymmetry(F.col("c0"), F.col("c1")).alias("c0c1")
    )
    pos = strip_coordinate(
        *[F.col(c) for c in ("id0", "id1", "sharing", "center", "pitch", "offset", "sign")]
    )
    return interpolate(placed, curves, "c0c1", "sharing").select(
        event_key, "cat", "pulses", pos.alias("pos")
    )


def strip_plan(
    hits: DataFrame,
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
    layout: Layout = Layout(),
    event_key: str = EVENT_KEY,
    first_reference: bool = False,
    events: DataFrame | None = None,
) -> DataFrame:
    """One row per event with the columns of every detector.

    Short: ``<det>x_pos, <det>y_pos, <det>a_timing, <det>a_charge``, filled where the position in the
    first plane is known; events without it are dropped for the detector named in `require`.
    Full: also ``id, timing, charge`` arrays of each plane, for all events.  `events` is a narrower
    source of the events' keys than `hits`, where there is one
    (:func:`~hitloom.sources.read_hit_keys`).
    """
    wanted = [d + p for d in detectors for p in (ANODE, *[plane.plane for plane in planes])]
    channel_map = channel_map.filter(F.col("cat").isin(wanted))

    def of(cat: str, column: str) -> Column:
        return F.first(F.when(F.col("cat") == cat, F.col(column)), ignorenulls=True)

    def columns(detector: str) -> list[Column]:
        anode = detector + ANODE
        anodes = [F.col(f"{anode}.{q}").alias(f"{anode}_{q}") for q in ("timing", "charge")]
        if not full:
            known = F.col(f"{detector}{planes[0].plane}_pos").isNotNull()
            positions = [f"{detector}{p.plane}_pos" for p in planes]
            return [
                *[F.when(known, F.col(p)).alias(p) for p in positions],
                *[
                    F.when(known, F.col(f"{anode}.{q}")).alias(f"{anode}_{q}")
                    for q in ("timing", "charge")
                ],
            ]
        rest = []
        for p in planes:
            cat = detector + p.plane
            rest += [F.col(f"{cat}.{q}").alias(f"{cat}_{q}") for q in ("id", "timing", "charge")]
            rest.append(F.col(f"{cat}_pos"))
        return [*anodes, *rest]

    def plan(hits: DataFrame, spread: bool) -> DataFrame:
        pulses = calibrated_pulses(
            hits,
            channel_map,
            reference_map,
            factor,
            flip=True,
            window=window,
            dither=dither,
            layout=layout,
            spread=spread,
            event_key=event_key,
            first_reference=first_reference,
        )
        summary = plane_summary(pulses, curves, detectors, planes, full, event_key, spread)
        lists = wanted if full else [d + ANODE for d in detectors]
        by_event = summary.groupBy(event_key).agg(
            *[of(cat, "pulses").alias(cat) for cat in lists],
            *[of(d + p.plane, "pos").alias(f"{d}{p.plane}_pos") for d in detectors for p in planes],
        )
        return by_event.select(event_key, *[c for d in detectors for c in columns(d)])

    result = by_layout(hits, events, layout, plan, event_key)
    if not full and require in detectors:
        # Events without that position are unwanted, so the others need not be added.
        return result.filter(F.col(f"{require}{planes[0].plane}_pos").isNotNull())
    return with_all_events(result, hits, events, event_key)
