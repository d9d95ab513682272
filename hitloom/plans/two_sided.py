"""Detectors read out at both ends of each strip, with a pad."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.operators.events import pulse_list
from hitloom.operators.hits import VALUE_WINDOW
from hitloom.operators.two_sided import FEATURES, TIME_WINDOW, band_pairs, match_sides, strip_features
from hitloom.plans.layout import Layout, by_layout, with_all_events
from hitloom.plans.pulses import calibrated_pulses
from hitloom.schema import EVENT_KEY

# Nanoseconds per time channel; fixed value.
TDC_FACTOR = 0.0244140625


@dataclass(frozen=True)
class TwoSided:
    """Category suffixes of one detector and the coincidence window of its strips."""

    name: str
    pad: str = "pad"
    left: str = "stripL"
    right: str = "stripR"
    strip: str = "strip"
    window: tuple[float, float] = TIME_WINDOW

    @property
    def categories(self) -> list[str]:
        return [self.name + self.pad, self.name + self.left, self.name + self.right]


def two_sided_plan(
    hits: DataFrame,
    channel_map: DataFrame,
    reference_map: DataFrame,
    detectors: Sequence[TwoSided],
    full: bool = False,
    require: str | None = None,
    factor: float = TDC_FACTOR,
    window: tuple[float, float] = VALUE_WINDOW,
    dither: str = "hash",
    compat: bool = False,
    layout: Layout = Layout(),
    event_key: str = EVENT_KEY,
    first_reference: bool = False,
    events: DataFrame | None = None,
) -> DataFrame:
    """Pad pulses and strip coincidences per event; an event has a row for each strip that fired.

    Short: pad arrays and ``<det>strip_id, _tdiff, _tavg, _qsqsum``; the detector named in `require`
    must have both pad and strip.  Full: also the pulses of both sides and all pair features, for all
    events.
    """
    wanted = [cat for d in detectors for cat in d.categories]
    channel_map = channel_map.filter(F.col("cat").isin(wanted))
    cat = F.col("cat")

    def choose(pairs: list[tuple[str, str]]) -> Column:
        """The name paired with the row's category."""
        chosen = F.lit(None).cast("string")
        for category, name in pairs:
            chosen = F.when(cat == category, F.lit(name)).otherwise(chosen)
        return chosen

    detector = choose([(c, d.name) for d in detectors for c in d.categories])
    side = choose([(d.name + d.left, "L") for d in detectors]
                  + [(d.name + d.right, "R") for d in detectors])
    widest = (min(d.window[0] for d in detectors), max(d.window[1] for d in detectors))

    def pulses_of(category: str) -> Column:
        return F.collect_list(F.when(cat == category, F.struct("timing", "id", "charge")))

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
            first_reference=first_reference,
        )
        if spread:
            return spread_out(pulses)
        sided = pulses.withColumn("_detector", detector).withColumn("side", side)
        group = [event_key, "_detector", "side_known", "id"]
        sided = sided.withColumn("side_known", F.col("side").isNotNull())
        matched = match_sides(sided, group, widest, "_found", compat)

        # Strip by strip, then event by event; both follow the event's partition.
        by_strip = matched.groupBy(event_key, "id").agg(
            *[pulses_of(c).alias(c) for c in wanted],
            *[
                F.flatten(F.collect_list(F.when(cat == d.name + d.left, F.col("_found"))))
                .alias(d.name)
                for d in detectors
            ],
        )

        def within(d: TwoSided) -> Column:
            found = F.filter(d.name, lambda m: m["tdiff"].between(*d.window))
            return F.when(
                F.size(found) > 0, F.struct(F.col("id"), F.sort_array(found).alias("found"))
            )

        by_event = by_strip.groupBy(event_key).agg(
            *[F.flatten(F.collect_list(c)).alias(c) for c in wanted],
            *[F.sort_array(F.collect_list(within(d))).alias(d.name) for d in detectors],
        )
        lists = [
            F.when(F.size(c) > 0, F.sort_array(c)).alias(c) for c in wanted
        ]
        result = by_event.select(event_key, *lists, *[d.name for d in detectors])
        if require is not None and not full:
            for d in detectors:
                if d.name == require:
                    result = result.filter(
                        F.col(d.name + d.pad).isNotNull() & (F.size(d.name) > 0)
                    )
        # One row per strip that fired; an event without any keeps one row.
        for d in detectors:
            result = result.withColumn(d.name, F.explode_outer(d.name))
        return result.select(event_key, *[c for d in detectors for c in columns(d)])

    def spread_out(pulses: DataFrame) -> DataFrame:
        """Hot events: pairs come from a join by time cells, so only the lists of the result meet in a row, and
        a strip's row is made once."""
        # the sides are needed in the full table only; without them a list is that of the pad
        listed = wanted if full else [d.name + d.pad for d in detectors]
        lists = [pulse_list(cat == c).alias(c) for c in listed]
        result = pulses.groupBy(event_key).agg(*lists)
        group = [event_key, "id"]
        for d in detectors:
            _, left, right = d.categories
            pairs = band_pairs(pulses.filter(cat == left), pulses.filter(cat == right), group, d.window, compat)
            strips = strip_features(pairs, group).select(
                event_key, F.struct("id", F.col("_found").alias("found")).alias(d.name)
            )
            needed = d.name == require and not full
            result = result.join(strips, event_key, "inner" if needed else "left")
            if needed:
                result = result.filter(F.col(d.name + d.pad).isNotNull())
        return result.select(event_key, *[c for d in detectors for c in columns(d)])

    def columns(d: TwoSided) -> list[Column]:
        pad, left, right = d.categories
        strip = d.name + d.strip
        out = [F.col(f"{pad}.{q}").alias(f"{pad}_{q}") for q in ("timing", "charge")]
        if full:
            out += [
                F.col(f"{c}.{q}").alias(f"{c}_{q}")
                for c in (left, right)
                for q in ("id", "timing", "charge")
            ]
        out.append(F.col(f"{d.name}.id").alias(f"{strip}_id"))
        features = FEATURES if full else ["tdiff", "tavg", "qsqsum"]
        return out + [F.col(f"{d.name}.found.{f}").alias(f"{strip}_{f}") for f in features]

    result = by_layout(hits, events, layout, plan, event_key)
    if not full and require in [d.name for d in detectors]:
        return result
    return with_all_events(result, hits, events, event_key)
