"""Steps inside one nested row that holds a whole event: array functions, no explode and no shuffle.

Each step adds a column, so that the next one refers to a finished array and never makes it again.  Arrays
are walked a fixed number of times and sorted once or twice; nothing is compared pair by pair but a hit with
the references of its event.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.functions import dithered, in_open_window
from hitloom.schema import CHANNEL_KEY, EVENT_KEY
from hitloom.sizing import BROADCAST_ROWS

# Places of a channel table: a module's span of crates times its span of channels, empty ones included.
TABLE_CELLS = 1_000_000

_PLACE = "struct<channel:int,flip:boolean>"
_GEO = f"struct<module:int,first:bigint,channels:array<array<{_PLACE}>>>"
_TABLE = f"map<string,struct<first:bigint,geos:array<{_GEO}>>>"
_TAGGED = "struct<channel:int,module:int,value:bigint,late:bigint>"
_EDGE = "struct<channel:int,value:bigint,late:bigint>"


@dataclass(frozen=True)
class Channels:
    """Both maps as one constant, and the detector elements (category, id) by channel number.

    Device, focal plane and detector lead to a list by ``geo``, that to a list by ``ch``, so a hit finds its
    elements by two array positions.  Elements of a category have consecutive numbers; references have none.
    """

    table: Column
    elements: list[tuple[str, int]]

    def span(self, category: str) -> tuple[int, int]:
        """First channel number of a category, and the one behind its last."""
        own = [i for i, (cat, _) in enumerate(self.elements) if cat == category]
        return (own[0], own[-1] + 1) if own else (0, 0)

    def named(self, field: int) -> Column:
        """Categories (0) or ids (1) by channel number."""
        return F.array(*[F.lit(e[field]) for e in self.elements]).cast("array<string>" if field == 0 else "array<bigint>")


def channel_table(channel_map: DataFrame, reference_map: DataFrame, flip: bool = False) -> Channels:
    """The maps as constants; `flip` swaps the edges of categories that do not end in "a"."""
    columns = ["cat", "id", *CHANNEL_KEY]
    both = channel_map.select(*columns, F.lit(False).alias("reference")).unionByName(
        reference_map.select(*columns, F.lit(True).alias("reference"))
    )
    both = both.filter(" and ".join(f"{c} is not null" for c in CHANNEL_KEY))
    rows = both.limit(BROADCAST_ROWS + 1).collect()
    if len(rows) > BROADCAST_ROWS:
        raise ValueError("the channel map is too large for a constant; use the plans on hits")
    # an element without category or id makes no pulse
    rows = [r for r in rows if r["reference"] or (r["cat"] is not None and r["id"] is not None)]
    elements = sorted({(r["cat"], r["id"]) for r in rows if not r["reference"]})
    number = {e: i for i, e in enumerate(elements)}
    modules: dict[str, dict[int, dict[int, list]]] = {}
    for r in rows:
        place = {"channel": None, "flip": False}
        if not r["reference"]:
            place = {"channel": number[r["cat"], r["id"]], "flip": flip and not r["cat"].endswith("a")}
        geos = modules.setdefault("/".join(str(r[c]) for c in ("dev", "fp", "det")), {})
        geos.setdefault(r["geo"], {}).setdefault(r["ch"], []).append(place)
    cells = sum(
        max(geos) - min(geos) + 1 + sum(max(chs) - min(chs) + 1 for chs in geos.values()) for geos in modules.values()
    )
    if cells > TABLE_CELLS:
        raise ValueError("channel numbers are too far apart for a table; use the plans on hits")

    def dense(found: dict[int, object]) -> list:
        return [found.get(i) for i in range(min(found), max(found) + 1)]

    module = count()
    table = {}
    for key, geos in modules.items():
        of_geo = {g: {"module": next(module), "first": min(chs), "channels": dense(chs)} for g, chs in geos.items()}
        table[key] = {"first": min(geos), "geos": dense(of_geo)}
    return Channels(F.from_json(F.lit(json.dumps(table)), _TABLE), elements)


def _none(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def tagged_hits(table: Column, segments: str = "segdata") -> Column:
    """The mapped hits of a nested event with channel (null for a reference) and module; ``late`` is 0 for
    trailing edges and 1 for leading ones.  Hits of unmapped channels drop out."""

    def tagged(h: Column, geo: Column) -> Column:
        found = F.get(geo["channels"], (h["ch"] - geo["first"]).try_cast("int"))
        hits = F.transform(
            found,
            lambda m: F.struct(
                m["channel"].alias("channel"),
                geo["module"].alias("module"),
                h["value"].alias("value"),
                F.when(m["flip"], h["edge"]).otherwise(1 - h["edge"]).alias("late"),
            ),
        )
        return F.coalesce(hits, _none(_TAGGED))

    def of_segment(s: Column) -> Column:
        key = F.concat(s["dev"], F.lit("/"), s["fp"], F.lit("/"), s["det"])
        # the segment's part of the table is looked up once
        found = F.filter(F.array(F.try_element_at(table, key)), lambda m: m.isNotNull())

        def of_module(m: Column) -> Column:
            return F.flatten(
                F.transform(s["hits"], lambda h: tagged(h, F.get(m["geos"], (h["geo"] - m["first"]).try_cast("int"))))
            )

        return F.coalesce(F.flatten(F.transform(found, of_module)), _none(_TAGGED))

    return F.coalesce(F.flatten(F.transform(segments, of_segment)), _none(_TAGGED))


def local_pulses(
    events: DataFrame,
    channels: Channels,
    factor: float,
    window: tuple[float, float] | None = None,
    dither: str = "hash",
    event_key: str = EVENT_KEY,
    first_reference: bool = False,
    by_module: bool = True,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``event, [keep], pulses``: the pulses (channel, id, charge, timing) of each event, by channel and time.

    The same pulses as :func:`hitloom.plans.calibrated_pulses` gives, made inside the row: channels are
    looked up in a constant table, references subtracted, values cut to the window and edges paired.  Without
    `by_module` every hit takes all references of its event.  A row without hits is left out; a null event has
    no pulses.  Each nested row has to be a whole event.

    Pairing is a position lookup: with leading and trailing edges sorted together, a leading edge at place i
    that has j leading edges before it has i - j trailing edges before it, so the next one is number i - j.
    """
    if dither == "rand":
        raise ValueError("drawn numbers change when a row is read again; use hash or mid")
    df = events.filter(F.exists("segdata", lambda s: F.size(s["hits"]) > 0))
    tagged = F.when(F.col(event_key).isNotNull(), tagged_hits(channels.table))
    df = df.select(event_key, *keep, F.coalesce(tagged, _none(_TAGGED)).alias("_tagged"))

    def module(t: Column) -> Column:
        """What a hit and its references have in common besides the event."""
        return t["module"] if by_module else F.lit(0)

    referring = F.filter("_tagged", lambda t: t["channel"].isNull() & (t["late"] == 1) & t["value"].isNotNull())
    references = F.transform(referring, lambda t: F.struct(module(t).alias("module"), t["value"].alias("value")))
    df = df.withColumn("_references", F.sort_array(references))

    def earlier(r: Column, i: Column) -> Column:
        before = F.get("_references", i - 1)
        same = before["module"] == r["module"]
        # without `first_reference` only equal references are one
        return F.coalesce(same if first_reference else same & (before["value"] == r["value"]), F.lit(False))

    df = df.withColumn("_references", F.filter("_references", lambda r, i: ~earlier(r, i)))

    def subtracted(t: Column) -> Column:
        own = F.filter("_references", lambda r: r["module"] == module(t))
        return F.transform(
            own, lambda r: F.struct(t["channel"].alias("channel"), (t["value"] - r["value"]).alias("value"), t["late"].alias("late"))
        )

    def usable(h: Column) -> Column:
        return in_open_window(h["value"], *window) if window is not None else h["value"].isNotNull()

    detector = F.filter("_tagged", lambda t: t["channel"].isNotNull() & t["late"].isin(0, 1))
    hits = F.coalesce(F.flatten(F.transform(detector, subtracted)), _none(_EDGE))
    # trailing edges stand before leading ones of the same time and do not close them
    df = df.select(event_key, *keep, F.sort_array(F.filter(hits, usable)).alias("_edges"))
    leading = F.transform(
        "_edges",
        lambda h, i: F.when(
            h["late"] == 1, F.struct(h["channel"].alias("channel"), h["value"].alias("value"), i.alias("i"))
        ),
    )
    df = df.withColumns({"_leading": F.array_compact(leading), "_trailing": F.filter("_edges", lambda h: h["late"] == 0)})

    ids = channels.named(1)

    def pulse(h: Column, j: Column) -> Column:
        end, before = F.get("_trailing", h["i"] - j), F.get("_leading", j - 1)
        repeated = (before["channel"] == h["channel"]) & (before["value"] == h["value"])
        made = F.struct(
            h["channel"].alias("channel"),
            F.get(ids, h["channel"]).alias("id"),
            (end["value"] - h["value"]).alias("charge"),
            h["value"].alias("timing"),
        )
        return F.when((end["channel"] == h["channel"]) & ~F.coalesce(repeated, F.lit(False)), made)

    df = df.select(event_key, *keep, F.array_compact(F.transform("_leading", pulse)).alias("_pairs"))
    cats = channels.named(0)

    def scaled(p: Column) -> Column:
        keys = [F.col(event_key), F.get(cats, p["channel"]), *[p[c] for c in ("id", "charge", "timing")]]
        return F.struct(
            p["channel"].alias("channel"),
            p["id"].alias("id"),
            *[dithered(p[c], 0.0, factor, dither, keys, seed).alias(c) for seed, c in enumerate(("charge", "timing"))],
        )

    return df.select(event_key, *keep, F.transform("_pairs", scaled).alias("pulses"))


def pulses_of(channels: Channels, category: str) -> Column:
    """The pulses of one category as (timing, id, charge), ordered by them; null if there are none."""
    first, end = channels.span(category)
    own = F.filter("pulses", lambda p: (p["channel"] >= first) & (p["channel"] < end))
    named = F.transform(own, lambda p: F.struct(p["timing"].alias("timing"), p["id"].alias("id"), p["charge"].alias("charge")))
    return F.when(F.exists("pulses", lambda p: (p["channel"] >= first) & (p["channel"] < end)), F.sort_array(named))


def strongest(pulses: str) -> Column:
    """Pulses by falling charge, equal ones by id, then time, as (charge, id, timing)."""
    keyed = F.transform(pulses, lambda p: F.struct((-p["charge"]).alias("charge"), p["id"].alias("id"), p["timing"].alias("timing")))
    return F.transform(F.sort_array(keyed), lambda p: F.struct((-p["charge"]).alias("charge"), p["id"].alias("id"), p["timing"].alias("timing")))


