"""Plans inside the nested row equal the plans on hits."""

import random
import re

import pytest

from hitloom.operators import explode_hits
from hitloom.operators.nested import channel_table
from hitloom.plans import (
    StripPlane,
    TwoSided,
    strip_local,
    strip_plan,
    two_sided_local,
    two_sided_plan,
    wire_local,
    wire_plan,
)
from hitloom.schema import RAW_EVENT
from hitloom.sinks import write_events
from hitloom.sources import read_events
from tests.conftest import MAP, explained, rows
from workload import fixture as fx

SF = "/root/testdata/sf0.001"
PLANES = (StripPlane("x", 1.0, 2.55), StripPlane("y", 1.0, 2.55))


def _events(spark):
    """Random events, with nulls at every level, unmapped channels and modules, and repeated hits."""
    rng = random.Random(5)

    def hit():
        return (rng.randrange(3), rng.randrange(12), rng.randrange(400), rng.choice([0, 0, 1, 1, 2, None]))

    made = []
    for e in range(60):
        hits = [hit() for _ in range(rng.randrange(60))]
        hits += hits[:3] + [(0, 0, rng.randrange(5), 0), (0, 0, 3, 0), (1, 0, 2, 0), (0, 10**12, 5, 0), (None, 1, 2, 0), (0, 1, None, 0)]
        segments = [(20, 4, 0, 50, hits[::2]), (20, 4, 1, 50, hits[1::2]), (21, 4, 0, 50, hits[:4]), (None, 4, 0, 50, hits[:2]), (20, 4, 0, 50, None)]
        made.append((e, e % 3, 7 * e, segments))
    made += [(None, 1, 1, [(20, 4, 0, 50, [(0, 1, 5, 0)])]), (100, 1, 1, None), (101, 1, 1, []), (102, 1, 1, [(20, 4, 0, 50, [])])]
    return spark.createDataFrame(made, RAW_EVENT)


def _maps(spark):
    channel_map = fx.chmap(spark).union(spark.createDataFrame([("p0a", 7, 20, 4, 50, 2, 5), ("p1x", 2, 20, 4, 50, 2, 5)], MAP))
    return channel_map, fx.tmap(spark)


@pytest.mark.parametrize("options", [{}, {"full": True}, {"require": "p0"}, {"full": True, "first_reference": True, "window": (-300, 300)}])
def test_strip_local_equals_strip_plan(spark, options):
    events, (channel_map, reference_map) = _events(spark), _maps(spark)
    curves = fx.curves(spark, *[f"p{d}_{p}c0" for d in (0, 1) for p in "xy"])
    common = {"detectors": ["p0", "p1"], "planes": PLANES, **options}
    local = strip_local(events, channel_map, reference_map, curves, **common)
    plan = strip_plan(explode_hits(events), channel_map, reference_map, curves, **common)
    assert local.columns == plan.columns
    assert rows(local) == rows(plan) and local.count() > 5


@pytest.mark.parametrize("options", [{}, {"full": True, "compat": True}, {"require": "p0"}])
def test_two_sided_local_equals_two_sided_plan(spark, options):
    events, (channel_map, reference_map) = _events(spark), _maps(spark)
    sides = [TwoSided(d, pad="a", left="x", right="y", strip="s", window=(-2.0, 3.0)) for d in ("p0", "p1")]
    local = two_sided_local(events, channel_map, reference_map, sides, **options)
    plan = two_sided_plan(explode_hits(events), channel_map, reference_map, sides, **options)
    assert local.columns == plan.columns
    assert rows(local) == rows(plan)


@pytest.mark.parametrize("options", [{}, {"require": "p0x"}, {"reference_id": 1}])
def test_wire_local_equals_wire_plan(spark, options):
    events, (channel_map, reference_map) = _events(spark), _maps(spark)
    local = wire_local(events, channel_map, reference_map, fx.PLANES, **options)
    plan = wire_plan(explode_hits(events), channel_map, reference_map, fx.PLANES, **options)
    assert local.columns == plan.columns
    assert rows(local) == rows(plan) and local.count() > 5


def test_no_hit_is_shuffled(spark, tmp_path):
    path = f"file://{tmp_path}/events"
    write_events(fx.whole_events(fx.hits(spark, SF)), path)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        curves = fx.curves(spark, "p0_xc0", "p0_yc0")
        df = strip_local(
            read_events(spark, path), fx.chmap(spark), fx.tmap(spark), curves, ["p0"], full=True, planes=PLANES, keep=["runnumber"]
        )
        text = explained(df)
        assert not re.search(r"(?<!Broadcast)(?<!Reused)Exchange \(", text)
        assert "Generate" not in text and "NestedLoop" not in text and "Python" not in text
        assert df.columns[:2] == ["event_id", "runnumber"]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_channel_numbers_far_apart_are_refused(spark):
    far = spark.createDataFrame([("a", 1, 1, 1, 1, 0, 0), ("a", 2, 1, 1, 1, 0, 10**9)], MAP)
    with pytest.raises(ValueError, match="far apart"):
        channel_table(far, far.limit(0))
    empty = channel_table(far.limit(0), far.limit(0))
    assert empty.elements == [] and empty.span("a") == (0, 0)


def test_drawn_dither_is_refused(spark):
    events, (channel_map, reference_map) = _events(spark), _maps(spark)
    with pytest.raises(ValueError):
        wire_local(events, channel_map, reference_map, fx.PLANES, dither="rand")
