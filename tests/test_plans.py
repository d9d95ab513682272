"""Whole plans: event layouts must not change results."""

import random

import pytest

from hitloom.operators import explode_hits
from hitloom.plans import (
    Layout,
    StripPlane,
    TwoSided,
    run_batch,
    strip_plan,
    trigger_plan,
    two_sided_plan,
    wire_plan,
)
from hitloom.sinks import write_event_table, write_events
from hitloom.sources import Paths, read_events
from tests.conftest import HIT, MAP, rows
from workload.fixture import whole_events

PLANES = (StripPlane("x", 1.0, 2.55), StripPlane("y", 1.0, 2.58))


@pytest.fixture(scope="module")
def tables(spark):
    """Few events, one of them holding a third of the hits, with missing and double references."""
    random.seed(17)
    hits = []
    for event in range(30):
        for geo in (0, 1):
            if event % 5:
                hits.append((event, 20, 4, 50, geo, 0, random.randrange(50), 0))
            if event % 7 == 0:
                hits.append((event, 20, 4, 50, geo, 0, random.randrange(50), 0))
            hits.append((event, 20, 4, 50, geo, 0, 3, 1))
        for _ in range(40 if event != 21 else 700):
            hits.append((event, 20, 4, 50, random.randrange(2), random.randrange(1, 10),
                         random.randrange(3000), random.randrange(2)))
    hits.append((777, 20, 4, 50, 5, 5, 1, 0))
    channels = [(f"p{g}{'axy'[(c - 1) // 3]}", (c - 1) % 3, 20, 4, 50, g, c)
                for g in (0, 1) for c in range(1, 10)]
    curve = [(f"p{g}_{p}c0", x, y) for g in (0, 1) for p in "xy"
             for x, y in ((0.0, 0.0), (0.2, 0.7), (0.4, 1.0))]
    return {
        "hits": spark.createDataFrame(hits, HIT).repartition(3).cache(),
        "map": spark.createDataFrame(channels, MAP),
        "refs": spark.createDataFrame([("tref", g, 20, 4, 50, g, 0) for g in (0, 1)], MAP),
        "curve": spark.createDataFrame(curve, "table string, x double, y double"),
    }


LAYOUTS = {"one hot event": Layout(hot_rows=300), "partitions": Layout(partitions=3)}


def _plans(t):
    sides = [TwoSided("p0", "a", "x", "y", "s", (-40.0, 40.0)), TwoSided("p1", "a", "x", "y", "s", (-5.0, 60.0))]
    front = (t["map"], t["refs"])
    wires = ["p0a", "p0x", "p1y"]
    return {
        "strip full": lambda h, **o: strip_plan(h, *front, t["curve"], ["p0", "p1"], full=True, planes=PLANES, **o),
        "strip short": lambda h, **o: strip_plan(h, *front, t["curve"], ["p0", "p1"], planes=PLANES, **o),
        "strip require": lambda h, **o: strip_plan(
            h, *front, t["curve"], ["p0", "p1"], require="p1", planes=PLANES, **o),
        "strip first": lambda h, **o: strip_plan(
            h, *front, t["curve"], ["p0"], full=True, planes=PLANES, first_reference=True, **o),
        "two-sided full": lambda h, **o: two_sided_plan(h, *front, sides, full=True, **o),
        "two-sided short": lambda h, **o: two_sided_plan(h, *front, sides, require="p0", **o),
        "wire": lambda h, **o: wire_plan(h, *front, wires, **o),
        "wire by id": lambda h, **o: wire_plan(h, *front, wires, require="p0x", reference_id=1, **o),
        "trigger": lambda h, **o: trigger_plan(h, *front, **o),
        "trigger full": lambda h, **o: trigger_plan(h, *front, full=True, **o),
    }


@pytest.mark.parametrize("name", list(_plans({"map": 0, "refs": 0, "curve": 0})))
def test_layouts_agree(spark, tables, name):
    plan = _plans(tables)[name]
    plain = plan(tables["hits"], layout=Layout(hot_rows=None))
    expected = rows(plain)
    assert expected
    if "require" not in name and "by id" not in name and name != "two-sided short":
        assert 777 in {r[0] for r in expected}
        assert len({r[0] for r in expected}) == 31
    for label, layout in LAYOUTS.items():
        got = plan(tables["hits"], layout=layout)
        assert got.columns == plain.columns
        assert rows(got) == expected, label


def test_column_names(spark, tables):
    front = (tables["hits"], tables["map"], tables["refs"])
    short = strip_plan(*front, tables["curve"], ["d0"])
    assert short.columns == ["event_id", "d0x_pos", "d0y_pos", "d0a_timing", "d0a_charge"]
    full = strip_plan(*front, tables["curve"], ["d0"], full=True)
    assert full.columns == [
        "event_id", "d0a_timing", "d0a_charge", "d0x_id", "d0x_timing", "d0x_charge", "d0x_pos",
        "d0y_id", "d0y_timing", "d0y_charge", "d0y_pos",
    ]
    sides = two_sided_plan(*front, [TwoSided("e3")])
    assert sides.columns == [
        "event_id", "e3pad_timing", "e3pad_charge", "e3strip_id", "e3strip_tdiff",
        "e3strip_tavg", "e3strip_qsqsum",
    ]
    assert two_sided_plan(*front, [TwoSided("e3")], full=True).columns == [
        "event_id", "e3pad_timing", "e3pad_charge",
        "e3stripL_id", "e3stripL_timing", "e3stripL_charge",
        "e3stripR_id", "e3stripR_timing", "e3stripR_charge",
        "e3strip_id", "e3strip_tdiff", "e3strip_tavg", "e3strip_qdiff", "e3strip_qavg",
        "e3strip_qlog", "e3strip_qsqsum",
    ]
    assert trigger_plan(*front).columns == ["event_id", "trig"]
    assert trigger_plan(*front, full=True).columns == ["event_id", "trig_id", "trig_timing", "trig"]


def test_short_output_needs_the_first_position(spark, tables):
    short = strip_plan(tables["hits"], tables["map"], tables["refs"], tables["curve"], ["p0"], planes=PLANES)
    unknown = short.filter("p0x_pos IS NULL")
    assert unknown.count() > 0
    assert unknown.filter("p0y_pos IS NOT NULL OR p0a_timing IS NOT NULL").count() == 0
    required = strip_plan(
        tables["hits"], tables["map"], tables["refs"], tables["curve"], ["p0"], require="p0", planes=PLANES
    )
    assert rows(required) == rows(short.filter("p0x_pos IS NOT NULL"))


def test_another_event_key(spark, tables):
    hits = tables["hits"].withColumnRenamed("event_id", "ts")
    front = (tables["map"], tables["refs"], tables["curve"], ["p0"])
    by_ts = strip_plan(hits, *front, full=True, planes=PLANES, event_key="ts", dither="mid")
    by_id = strip_plan(tables["hits"], *front, full=True, planes=PLANES, dither="mid")
    assert by_ts.columns[0] == "ts"
    assert rows(by_ts) == rows(by_id)


def test_stored_run_and_bucketed_table(spark, tables, tmp_path):
    plan = _plans(tables)["strip full"]
    expected = rows(plan(tables["hits"], layout=Layout(hot_rows=None)))
    base = f"file://{tmp_path}"
    paths = Paths(base, base, base)
    write_events(whole_events(tables["hits"]), paths.events("run"))
    for partitions, hot_rows in ((None, 10), (3, 10**6)):
        target = run_batch(
            spark, paths, "run", "strip",
            lambda hits, layout, events: plan(hits, layout=layout, events=events),
            partitions=partitions, hot_rows=hot_rows,
        )
        assert target.endswith("run_strip.parquet")
        assert rows(spark.read.parquet(target)) == expected

    spark.sql("DROP TABLE IF EXISTS raw_bucketed")
    write_event_table(read_events(spark, paths.events("run")), "raw_bucketed", 4)
    hits = explode_hits(spark.table("raw_bucketed"))
    assert rows(plan(hits, layout=Layout(clustered=True, hot_rows=None))) == expected
