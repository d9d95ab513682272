"""The physical plans are the ones intended."""

import re

import pytest

from hitloom.operators import explode_hits, hist1d, pair_edges, top2_strips
from hitloom.plans import Layout, strip_plan, trigger_plan, two_sided_plan
from hitloom.sinks import write_event_table, write_events
from hitloom.sources import read_events, read_hit_keys
from tests.conftest import MAPPED, PULSE, explained, plan_tree
from workload import fixture as fx
from workload.queries import FIXTURE_PLANES, FIXTURE_SIDES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('raw')}/events"
    write_events(fx.whole_events(fx.hits(spark, SF)), path)
    spark.sql("DROP TABLE IF EXISTS raw_shapes")
    write_event_table(read_events(spark, path), "raw_shapes", 4)
    return path


@pytest.fixture(autouse=True)
def static_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _strip(spark, hits, layout, **options):
    return strip_plan(
        hits, fx.chmap(spark), fx.tmap(spark), fx.curves(spark, "p0_xc0", "p0_yc0"), ["p0"],
        planes=FIXTURE_PLANES, layout=layout, **options,
    )


def _shuffles(df):
    """Shuffles of the plan; the small curve and map tables need none."""
    lines = plan_tree(df).splitlines()
    return sum(re.search(r"(?<!\w)Exchange \(", line) is not None for line in lines)


def test_stored_events_take_one_shuffle_of_hits_and_one_of_keys(spark, stored):
    hits = explode_hits(read_events(spark, stored))
    keys = read_hit_keys(spark, stored)
    plan = _strip(spark, hits, Layout(hot_rows=None), full=True, events=keys)
    assert _shuffles(plan) == 2
    required = _strip(spark, hits, Layout(hot_rows=None), require="p0")
    assert _shuffles(required) == 1
    text = explained(plan)
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert "Python" not in text and "Arrow" not in text


def test_bucketed_events_take_no_shuffle(spark, stored):
    hits = explode_hits(spark.table("raw_shapes"))
    clustered = Layout(clustered=True, hot_rows=None)
    assert _shuffles(_strip(spark, hits, clustered, full=True)) == 0
    front = (hits, fx.chmap(spark), fx.tmap(spark))
    sides = two_sided_plan(*front, [FIXTURE_SIDES], full=True, layout=clustered)
    assert _shuffles(sides) == 0
    assert _shuffles(trigger_plan(*front, layout=clustered)) == 0


def test_two_sided_takes_one_shuffle(spark, stored):
    hits = explode_hits(read_events(spark, stored))
    plan = two_sided_plan(
        hits, fx.chmap(spark), fx.tmap(spark), [FIXTURE_SIDES], require="p0", layout=Layout(hot_rows=None)
    )
    assert _shuffles(plan) == 1
    assert "NestedLoop" not in plan_tree(plan)


def test_scan_reads_only_what_is_used(spark, stored):
    text = explained(explode_hits(read_events(spark, stored)))
    schema = [line for line in text.splitlines() if line.startswith("ReadSchema")][0]
    assert "mod" not in schema and "runnumber" not in schema
    keys = explained(read_hit_keys(spark, stored).distinct())
    schema = [line for line in keys.splitlines() if line.startswith("ReadSchema")][0]
    assert schema.endswith("struct<event_id:bigint,segdata:array<struct<hits:array<struct<geo:bigint>>>>>")


def test_spread_steps_combine_before_they_shuffle(spark):
    mapped = spark.createDataFrame([(1, "c", 0, 1, 0)], MAPPED)
    pulses = spark.createDataFrame([(1, "c", 0, 1.0, 1.0)], PULSE)
    # The tree names the last step first: what comes after the last exchange runs before it.
    for df, step in (
        (pair_edges(mapped), "HashAggregate ("),
        (top2_strips(pulses), "WindowGroupLimit ("),
        (hist1d(pulses, "charge", 10, (0.0, 1.0)), "HashAggregate ("),
    ):
        tree = plan_tree(df)
        assert step in tree[tree.rindex(" Exchange (") :]
        assert step in tree[: tree.rindex(" Exchange (")]
