import pytest

from hitloom.operators import collect_planes, assemble, strip_position, top2_strips, trigger_table
from tests.conftest import PULSE, rows


def _pulses(spark, data):
    return spark.createDataFrame(data, PULSE)


def test_top2_with_one_two_three_strips_and_ties(spark):
    df = _pulses(
        spark,
        [
            (1, "x", 4, 9.0, 1.0),
            (2, "x", 5, 7.0, 1.0), (2, "x", 3, 7.0, 2.0),
            (3, "x", 1, 2.0, 1.0), (3, "x", 2, 8.0, 1.0), (3, "x", 3, 5.0, 1.0),
            (4, "x", 6, 5.0, 1.0), (4, "x", 6, 4.0, 3.0),
        ],
    )
    assert rows(top2_strips(df), "event_id", "c0", "c1", "id0", "id1") == [
        (1, 9.0, None, 4, None),
        (2, 7.0, 7.0, 3, 5),
        (3, 8.0, 5.0, 2, 3),
        (4, 5.0, 4.0, 6, 6),
    ]


def test_strip_position_formula(spark):
    strips = spark.createDataFrame(
        [(1, 3.0, 2.0, 10, 11), (2, 3.0, 2.0, 10, 9), (3, 5.0, None, 10, None), (4, 3.0, 1.0, 10, 12)],
        "event_id long, c0 double, c1 double, id0 long, id1 long",
    )
    curve = spark.createDataFrame(
        [("any", 0.0, 0.0), ("any", 0.4, 1.0)], "table string, x double, y double"
    )
    got = {r.event_id: (r.pos, r.c0c1_conv) for r in
           strip_position(strips, curve, 8.0, 2.0, offset=1.0, turned=True).collect()}
    # asymmetry 0.2 -> shared 0.5 -> a quarter strip towards the neighbour
    assert got[1] == pytest.approx((-((10 - 8 + 0.25) * 2.0 - 1.0), 0.5))
    assert got[2] == pytest.approx((-((10 - 8 - 0.25) * 2.0 - 1.0), 0.5))
    assert got[3] == (None, None)
    assert got[4] == pytest.approx((-((10 - 8) * 2.0 - 1.0), 1.0))
    straight = strip_position(strips, curve, 8.0, 2.0).filter("event_id = 1").collect()[0]
    assert straight.pos == pytest.approx((10 - 8 + 0.25) * 2.0)


def test_collected_arrays_are_aligned_and_null_when_empty(spark):
    df = _pulses(
        spark, [(1, "x", 2, 5.0, 9.0), (1, "x", 1, 6.0, 3.0), (2, "y", 1, 1.0, 1.0), (3, "z", 1, 1.0, 1.0)]
    )
    planes = {"x": ["id", "timing", "charge"], "y": ["timing"]}
    assert rows(collect_planes(df, planes)) == [
        (1, [1, 2], [3.0, 9.0], [6.0, 5.0], None),
        (2, None, None, None, [1.0]),
    ]


def test_assemble_left_and_required(spark):
    events = spark.createDataFrame([(1,), (1,), (2,)], "event_id long")
    parts = {
        "a": spark.createDataFrame([(1, 10)], "event_id long, a long"),
        "b": spark.createDataFrame([(2, 20)], "event_id long, b long"),
    }
    assert rows(assemble(events, parts)) == [(1, 10, None), (2, None, 20)]
    assert rows(assemble(events, parts, require="a")) == [(1, 10, None)]


def test_trigger_takes_the_earliest(spark):
    hits = spark.createDataFrame(
        [(1, 5, 2.0), (1, 3, 1.0), (2, 9, 4.0), (2, 8, 4.0)], "event_id long, id long, value double"
    )
    assert rows(trigger_table(hits)) == [(1, 3), (2, 8)]
    assert rows(trigger_table(hits, full=True)) == [
        (1, [3, 5], [1.0, 2.0], 3),
        (2, [8, 9], [4.0, 4.0], 8),
    ]
