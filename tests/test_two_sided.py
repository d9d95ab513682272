import math
import random

import pytest

from hitloom.operators import two_sided
from tests.conftest import PULSE, rows


def test_window_limits_are_included(spark):
    left = spark.createDataFrame([(1, "L", 0, 4.0, 100.0)], PULSE)
    right = spark.createDataFrame(
        [(1, "R", 0, 1.0, 90.0), (1, "R", 0, 2.0, 110.0), (1, "R", 0, 3.0, 89.9), (1, "R", 0, 3.0, 110.1),
         (1, "R", 1, 9.0, 100.0), (2, "R", 0, 9.0, 100.0)],
        PULSE,
    )
    got = two_sided(left, right, "s", (-10.0, 10.0)).collect()
    assert len(got) == 1
    row = got[0]
    assert row.s_id == 0
    assert row.s_tdiff == [-10.0, 10.0]
    assert row.s_tavg == [105.0, 95.0]
    assert row.s_qdiff == [2.0, 3.0]
    assert row.s_qavg == [3.0, 2.5]
    assert row.s_qlog == pytest.approx([math.log(2), math.log(4)])
    assert row.s_qsqsum == pytest.approx([math.sqrt(8), 2.0])
    compat = two_sided(left, right, "s", (-10.0, 10.0), compat=True).collect()[0]
    assert compat.s_tavg == [155.0, 145.0]
    assert compat.s_qavg == [5.0, 4.5]


@pytest.mark.parametrize("window", [(-3.0, 3.0), (-0.25, 7.5), (2.0, 5.0), (0.0, 0.0)])
def test_matches_equal_brute_force(spark, window):
    random.seed(11)

    def side(cat):
        return [
            (random.randrange(6), cat, random.randrange(2), float(random.randrange(1, 50)),
             random.randrange(160) / 4)
            for _ in range(250)
        ]

    left, right = side("L"), side("R")
    low, high = window
    expected = {}
    for e, _, i, q, t in left:
        for e2, _, i2, q2, t2 in right:
            if (e, i) == (e2, i2) and low <= t - t2 <= high:
                expected.setdefault((e, i), []).append((t - t2, q - q2))
    df = two_sided(spark.createDataFrame(left, PULSE), spark.createDataFrame(right, PULSE), "s", window)
    got = {(r.event_id, r.s_id): sorted(zip(r.s_tdiff, r.s_qdiff)) for r in df.collect()}
    assert got == {key: sorted(pairs) for key, pairs in expected.items()}


def test_one_side_only_gives_nothing(spark):
    left = spark.createDataFrame([(1, "L", 0, 4.0, 100.0)], PULSE)
    assert rows(two_sided(left, left.limit(0), "s", (-10.0, 10.0))) == []
