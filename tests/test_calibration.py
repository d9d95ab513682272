import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hitloom.operators import interpolate, linear_calib, linear_calib_array, to_float
from hitloom.sources.curves import drop_plateaus
from hitloom.operators import curves as curve_module
from tests.conftest import plan_tree, rows


def test_mid_dither_is_linear(spark):
    df = spark.createDataFrame([(3, "k"), (None, "k")], "value long, name string")
    assert rows(to_float(df, "value", offset=1.0, factor=2.0, dither="mid")) == [(8.0, "k"), (None, "k")]


def test_hash_dither_repeats_and_stays_in_the_channel(spark):
    df = spark.range(5000).selectExpr("id", "id % 100 AS a", "id % 100 AS b")
    first = to_float(df, ["a", "b"], keys=["id"])
    again = to_float(df.repartition(7), ["a", "b"], keys=["id"])
    assert rows(first) == rows(again)
    parts = first.join(df.withColumnsRenamed({"a": "a0", "b": "b0"}), "id").selectExpr(
        "a - a0 AS u", "b - b0 AS w"
    )
    units = [(r.u, r.w) for r in parts.collect()]
    assert all(0 <= u < 1 and 0 <= w < 1 for u, w in units)
    assert abs(sum(u for u, _ in units) / 5000 - 0.5) < 0.02
    assert any(u != w for u, w in units)


def test_rand_dither_and_unknown(spark):
    df = spark.range(100).selectExpr("id AS value")
    drawn = to_float(df, "value", dither="rand", seed=1).select((F.col("value") % 1).alias("u"))
    assert drawn.distinct().count() > 90
    with pytest.raises(ValueError):
        to_float(df, "value", dither="none")
    with pytest.raises(ValueError):
        to_float(df, "value", keys=[])


def test_linear_calibration_scalar_and_array(spark):
    coefficients = spark.createDataFrame([(1, 0.5, 2.0)], "id long, p0 double, p1 double")
    scalar = spark.createDataFrame([(1, 10.0), (2, 10.0), (1, None)], "id long, charge double")
    assert rows(linear_calib(scalar, coefficients)) == [(1, 20.5), (1, None), (2, None)]
    array = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0]), (1, [])], "id long, charge array<double>")
    assert rows(linear_calib_array(array, coefficients)) == [
        (1, [2.5, 4.5]), (1, []), (2, [None]),
    ]
    renamed = coefficients.withColumnsRenamed({"p0": "offset", "p1": "gain"})
    assert rows(linear_calib(scalar, renamed, p0="offset", p1="gain"), "charge")[0] == (20.5,)


def _curve(spark, table, xs, ys):
    return spark.createDataFrame(
        [(table, float(x), float(y)) for x, y in zip(xs, ys)], "table string, x double, y double"
    )


@pytest.mark.parametrize("threshold", [None, 3])
def test_interpolation_equals_numpy(spark, threshold, monkeypatch):
    if threshold is not None:
        monkeypatch.setattr("hitloom.operators.curves.BROADCAST_ROWS", threshold)
    random.seed(5)
    tables = {}
    for name, n in (("a", 2), ("b", 40), ("c", 400), ("one", 1)):
        xs = sorted(random.sample(range(10000), n))
        ys = np.cumsum([random.random() for _ in range(n)])
        tables[name] = (np.array(xs) / 10000.0, ys)
    points = None
    for name, (xs, ys) in tables.items():
        part = _curve(spark, name, xs, ys)
        points = part if points is None else points.union(part)
    queries = []
    for name, (xs, _) in tables.items():
        values = [None, -1.0, 2.0, *xs[:50], *[random.random() for _ in range(200)]]
        queries += [(name, i, None if v is None else float(v)) for i, v in enumerate(values)]
    queries.append(("missing", 0, 0.5))
    df = spark.createDataFrame(queries, "table string, i long, v double")
    got = {(r.table, r.i): r.y for r in interpolate(df, points, "v", "y").collect()}
    assert len(got) == len(queries)
    for name, i, v in queries:
        if v is None or name == "missing":
            assert got[name, i] is None
        else:
            assert got[name, i] == pytest.approx(float(np.interp(v, *tables[name])), abs=1e-12)


@pytest.mark.parametrize("bound", [None, 10])
def test_uneven_curves_take_one_join(spark, monkeypatch, bound):
    if bound:
        monkeypatch.setattr(curve_module, "BROADCAST_ROWS", bound)
    dense = [("dense", 1.0 + i / 1e6, float(i)) for i in range(20_000)]
    wide = [("wide", -1e6, 0.0), ("wide", 1e6, 1.0)]
    # most points of this one crowd at one end
    bent = [("bent", 10.0 ** (-6 + 8 * i / 2000), float(i)) for i in range(2000)]
    odd = [("odd", None, 5.0), ("odd", 1.0, 1.0), ("odd", 1.0, 2.0), ("odd", 3.0, 4.0), ("none", None, 1.0)]
    points = spark.createDataFrame(dense + wide + bent + odd, "table string, x double, y double")
    values = [(t, 1.0 + i / 997e3) for i in range(500) for t in ("dense", "wide", "bent")]
    df = spark.createDataFrame(values, "table string, v double")
    curves = {n: ([p[1] for p in c], [p[2] for p in c]) for n, c in (("dense", dense), ("wide", wide), ("bent", bent))}
    found = interpolate(df, points, "v", "y")
    tree = plan_tree(found)
    assert tree.count("Join") == 1 and "Window" not in tree and ("Broadcast" in tree) == (bound is None)
    for r in found.collect():
        assert r.y == pytest.approx(float(np.interp(r.v, *curves[r.table])), abs=1e-6)
    edge = spark.createDataFrame([("odd", 0.0), ("odd", 1.0), ("odd", 2.0), ("odd", 9.0), ("none", 1.0)], "table string, v double")
    assert [r.y for r in interpolate(edge, points, "v", "y").orderBy("table", "v").collect()] == [None, 1.0, 2.0, 3.0, 4.0]


def test_plateaus_keep_their_first_point(spark):
    points = _curve(spark, "t", [0.0, 0.1, 0.2, 0.4, 1.0], [0.0, 0.5, 0.5, 1.0, 1.0])
    assert rows(drop_plateaus(points)) == [("t", 0.0, 0.0), ("t", 0.1, 0.5), ("t", 0.4, 1.0)]
    df = spark.createDataFrame([("t", 0.7), ("t", 0.1), ("t", float("nan"))], "table string, v double")
    values = [r.y for r in interpolate(df, drop_plateaus(points), "v", "y").collect()]
    assert sorted(v for v in values if not math.isnan(v)) == [0.5, 1.0]
    assert any(math.isnan(v) for v in values)
