import random

import numpy as np
import pytest

from hitloom.operators import hist1d, hist1d_stats, hist2d, hist2d_stats, zip_arrays
from tests.conftest import rows


def _column(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v double")


def test_points_rule(spark):
    df = _column(spark, [None, -1.0, 0.0, 0.5, 1.0, 2.0, 2.5, 3.0, float("inf"), float("-inf")])
    got = rows(hist1d(df, "v", 4, (0.0, 3.0), outer=True), "bin", "lo", "hi", "center", "n")
    assert got == [
        (0, None, 0.0, None, 2),
        (1, 0.0, 1.0, 0.5, 2),
        (2, 1.0, 2.0, 1.5, 1),
        (3, 2.0, 3.0, 2.5, 2),
        (4, 3.0, None, None, 2),
    ]
    assert rows(hist1d_stats(df, "v", 4, (0.0, 3.0))) == [(9, 2, 5, 2)]


def test_nan_is_an_error_unless_dropped(spark):
    df = _column(spark, [1.0, float("nan")])
    with pytest.raises(Exception, match="NaN"):
        hist1d(df, "v", 4, (0.0, 3.0)).collect()
    assert sum(r.n for r in hist1d(df, "v", 4, (0.0, 3.0), nan="drop").collect()) == 1
    assert sum(r.n for r in hist1d(df, "v", 3, (0.0, 3.0), edges="numpy").collect()) == 1


@pytest.mark.parametrize("low, high, bins", [(0.0, 1.0, 10), (-0.3, 0.7, 49), (0.1, 104.3, 7)])
def test_values_on_edges_follow_the_edge_list(spark, low, high, bins):
    random.seed(bins)
    edges = np.linspace(low, high, bins + 1)
    values = [*edges, *np.nextafter(edges, -1e9), *np.nextafter(edges, 1e9)]
    values += [random.uniform(low - 0.1, high + 0.1) for _ in range(2000)]
    df = _column(spark, [float(v) for v in values])
    inside = [v for v in values if low <= v <= high]
    numpy_counts, _ = np.histogram(inside, bins=edges)
    got = [n for _, n in rows(hist1d(df, "v", bins, (low, high), edges="numpy").select("center", "n"), "center", "n")]
    got = [r.n for r in hist1d(df, "v", bins, (low, high), edges="numpy").orderBy("bin").collect()]
    assert got == list(numpy_counts)
    half_open = np.bincount(
        [i for i in np.searchsorted(edges, [v for v in values], side="right") if 0 < i <= bins],
        minlength=bins + 1,
    )[1:]
    got = [r.n for r in hist1d(df, "v", bins + 1, (low, high)).orderBy("bin").collect()]
    assert got == list(half_open)


def test_arrays_and_empty_bins(spark):
    df = spark.createDataFrame([([0.5, 2.5],), ([],), (None,), ([0.6, None],)], "a array<double>")
    assert rows(hist1d(df, "a", 4, (0.0, 3.0), array=True), "bin", "n") == [(1, 2), (2, 0), (3, 1)]
    got = hist1d(df, "a", 3, (0.0, 3.0), array=True, edges="numpy")
    assert rows(got, "bin", "n") == [(1, 2), (2, 0), (3, 1)]


def test_zip_pairs_to_the_shorter_array(spark):
    df = spark.createDataFrame(
        [([1.0, 2.0, 3.0], [10.0, 20.0]), ([], [1.0]), (None, [1.0]), ([7.0], None)],
        "x array<double>, y array<double>",
    )
    assert rows(zip_arrays(df, "x", "y")) == [(1.0, 10.0), (2.0, 20.0)]


def test_2d_matrix_and_zones(spark):
    data = [(0.5, 0.5), (0.5, 1.5), (1.5, 0.5), (0.5, 0.5), (-1.0, 0.5), (0.5, 2.0), (2.0, 2.0),
            (None, 1.0), (1.0, None)]
    df = spark.createDataFrame(data, "x double, y double")
    span = ((0.0, 2.0), (0.0, 2.0))
    got = hist2d(df, ("x", "y"), (3, 3), span)
    assert rows(got) == [(1, 1, 0.5, 0.5, 2), (1, 2, 0.5, 1.5, 1), (2, 1, 1.5, 0.5, 1)]
    dense = rows(hist2d(df, ("x", "y"), (3, 3), span, dense=True), "bin_x", "bin_y", "n")
    assert dense == [(1, 1, 2), (1, 2, 1), (2, 1, 1), (2, 2, 0)]
    zones = {(r.zone_x, r.zone_y): r.n for r in hist2d_stats(df, ("x", "y"), (3, 3), span).collect()}
    assert len(zones) == 9
    assert {k: v for k, v in zones.items() if v} == {(1, 1): 4, (0, 1): 1, (1, 2): 1, (2, 2): 1}
    closed = rows(hist2d(df, ("x", "y"), (2, 2), span, edges="numpy"), "bin_x", "bin_y", "n")
    assert closed == [(1, 1, 2), (1, 2, 2), (2, 1, 1), (2, 2, 1)]


def test_2d_equals_numpy_on_arrays(spark):
    random.seed(2)
    data = [
        ([random.gauss(0, 2) for _ in range(5)], [random.gauss(1, 2) for _ in range(5)])
        for _ in range(200)
    ]
    df = spark.createDataFrame(data, "x array<double>, y array<double>")
    span = ((-3.0, 3.0), (-2.0, 4.0))
    cells = hist2d(df, ("x", "y"), (6, 5), span, array=True, edges="numpy", dense=True).collect()
    xs = [v for x, _ in data for v in x]
    ys = [v for _, y in data for v in y]
    expected, _, _ = np.histogram2d(xs, ys, bins=(6, 5), range=span)
    got = np.zeros((6, 5))
    for r in cells:
        got[r.bin_x - 1, r.bin_y - 1] = r.n
    assert (got == expected).all()


def test_bad_arguments(spark):
    df = _column(spark, [1.0])
    with pytest.raises(ValueError):
        hist1d(df, "v", 1, (0.0, 1.0))
    with pytest.raises(ValueError):
        hist1d(df, "v", 5, (0.0, 1.0), edges="other")
    with pytest.raises(ValueError):
        hist1d(df, "v", 5, (0.0, 1.0), nan="other")
