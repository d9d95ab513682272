"""Piecewise linear conversion curves: one row a curve, searched by bisection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.sizing import BROADCAST_ROWS


def curve_arrays(points: DataFrame) -> DataFrame:
    """``table, _xs, _ys``: each curve in one row, its points ordered by x, then y.  A point without x is none."""
    ordered = F.sort_array(F.collect_list(F.struct("x", "y"))).alias("_points")
    curves = points.filter(F.col("x").isNotNull()).groupBy("table").agg(ordered)
    return curves.select("table", F.col("_points.x").alias("_xs"), F.col("_points.y").alias("_ys"))


@dataclass(frozen=True)
class Curves:
    """Curves in rows (``_curve, _xs, _ys``), whether they are few, and the points of the longest."""

    rows: DataFrame
    small: bool
    longest: int


def read_curve_points(points: DataFrame) -> Curves:
    """Curves ready for :func:`look_up`.

    At most ``BROADCAST_ROWS + 1`` points are fetched; if that is all of them they are read no more.
    """
    points = points.select("table", "x", "y")
    head = points.limit(BROADCAST_ROWS + 1).toArrow()
    small = head.num_rows <= BROADCAST_ROWS
    if small:
        numbers = head.column("table").combine_chunks().value_counts().field("counts").to_pylist()
        longest = max(numbers, default=0)
        # a table known to be small needs no shuffle to be grouped
        points = points.sparkSession.createDataFrame(head, points.schema).coalesce(1)
    else:
        longest = points.groupBy("table").agg(F.count("x").alias("n")).agg(F.max("n")).first()[0]
    return Curves(curve_arrays(points).withColumnRenamed("table", "_curve"), small, longest)


def curve_value(value: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Value of a curve between two neighbouring points: level below the first and from the last one on,
    where `x1` is null; null for null, NaN for NaN."""
    slope = (y1 - y0) / (x1 - x0)
    return (
        F.when(value.isNull() | F.isnan(value), value)
        .when((value < x0) | x1.isNull() | (y1 == y0), y0)
        .otherwise(y0 + slope * (value - x0))
    )


def look_up(df: DataFrame, curves: Curves, x: str, output: str, table: str) -> DataFrame:
    """:func:`interpolate` with curves that are ready."""
    placed = df.withColumns({"_v": F.col(x).cast("double"), "_of": F.col(table)})
    rows = F.broadcast(curves.rows) if curves.small else curves.rows
    placed = placed.join(rows, F.col("_of") == F.col("_curve"), "left").withColumn("_at", F.lit(0))
    step = 1 << max(curves.longest - 1, 0).bit_length() >> 1
    while step:
        further = F.get("_xs", F.col("_at") + step) <= F.col("_v")
        placed = placed.withColumn("_at", F.when(further, F.col("_at") + step).otherwise(F.col("_at")))
        step >>= 1
    ends = [F.get(axis, F.col("_at") + i) for i in (0, 1) for axis in ("_xs", "_ys")]
    return placed.select(*[F.col(c) for c in df.columns], curve_value(F.col("_v"), *ends).alias(output))


def interpolate(
    df: DataFrame, points: DataFrame, x: str, output: str, table: str = "table"
) -> DataFrame:
    """Add `output`, the value at `x` of the curve named in column `table`.

    Linear between the points, the end value outside, null for null or for an unknown curve.  A row meets its
    curve by one equality join, so rows are neither lost nor repeated, and finds the last point not above
    it by bisection: each step is one comparison with an element of the sorted array, and there are as many
    as the longest curve needs.  Curves are broadcast as long as all their points are few.
    """
    return look_up(df, read_curve_points(points), x, output, table)
