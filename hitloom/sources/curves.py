"""Monotone conversion curves."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.schema import CURVE_POINT


def drop_plateaus(points: DataFrame) -> DataFrame:
    """One point per (table, y): the one with the smallest x."""
    return points.groupBy("table", "y").agg(F.min("x").alias("x")).select("table", "x", "y")


def _read_points(spark: SparkSession, path: str, table: str) -> DataFrame:
    points = (
        spark.read.schema(CURVE_POINT)
        .option("header", True)
        .option("comment", "#")
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .csv(path)
    )
    return points.select(F.lit(table).alias("table"), "x", "y")


def read_curve(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Points ``(table, x, y)`` of one ``x,y`` CSV, plateaus reduced to their first point."""
    return drop_plateaus(_read_points(spark, path, table))


def read_curves(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """All curves of a run in one table, keyed by the names in `paths`; one aggregation reduces the
    plateaus of all of them."""
    points = [_read_points(spark, path, table) for table, path in paths.items()]
    return drop_plateaus(reduce(DataFrame.unionByName, points))
