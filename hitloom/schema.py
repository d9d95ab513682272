"""Schemas and key lists shared by all operators."""

from __future__ import annotations

from pyspark.sql import types as T

EVENT_KEY = "event_id"
# Hits of a row that stands for several.
HIT_COUNT = "_hits"
MODULE_KEY = ["dev", "fp", "det", "geo"]
CHANNEL_KEY = [*MODULE_KEY, "ch"]


def _longs(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.LongType()) for name in names]


HIT = T.StructType(_longs("geo", "ch", "value", "edge"))

SEGMENT = T.StructType(
    _longs("dev", "fp", "mod", "det") + [T.StructField("hits", T.ArrayType(HIT))]
)

RAW_EVENT = T.StructType(
    _longs("event_id", "runnumber", "ts") + [T.StructField("segdata", T.ArrayType(SEGMENT))]
)

# The key columns are read as integers and widened to long so that they join with the raw fields
# without a cast on the big side.
CHANNEL_MAP_UNNAMED = T.StructType(_longs("id", *CHANNEL_KEY))
CHANNEL_MAP = T.StructType([T.StructField("cat", T.StringType()), *CHANNEL_MAP_UNNAMED.fields])

CURVE_POINT = T.StructType(
    [T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]
)

# Columns of a Kafka-shaped record that travel with a decoded event.
STREAM_TIME = "stream_uts"
