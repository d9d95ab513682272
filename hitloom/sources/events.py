"""Raw events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitloom.schema import EVENT_KEY, HIT_COUNT, RAW_EVENT


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Nested raw events from Parquet, with the declared schema (no footer inference)."""
    return spark.read.schema(RAW_EVENT).parquet(path)


def read_hit_keys(spark: SparkSession, path: str, event_key: str = EVENT_KEY) -> DataFrame:
    """``event, _hits``: the number of hits of each stored row that has any, from two columns of the file.

    Enough to know which events have hits and how many; the rest of the hits is not read, and arrays are
    measured where they lie, not taken apart.
    """
    hit = T.StructType([T.StructField("geo", T.LongType())])
    segment = T.StructType([T.StructField("hits", T.ArrayType(hit))])
    schema = T.StructType(
        [RAW_EVENT[event_key], T.StructField("segdata", T.ArrayType(segment))]
    )
    events = spark.read.schema(schema).parquet(path)
    size = F.aggregate(
        "segdata",
        F.lit(0).cast("long"),
        lambda total, s: total + F.when(s["hits"].isNull(), 0).otherwise(F.size(s["hits"])),
    )
    return events.select(event_key, size.alias(HIT_COUNT)).filter(F.col(HIT_COUNT) > 0)
