"""Result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.schema import EVENT_KEY


def write_events(df: DataFrame, path: str) -> None:
    """Replace the Parquet table at `path`."""
    df.write.mode("overwrite").parquet(path)


def write_event_table(df: DataFrame, table: str, buckets: int, event_key: str = EVENT_KEY) -> None:
    """Save `df` as a table bucketed by event.

    Raw events stored this way are already laid out for every later run: the plans take such a table
    with ``clustered=True`` and shuffle nothing.
    """
    df.repartition(buckets, event_key).write.mode("overwrite").format("parquet").bucketBy(
        buckets, event_key
    ).saveAsTable(table)


def to_kafka_rows(df: DataFrame, event_key: str = EVENT_KEY) -> DataFrame:
    """Rows shaped for a Kafka sink: the event as key, the whole row as JSON value."""
    return df.select(
        F.col(event_key).cast("string").alias("key"),
        F.to_json(F.struct(*df.columns)).alias("value"),
    )
