"""Event streams: the batch plans run on each micro-batch of whole events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hitloom.operators.hits import explode_hits
from hitloom.schema import EVENT_KEY, STREAM_TIME
from hitloom.sinks import CommittedBatches
from hitloom.sources.messages import decode_events

# How late a repeated event may come; fixed value.
LATENESS = "10 seconds"

# Where the keys of seen events are kept: RocksDB with a bounded block cache and write buffers.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "512",
}


def read_kafka(
    spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest"
) -> DataFrame:
    """The stream of one topic; needs Spark's Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .load()
    )


def decode_stream(messages: DataFrame, rows: str = "all") -> DataFrame:
    """Nested events with ``stream_uts`` from Kafka-shaped records (``value``, ``timestamp``).

    The events stay nested: an event is one row of a message, so a micro-batch always holds its hits
    together.
    """
    records = messages.select("value", F.col("timestamp").alias(STREAM_TIME))
    return decode_events(records, rows=rows)


def use_bounded_state(spark: SparkSession) -> None:
    """Keep the state of streams that are started from now on in RocksDB: on disk, with a bounded cache and
    change logs in the checkpoint, from which another executor goes on.  A running stream keeps its store."""
    for name, value in STATE_SETTINGS.items():
        spark.conf.set(name, value)


def state_size(query: StreamingQuery) -> dict[str, int]:
    """Rows and bytes of memory that the state of a query held after its last batch, as its store counts them."""
    progress = query.lastProgress
    operators = progress["stateOperators"] if progress else []
    return {
        "rows": sum(o["numRowsTotal"] for o in operators),
        "bytes": sum(o["memoryUsedBytes"] for o in operators),
    }


def unique_events(
    events: DataFrame, lateness: str = LATENESS, event_key: str = EVENT_KEY
) -> DataFrame:
    """Drop repeats of an event that arrive within `lateness` of each other."""
    return events.withWatermark(STREAM_TIME, lateness).dropDuplicatesWithinWatermark([event_key])


def event_origin(events: DataFrame, event_key: str = EVENT_KEY) -> DataFrame:
    """Run number and arrival time of each event, of the copy that came first."""
    first = F.min(F.struct(STREAM_TIME, "runnumber")).alias("_first")
    return events.groupBy(event_key).agg(first).select(
        event_key, "_first.runnumber", f"_first.{STREAM_TIME}"
    )


def run_stream(
    events: DataFrame,
    plan: Callable[[DataFrame], DataFrame],
    output: str,
    checkpoint: str,
    dedup: bool = False,
    lateness: str = LATENESS,
    event_key: str = EVENT_KEY,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write ``plan(hits)`` of each micro-batch, with run number and arrival time, to `output`.

    Each attempt at a batch has a folder of its own and counts once it stands in the table's list of commits
    (:class:`hitloom.sinks.CommittedBatches`), which :func:`hitloom.sinks.read_committed` follows.  A batch that
    is replayed after its commit is not written again; one that died before it leaves a folder nobody reads.
    """
    if dedup:
        events = unique_events(events, lateness, event_key)

    def process(batch: DataFrame, batch_id: int) -> None:
        commits = CommittedBatches(batch.sparkSession, output)
        if commits.has(batch_id):
            return
        # Read by the plan and for the origin: decode the messages once.
        batch = batch.persist()
        try:
            result = plan(explode_hits(batch, event_key))
            result = result.join(event_origin(batch, event_key), event_key, "left")
            commits.write(result, batch_id)
        finally:
            batch.unpersist()

    if dedup:
        use_bounded_state(events.sparkSession)
    writer = events.writeStream.foreachBatch(process).outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint)
    if trigger is not None:
        writer = writer.trigger(**trigger)
    return writer.start()


def run_local(
    events: DataFrame,
    plan: Callable[[DataFrame], DataFrame],
    output: str,
    checkpoint: str,
    dedup: bool = False,
    lateness: str = LATENESS,
    event_key: str = EVENT_KEY,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append ``plan(events)`` to the Parquet table `output`, for plans that keep an event in its row
    (:mod:`hitloom.plans.local`).

    There is no batch function: the rows of a batch go from the source to the file in one stage, and the file
    sink's log shows readers whole batches only.
    """
    if dedup:
        use_bounded_state(events.sparkSession)
        events = unique_events(events, lateness, event_key)
    writer = plan(events).writeStream.format("parquet").outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint).option("path", output)
    if trigger is not None:
        writer = writer.trigger(**trigger)
    return writer.start()
