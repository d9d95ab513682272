"""Kafka-shaped records whose value is an Arrow IPC stream of raw events."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitloom.schema import RAW_EVENT

def _arrow_type(spark_type: T.DataType) -> pa.DataType:
    if isinstance(spark_type, T.ArrayType):
        return pa.list_(_arrow_type(spark_type.elementType))
    if isinstance(spark_type, T.StructType):
        return pa.struct([(f.name, _arrow_type(f.dataType)) for f in spark_type.fields])
    return pa.int64()


RAW_EVENT_ARROW = pa.schema([(f.name, _arrow_type(f.dataType)) for f in RAW_EVENT.fields])

# Decoded rows are handed on after this many, or after messages of so many bytes, so that one batch of messages is
# never held decoded; a longer message stands alone.
_FLUSH_ROWS = 512
_FLUSH_BYTES = 2_000_000


def decode_events(messages: DataFrame, value: str = "value", rows: str = "all") -> DataFrame:
    """Raw events held in the binary column `value`; the other columns are repeated per event.

    Every event of a message is taken; only a caller that asks for it gets less: ``rows="first"`` the
    first event of a message, ``"batch"`` all events of its first record batch.  Null, empty and
    eventless messages give no row.  Fields are matched by name at every level, in any order and width;
    missing ones are null.  Works on batch and streaming input.
    """
    if rows not in ("first", "batch", "all"):
        raise ValueError(f"unknown row choice {rows!r}")
    carried = [field for field in messages.schema.fields if field.name != value]
    names = [field.name for field in carried]
    output = T.StructType([*RAW_EVENT.fields, *carried])
    schema, flush_rows, flush_bytes = RAW_EVENT_ARROW, _FLUSH_ROWS, _FLUSH_BYTES

    # The helpers are local so that they travel with the task; workers need pyarrow only.
    def read(buffer: pa.Buffer) -> pa.Table | None:
        with pa.ipc.open_stream(buffer) as reader:
            if rows == "batch":
                try:
                    return pa.Table.from_batches([reader.read_next_batch()])
                except StopIteration:
                    return None
            table = reader.read_all()
        return table.slice(0, 1) if rows == "first" else table

    def fitted(column: pa.Array, kind: pa.DataType) -> pa.Array:
        """`column` as `kind`, rebuilt by name from its Arrow arrays."""
        if column.type.equals(kind):
            return column
        if pa.types.is_struct(kind):
            have = {field.name for field in column.type}
            children = [
                fitted(pc.struct_field(column, field.name), field.type)
                if field.name in have
                else pa.nulls(len(column), field.type)
                for field in kind
            ]
            return pa.StructArray.from_arrays(children, fields=list(kind), mask=column.is_null())
        if pa.types.is_list(kind):
            ends = pc.cumulative_sum(pc.fill_null(pc.list_value_length(column), 0).cast(pa.int32()))
            offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends])
            values = fitted(column.flatten(), kind.value_type)
            return pa.ListArray.from_arrays(offsets, values, mask=column.is_null())
        return column.cast(kind)

    def as_events(table: pa.Table) -> pa.Table:
        """`table` with exactly the raw event fields, matched by name at every level."""
        if table.schema.equals(schema):
            return table
        names = set(table.schema.names)
        columns = []
        for field in schema:
            if field.name in names:
                chunks = [fitted(chunk, field.type) for chunk in table.column(field.name).chunks]
                columns.append(pa.chunked_array(chunks, field.type))
            else:
                columns.append(pa.nulls(table.num_rows, field.type))
        return pa.table(columns, schema=schema)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            decoded: list[pa.Table] = []
            origin: list[int] = []
            size = 0

            def flush() -> Iterator[pa.RecordBatch]:
                table = pa.concat_tables(decoded)
                context = batch.select(names).take(pa.array(origin, pa.int64()))
                for name, column in zip(names, context.columns):
                    table = table.append_column(name, pa.chunked_array([column]))
                yield from table.combine_chunks().to_batches()

            for index, message in enumerate(batch.column(value)):
                if not message.is_valid or len(message.as_buffer()) == 0:
                    continue
                table = read(message.as_buffer())
                if table is None or table.num_rows == 0:
                    continue
                if origin and size + len(message.as_buffer()) > flush_bytes:
                    yield from flush()
                    decoded.clear()
                    origin.clear()
                    size = 0
                decoded.append(as_events(table))
                origin.extend([index] * table.num_rows)
                size += len(message.as_buffer())
                if len(origin) >= flush_rows:
                    yield from flush()
                    decoded.clear()
                    origin.clear()
                    size = 0
            if origin:
                yield from flush()

    return messages.select(value, *names).mapInArrow(decode, output)


def capture_messages(
    messages: DataFrame,
    count: int,
    first: int,
    partition: int = 0,
    rows: str = "all",
) -> DataFrame:
    """Events of the first `count` non-empty messages of one partition from offset `first` on.

    Only offsets are sorted to find the last message wanted; the payloads are then filtered where they
    lie.
    """
    source = messages.filter(F.col("partition") == partition)
    filled = source.filter(F.octet_length("value") > 0)
    wanted = filled.filter(F.col("offset") >= first)
    last = wanted.select("offset").orderBy("offset").limit(count).agg(F.max("offset")).scalar()
    return decode_events(wanted.filter(F.col("offset") <= last).select("value"), rows=rows)


def offset_summary(messages: DataFrame, topic: str) -> DataFrame:
    """End offset of each partition of `topic` and the largest over all partitions.

    Reading the result of an unknown topic fails.
    """
    ends = (
        messages.filter(F.col("topic") == topic)
        .groupBy("topic", "partition")
        .agg((F.max("offset") + 1).alias("end_offset"))
        .withColumn("latest_offset", F.max("end_offset").over(Window.partitionBy("topic")))
    )
    unknown = F.raise_error(F.lit(f"topic {topic} does not exist or has no partitions"))
    # The left side has one row, so an unknown topic leaves a row that raises.
    wanted = messages.sparkSession.createDataFrame([(topic,)], "topic string")
    return wanted.join(ends, "topic", "left").select(
        "topic",
        "partition",
        "end_offset",
        F.coalesce("latest_offset", unknown.cast("long")).alias("latest_offset"),
    )
