"""Detector-shaped data derived from the given tables, as Spark DataFrames.

``hits`` and ``chmap`` are the views of FIXTURES.md; the SQL twins are in ``workload.oracle``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.schema import RAW_EVENT
from hitloom.sources.messages import RAW_EVENT_ARROW

HIT_COLUMNS = ["event_id", "dev", "fp", "det", "geo", "ch", "value", "edge"]
MAP_SCHEMA = "cat string, id long, dev long, fp long, det long, geo long, ch long"
CURVE = [(0.0, 0.0), (0.4, 1.0), (1.0, 1.0)]
# Device, focal plane and detector of the mapped modules; invented.
MODULE = (20, 4, 50)
PLANES = ["p0a", "p0x", "p0y", "p1a", "p1x", "p1y"]


# The columns used of the large table; naming them saves a look into the file for each query.
LINEITEM = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_tax double, l_returnflag string, l_linestatus string"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(LINEITEM) if name == "lineitem" else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def _detector_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag, line = F.col("l_returnflag"), F.col("l_linenumber")
    block = F.when(flag == "A", 0).when(flag == "N", 1).otherwise(2)
    return table(spark, sf_dir, "lineitem").select(
        F.floor(F.col("l_orderkey") / 10.0).cast("long").alias("event_id"),
        (F.col("l_suppkey") % 2).cast("long").alias("geo"),
        (1 + 3 * block + line % 3).cast("long").alias("ch"),
        F.round("l_extendedprice").cast("long").alias("value"),
        F.when(F.col("l_linestatus") == "F", 0).otherwise(1).cast("long").alias("edge"),
    )


def _reference_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    event, geo = F.col("event_id"), F.col("geo")
    modules = _detector_hits(spark, sf_dir).select("event_id", "geo").distinct()
    start = (event * 37 + geo * 11) % 1000

    def hit(value, edge, condition):
        made = F.struct(value.alias("value"), F.lit(edge).cast("long").alias("edge"))
        return F.when(condition, made)

    made = F.array(
        hit(start, 0, event % 17 != 0), hit(start + 5, 0, event % 23 == 0), hit(start + 9, 1, F.lit(True))
    )
    return modules.select("event_id", "geo", F.inline(F.array_compact(made))).select(
        "event_id", "geo", F.lit(0).cast("long").alias("ch"), "value", "edge"
    )


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat hits: detector hits from ``lineitem``, reference hits per event and module, and hits of
    modules that differ from the mapped ones in one of device, focal plane and detector only."""
    flat = _detector_hits(spark, sf_dir).unionByName(_reference_hits(spark, sf_dir))
    flat = flat.select("event_id", *_module(), "geo", "ch", "value", "edge")
    modules = _detector_hits(spark, sf_dir).select("event_id", "geo").distinct()
    others = F.explode(F.array(*[F.struct(*_module(*step)) for step in ((1, 0, 0), (0, 1, 0), (0, 0, 1))]))
    near = modules.select("event_id", "geo", others.alias("module")).select(
        "event_id",
        "module.*",
        "geo", F.explode(F.array(F.lit(0).cast("long"), F.lit(4).cast("long"))).alias("ch"),
        F.lit(7).cast("long").alias("value"), F.lit(0).cast("long").alias("edge"),
    )
    return flat.unionByName(near)


def _module(dev: int = 0, fp: int = 0, det: int = 0) -> list[Column]:
    """Device, focal plane and detector of the mapped modules, or so many further on."""
    numbers = zip(("dev", "fp", "det"), MODULE, (dev, fp, det), strict=True)
    return [F.lit(number + step).cast("long").alias(name) for name, number, step in numbers]


def _literal(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few fixed rows, written into the query itself."""
    fields = [field.split() for field in schema.split(", ")]
    values = ", ".join(str(row) for row in rows)
    table = spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(f[0] for f in fields)})")
    return table.select(*[F.col(name).cast(kind) for name, kind in fields])


def chmap(spark: SparkSession) -> DataFrame:
    """Channels 1-3 anode, 4-6 x, 7-9 y of detector p0 (geo 0) and p1 (geo 1); one is unmapped."""
    rows = [
        (f"p{geo}{'axy'[(ch - 1) // 3]}", (ch - 1) % 3, *MODULE, geo, ch)
        for geo in (0, 1)
        for ch in range(1, 10)
        if (geo, ch) != (1, 9)
    ]
    return _literal(spark, rows, MAP_SCHEMA)


def tmap(spark: SparkSession) -> DataFrame:
    """Reference channel of each module."""
    return _literal(spark, [("tref", geo, *MODULE, geo, 0) for geo in (0, 1)], MAP_SCHEMA)


def curves(spark: SparkSession, *names: str) -> DataFrame:
    rows = [(name, x, y) for name in names for x, y in CURVE[:2]]
    return _literal(spark, rows, "table string, x double, y double")


def single_hit_events(hits: DataFrame) -> DataFrame:
    """Nested rows of one hit each, next to an empty segment; an event has as many rows as hits."""
    hit = F.struct("geo", "ch", "value", "edge")
    segment = [F.col("dev"), F.col("fp"), F.lit(0).cast("long").alias("mod"), F.col("det")]
    filled = F.struct(*segment, F.array(hit).alias("hits"))
    empty = F.struct(*segment, F.slice(F.array(hit), 1, 0).alias("hits"))
    return hits.select(
        "event_id",
        F.col("ch").alias("runnumber"),
        F.col("value").alias("ts"),
        F.array(empty, filled).alias("segdata"),
    )


def whole_events(hits: DataFrame) -> DataFrame:
    """One nested row per event, as the readout sends it: a message is a whole event."""
    hit = F.struct("geo", "ch", "value", "edge")
    modules = hits.groupBy("event_id", "dev", "fp", "det").agg(F.collect_list(hit).alias("hits"))
    segment = F.struct("dev", "fp", F.lit(0).cast("long").alias("mod"), "det", "hits")
    return modules.groupBy("event_id").agg(F.collect_list(segment).alias("segdata")).select(
        "event_id",
        (F.col("event_id") % 7).alias("runnumber"),
        (F.col("event_id") * 1000).alias("ts"),
        "segdata",
    )


def encode(events: DataFrame, per_message: int = 1, turned: bool = False) -> DataFrame:
    """Arrow messages in a column ``value``, `per_message` consecutive events in each; the other
    columns are those of the first event of the message.  `turned` writes an event in each record batch
    and the fields in reverse order."""
    names = RAW_EVENT.names
    extra = [field for field in events.schema.fields if field.name not in names]
    extra_names = [field.name for field in extra]
    schema = RAW_EVENT_ARROW

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            # some 256 events at a time, in whole messages: their copies are held, not those of the batch
            step = max(256 // per_message, 1) * per_message
            for batch in (whole.slice(at, step) for at in range(0, whole.num_rows, step)):
                payload = pa.Table.from_batches([batch.select(names)]).cast(schema)
                if turned:
                    payload = payload.select(names[::-1])
                starts = list(range(0, batch.num_rows, per_message))
                values = []
                for start in starts:
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, payload.schema) as writer:
                        writer.write_table(payload.slice(start, per_message), max_chunksize=1 if turned else None)
                    values.append(sink.getvalue().to_pybytes())
                kept = batch.select(extra_names).take(pa.array(starts, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values, pa.binary()), *kept.columns], names=["value", *extra_names]
                )

    output = ", ".join(["value binary", *[f"{f.name} {f.dataType.simpleString()}" for f in extra]])
    return events.select(*names, *extra_names).mapInArrow(write, output)


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table as Kafka-shaped records; messages of errors are empty."""
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").alias("runnumber"),
        F.round(F.col("value") * 1000).cast("long").alias("ts"),
        F.array(
            F.struct(
                *_module()[:2],
                F.lit(0).cast("long").alias("mod"),
                _module()[2],
                F.array(
                    F.struct(
                        (F.col("user_id") % 2).alias("geo"),
                        (F.col("user_id") % 10).alias("ch"),
                        F.round(F.col("value") * 100).cast("long").alias("value"),
                        (F.col("event_id") % 2).alias("edge"),
                    )
                ).alias("hits"),
            )
        ).alias("segdata"),
        F.col("event_type").alias("topic"),
        (F.col("event_id") % 4).cast("int").alias("partition"),
        F.floor(F.col("event_id") / 4).alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )
    empty = F.when(F.col("topic") != "error", F.col("value")).otherwise(F.lit(b""))
    return encode(rows).withColumn("value", empty)
