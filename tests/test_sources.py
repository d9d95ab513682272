import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitloom.operators import explode_hits
from hitloom.schema import RAW_EVENT
from hitloom.sinks import to_kafka_rows, write_events
from hitloom.sources import (
    Paths,
    capture_messages,
    decode_events,
    offset_summary,
    read_channel_map,
    read_curve,
    read_curves,
    read_events,
    read_hit_keys,
)
from hitloom.sources.messages import RAW_EVENT_ARROW
from tests.conftest import rows
from workload import fixture

MAP_TEXT = """# channels of the test bench
cat,id,dev,fp,det,geo,ch

# left half
"p0a",   4, 20, 4, 50,0, 12
 "p0x",5 ,20,4,50, 0,  14
p1x, 6,20,  4,50,1,3  
"q0x", 6,20,4,50,7,3
"""

UNNAMED_TEXT = """id,dev,fp,det,geo,ch
# ids are counted on from plane to plane
4,20,4,  50,0,90
5 , 20,4,50,0, 92
# next plane
6,20,4,50,3,1
"""


def test_channel_map_with_comments_padding_and_prefixes(spark, tmp_path):
    path = tmp_path / "map.csv"
    path.write_text(MAP_TEXT)
    table = read_channel_map(spark, str(path))
    assert [t for _, t in table.dtypes] == ["string"] + ["bigint"] * 6
    assert rows(table)[0] == ("p0a", 4, 20, 4, 50, 0, 12)
    assert table.count() == 4
    assert rows(read_channel_map(spark, str(path), ["p1", "p0x"]), "cat") == [("p0x",), ("p1x",)]
    assert read_channel_map(spark, str(path), []).count() == 4
    with pytest.raises(TypeError):
        read_channel_map(spark, str(path), "p0")


def test_channel_map_without_category(spark, tmp_path):
    path = tmp_path / "wires.csv"
    path.write_text(UNNAMED_TEXT)
    table = read_channel_map(spark, str(path), category="w1")
    assert rows(table) == [("w1", 4, 20, 4, 50, 0, 90), ("w1", 5, 20, 4, 50, 0, 92), ("w1", 6, 20, 4, 50, 3, 1)]
    planes = {"wu": (0, 5), "wv": (6, 9)}
    table = read_channel_map(spark, str(path), category=planes)
    assert rows(table, "cat", "id") == [("wu", 4), ("wu", 5), ("wv", 6)]
    assert rows(read_channel_map(spark, str(path), ["wv"], category=planes), "id") == [(6,)]
    for wrong in ({"wu": (0, 5)}, {"wu": (0, 6), "wv": (6, 9)}):
        with pytest.raises(Exception, match="not in one range"):
            read_channel_map(spark, str(path), category=wrong).collect()


def test_curves(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n0.000, 0.000\n0.4, 1\n1.0, 1\n")
    (tmp_path / "b.csv").write_text("x,y\n0.0,0.0\n0.5,0.25\n")
    assert rows(read_curve(spark, str(tmp_path / "a.csv"), "a")) == [("a", 0.0, 0.0), ("a", 0.4, 1.0)]
    both = read_curves(spark, {n: str(tmp_path / f"{n}.csv") for n in "ab"})
    assert rows(both.groupBy("table").count()) == [("a", 2), ("b", 2)]


def test_paths():
    local = Paths.local("/data/run/")
    assert local.events("r1") == "file:///data/run/scratch/r1.parquet"
    assert local.result("r1", "wire") == "file:///data/run/scratch/r1_wire.parquet"
    s3 = Paths.s3("bucket", "config/here")
    assert s3.map_file("m.csv") == "s3://config/here/map_files/m.csv"
    assert s3.param_file("d/c.csv") == "s3://config/here/prm/d/c.csv"
    hdfs = Paths.hdfs("host:9000", "/test", "/exp/one")
    assert hdfs.events("r1") == "hdfs://host:9000/test/r1.parquet"
    assert hdfs.map_file("m.csv") == "hdfs://host:9000/exp/one/mapfiles/m.csv"


def _event(i, values=(1,)):
    hits = [{"geo": 0, "ch": 1, "value": v, "edge": 0} for v in values]
    segment = {"dev": 20, "fp": 4, "mod": 0, "det": 50, "hits": hits}
    return {"event_id": i, "runnumber": 4, "ts": i * 10, "segdata": [segment]}


def _message(events, schema=RAW_EVENT_ARROW, batches=1):
    table = pa.Table.from_pylist(events, schema=schema)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema) as writer:
        if table.num_rows:
            size = max(1, -(-table.num_rows // batches))
            for batch in table.to_batches(max_chunksize=size):
                writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _reordered(events):
    hit = pa.struct([("edge", pa.int32()), ("value", pa.int64()), ("ch", pa.int64()), ("geo", pa.int64())])
    segment = pa.struct(
        [("hits", pa.list_(hit)), ("det", pa.int64()), ("mod", pa.int64()), ("fp", pa.int64()), ("dev", pa.int64())]
    )
    return _message(
        events,
        pa.schema([("segdata", pa.list_(segment)), ("extra", pa.string()), ("event_id", pa.int64()),
                   ("ts", pa.int64()), ("runnumber", pa.int64())]),
    )


def test_decode_all_kinds_of_messages(spark):
    messages = spark.createDataFrame(
        [
            (1, None),
            (2, b""),
            (3, _message([])),
            (4, _message([_event(40, (7, 8))])),
            (5, _message([_event(50), _event(51), _event(52)], batches=3)),
            (6, _reordered([_event(60, (9,))])),
        ],
        "tag int, value binary",
    )
    messages = messages.withColumn("value", F.col("value"))
    first = decode_events(messages, rows="first")
    assert first.columns == [*RAW_EVENT.names, "tag"]
    assert rows(first, "tag", "event_id") == [(4, 40), (5, 50), (6, 60)]
    assert rows(decode_events(messages, rows="batch"), "event_id") == [(40,), (50,), (60,)]
    everything = decode_events(messages)
    assert rows(everything, "tag", "event_id") == [(4, 40), (5, 50), (5, 51), (5, 52), (6, 60)]
    assert rows(explode_hits(everything), "event_id", "dev", "ch", "value") == [
        (40, 20, 1, 7), (40, 20, 1, 8), (50, 20, 1, 1), (51, 20, 1, 1), (52, 20, 1, 1), (60, 20, 1, 9),
    ]
    with pytest.raises(ValueError):
        decode_events(messages, rows="some")


def test_decode_rebuilds_nested_fields_by_name(spark):
    narrow = pa.struct([("value", pa.int16()), ("geo", pa.int8())])
    segment = pa.struct([("hits", pa.list_(narrow)), ("det", pa.int64())])
    schema = pa.schema([("segdata", pa.list_(segment)), ("event_id", pa.int32())])
    events = [
        {"event_id": 1, "segdata": [{"det": 5, "hits": [{"value": 3, "geo": 1}, None]}, None, {"det": 6, "hits": None}]},
        {"event_id": 2, "segdata": None},
        {"event_id": 3, "segdata": [{"det": None, "hits": []}]},
    ]
    messages = spark.createDataFrame([(_message(events, schema, batches=2),)], "value binary")
    got = {r.event_id: r.asDict(True) for r in decode_events(messages).collect()}

    def hit(h):
        return h and {"geo": h["geo"], "ch": None, "value": h["value"], "edge": None}

    for e in events:
        segments = e["segdata"] and [
            s and {"dev": None, "fp": None, "mod": None, "det": s["det"],
                   "hits": s["hits"] and [hit(h) for h in s["hits"]] if s["hits"] else s["hits"]}
            for s in e["segdata"]
        ]
        assert got[e["event_id"]]["segdata"] == segments
        assert got[e["event_id"]]["runnumber"] is None


def test_decode_hands_on_in_pieces(spark, monkeypatch):
    monkeypatch.setattr("hitloom.sources.messages._FLUSH_ROWS", 3)
    data = [(i, _message([_event(i), _event(1000 + i)])) for i in range(20)]
    messages = spark.createDataFrame(data, "tag int, value binary").coalesce(1)
    got = rows(decode_events(messages, rows="all"), "tag", "event_id")
    assert got == sorted([(i, i) for i in range(20)] + [(i, 1000 + i) for i in range(20)], key=repr)


def _topic(spark):
    data = [("t", 0, o, b"" if o in (3, 5) else _message([_event(o)])) for o in range(2, 12)]
    data += [("t", 1, o, _message([_event(100 + o)])) for o in range(30)]
    data += [("u", 0, 99, _message([_event(999)]))]
    return spark.createDataFrame(data, "topic string, partition int, offset long, value binary")


class _Task:
    """Stands for a frame of which only the function run in its tasks is wanted."""

    def __init__(self, schema):
        self.schema = schema

    def select(self, *names):
        return self

    def mapInArrow(self, task, schema):  # noqa: N802
        return task


def test_encoding_and_decoding_hold_a_bounded_part_of_a_batch():
    hits = [{"geo": 0, "ch": i % 9, "value": i, "edge": 0} for i in range(200)]
    segments = [[{"dev": 1, "fp": 2, "mod": 0, "det": 3, "hits": hits}]] * 3000
    ids = pa.array(range(3000))
    events = pa.record_batch([ids, ids, ids, pa.array(segments, RAW_EVENT_ARROW.field("segdata").type)], schema=RAW_EVENT_ARROW)
    for per_message, turned in ((1, False), (5, True), (300, False)):
        written = list(fixture.encode(_Task(RAW_EVENT), per_message, turned)(iter([events])))
        assert max(b.num_rows for b in written) * per_message <= max(256, per_message)
        messages = pa.Table.from_batches(written).combine_chunks().to_batches()
        assert len(messages) == 1 and messages[0].num_rows == 3000 // per_message
        decode = decode_events(_Task(T.StructType([T.StructField("value", T.BinaryType())])))
        decoded = list(decode(iter(messages)))
        assert max(b.nbytes for b in decoded) <= 4_000_000
        assert pa.Table.from_batches(decoded).to_pylist() == events.to_pylist()


def test_capture_counts_filled_messages_of_one_partition(spark):
    topic = _topic(spark).filter("topic = 't'")
    assert rows(capture_messages(topic, 4, first=3), "event_id") == [(4,), (6,), (7,), (8,)]
    assert capture_messages(topic, 100, first=3).count() == 7
    assert rows(capture_messages(topic, 2, first=28, partition=1), "event_id") == [(128,), (129,)]
    several = spark.createDataFrame(
        [("t", 0, 1, _message([_event(i) for i in range(5)], batches=5))],
        "topic string, partition int, offset long, value binary",
    )
    assert rows(capture_messages(several, 1, first=0), "event_id") == [(i,) for i in range(5)]


def test_offset_summary(spark):
    assert rows(offset_summary(_topic(spark), "t")) == [("t", 0, 12, 30), ("t", 1, 30, 30)]
    with pytest.raises(Exception, match="does not exist"):
        offset_summary(_topic(spark), "unknown").collect()


def test_stored_events(spark, tmp_path):
    path = f"file://{tmp_path}/raw"
    events = decode_events(spark.createDataFrame([(_message([_event(1, (5, 6)), _event(2, ())]),)], "value binary"),
                           rows="all")
    write_events(events, path)
    write_events(events, path)
    stored = read_events(spark, path)
    assert stored.schema == RAW_EVENT
    assert rows(stored, "event_id") == [(1,), (2,)]
    keys = read_hit_keys(spark, path)
    assert rows(keys) == [(1, 2)]


def test_kafka_rows(spark):
    df = spark.createDataFrame([(7, [1.5])], "event_id long, a array<double>")
    assert rows(to_kafka_rows(df)) == [("7", '{"event_id":7,"a":[1.5]}')]
