import pytest
from pyspark.sql import functions as F

from hitloom.plans import Layout, strip_plan
from hitloom.sinks import CommittedBatches, read_committed
from hitloom.storage import work_folder
from hitloom.streaming import decode_stream, run_stream, state_size
from tests.conftest import rows
from workload import fixture as fx
from workload.queries import FIXTURE_PLANES

SF = "/root/testdata/sf0.001"


def _plan(spark):
    def plan(hits):
        return strip_plan(
            hits, fx.chmap(spark), fx.tmap(spark), fx.curves(spark, "p0_xc0", "p0_yc0"), ["p0"], full=True,
            planes=FIXTURE_PLANES,
        )

    return plan


@pytest.fixture(scope="module")
def events(spark):
    df = fx.whole_events(fx.hits(spark, SF))
    return df.withColumn("timestamp", F.timestamp_seconds(1_700_000_000 + F.col("event_id") % 5))


def _source(spark, folder, files=3):
    schema = "value binary, timestamp timestamp"
    return decode_stream(
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(f"{folder}/messages")
    )


def _run(spark, folder, **options):
    query = run_stream(
        _source(spark, folder), _plan(spark), f"{folder}/out", f"{folder}/checkpoint",
        trigger={"availableNow": True}, **options,
    )
    query.awaitTermination()
    return read_committed(spark, f"{folder}/out")


def test_stream_equals_batch(spark, events):
    folder = work_folder(spark, "stream")
    fx.encode(events.repartition(8)).write.parquet(f"{folder}/messages")
    out = _run(spark, folder)
    assert out.select("batch_id").distinct().count() > 1
    batch = _plan(spark)(fx.hits(spark, SF))
    assert rows(out.select(batch.columns)) == rows(batch)
    origin = {(r.event_id, r.runnumber, r.stream_uts.timestamp()) for r in
              out.select("event_id", "runnumber", "stream_uts").collect()}
    assert origin == {(e, e % 7, 1_700_000_000 + e % 5) for e in
                      [r.event_id for r in events.select("event_id").collect()]}

    # A second run finds nothing new; a replayed batch replaces itself.
    count = out.count()
    assert _run(spark, folder).count() == count


def test_repeated_messages_are_dropped_across_batches(spark, events):
    folder = work_folder(spark, "stream")
    messages = fx.encode(events.repartition(2))
    messages.write.parquet(f"{folder}/messages")
    messages.write.mode("append").parquet(f"{folder}/messages")
    out = _run(spark, folder, dedup=True)
    batch = _plan(spark)(fx.hits(spark, SF))
    assert rows(out.select(batch.columns)) == rows(batch)


def test_replayed_batch_is_not_written_twice(spark, events):
    folder = work_folder(spark, "stream")
    fx.encode(events.limit(20)).write.parquet(f"{folder}/messages")
    first = _run(spark, folder)
    attempts = CommittedBatches(spark, f"{folder}/out").listed()
    # As after a crash between the commit in the table and that of the query.
    query = run_stream(
        _source(spark, folder), _plan(spark), f"{folder}/out", f"{folder}/checkpoint2",
        trigger={"availableNow": True},
    )
    query.awaitTermination()
    assert CommittedBatches(spark, f"{folder}/out").listed() == attempts
    assert rows(read_committed(spark, f"{folder}/out")) == rows(first)


@pytest.mark.parametrize("written", [False, True])
def test_a_batch_that_dies_is_never_seen_half(spark, events, monkeypatch, written):
    folder = work_folder(spark, "stream")
    fx.encode(events.repartition(8)).write.parquet(f"{folder}/messages")
    whole, failed = CommittedBatches.write, []

    def dying(self, df, batch_id):
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            part = df if written else df.limit(3)
            part.write.parquet(self.folder(batch_id, "adead"))
            raise OSError("killed before the commit")
        whole(self, df, batch_id)

    monkeypatch.setattr(CommittedBatches, "write", dying)
    with pytest.raises(Exception, match="killed before the commit"):
        _run(spark, folder)
    seen = read_committed(spark, f"{folder}/out")
    assert {r.batch_id for r in seen.select("batch_id").distinct().collect()} == {0}
    out = _run(spark, folder)
    batch = _plan(spark)(fx.hits(spark, SF))
    assert rows(out.select(batch.columns)) == rows(batch)
    # the dead attempt is still there and in nobody's result
    assert spark.read.parquet(f"{folder}/out/batch_id=1/attempt=adead").count() > 0


def test_nothing_committed_is_an_error(spark):
    with pytest.raises(FileNotFoundError):
        read_committed(spark, work_folder(spark, "none"))


def test_restarted_query_remembers_what_it_saw(spark, events):
    folder = work_folder(spark, "stream")
    messages = fx.encode(events.repartition(2))
    messages.write.parquet(f"{folder}/messages")
    first = _run(spark, folder, dedup=True).count()
    messages.write.mode("append").parquet(f"{folder}/messages")
    query = run_stream(
        _source(spark, folder), _plan(spark), f"{folder}/out", f"{folder}/checkpoint", dedup=True,
        trigger={"availableNow": True},
    )
    query.awaitTermination()
    assert read_committed(spark, f"{folder}/out").count() == first
    held = state_size(query)
    # the store counts a key again when it is replayed from the change log
    assert held["rows"] >= events.select("event_id").distinct().count() and held["bytes"] > 0
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert provider.endswith("RocksDBStateStoreProvider")


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Conf:
        def get(self, name, default=None):
            return {"spark.master": "spark://host:7077"}.get(name, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError):
        work_folder(Session(), "x")
    assert work_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert work_folder(spark, "x") != work_folder(spark, "x")
    assert Layout().hot_rows
