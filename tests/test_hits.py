from pyspark.sql import functions as F

from hitloom.operators import (
    explode_hits,
    flip_edges,
    map_channels,
    reference,
    subtract_by_id,
    subtract_reference,
    time_reference,
    validate,
)
from hitloom.operators.reference import subtract_tagged, tag_channels
from hitloom.schema import RAW_EVENT
from hitloom.sizing import broadcast_if_small, hot_keys, split_hot
from tests.conftest import HIT, MAP, MAPPED, rows


def test_explode_drops_events_without_hits(spark):
    events = spark.createDataFrame(
        [
            (1, 5, 9, None),
            (2, 5, 9, []),
            (3, 5, 9, [(20, 4, 0, 50, [])]),
            (4, 5, 9, [(20, 4, 0, 50, None), None]),
            (5, 5, 9, [(20, 4, 7, 50, [(0, 1, 100, 0), (0, 2, 101, 1)]), (21, 5, 8, 51, [(3, 4, 5, 1)])]),
        ],
        RAW_EVENT,
    )
    assert rows(explode_hits(events)) == [
        (5, 20, 4, 50, 0, 1, 100, 0),
        (5, 20, 4, 50, 0, 2, 101, 1),
        (5, 21, 5, 51, 3, 4, 5, 1),
    ]
    kept = explode_hits(events, keep=["runnumber", "ts", "mod"])
    assert kept.columns[:6] == ["event_id", "runnumber", "ts", "dev", "fp", "mod"]
    assert rows(kept, "runnumber", "ts", "mod") == [(5, 9, 7), (5, 9, 7), (5, 9, 8)]


def test_explode_by_another_event_key(spark):
    events = spark.createDataFrame([(1, 5, 77, [(1, 1, 1, 1, [(1, 1, 1, 1)])])], RAW_EVENT)
    assert rows(explode_hits(events, event_key="ts")) == [(77, 1, 1, 1, 1, 1, 1, 1)]


def _hits(spark):
    return spark.createDataFrame(
        [
            (1, 20, 4, 50, 0, 0, 100, 0),
            (1, 20, 4, 50, 0, 0, 105, 0),
            (1, 20, 4, 50, 0, 0, 109, 1),
            (1, 20, 4, 50, 0, 1, 150, 0),
            (1, 20, 4, 50, 1, 1, 160, 1),
            (1, 20, 4, 50, 0, 9, 170, 0),
            (2, 20, 4, 50, 0, 1, 180, 1),
        ],
        HIT,
    )


def _map(spark):
    return spark.createDataFrame(
        [("p0a", 0, 20, 4, 50, 0, 1), ("p1a", 3, 20, 4, 50, 1, 1)], MAP
    )


def _refs(spark):
    return spark.createDataFrame([("tref", 6, 20, 4, 50, 0, 0)], MAP)


def test_map_channels_keeps_mapped_hits(spark):
    mapped = map_channels(_hits(spark), _map(spark))
    assert mapped.columns == ["event_id", "cat", "value", "id"]
    assert rows(mapped) == [(1, "p0a", 150, 0), (1, "p1a", 160, 3), (2, "p0a", 180, 0)]


def test_reference_is_leading_only_and_fans_out(spark):
    references = time_reference(_hits(spark), _refs(spark))
    assert rows(references) == [(1, 100, 20, 4, 50, 0), (1, 105, 20, 4, 50, 0)]
    columns = ["event_id", "cat", "value", "id", "edge", "dev", "fp", "det", "geo"]
    mapped = map_channels(_hits(spark), _map(spark), columns)
    expected = [(1, "p0a", 45), (1, "p0a", 50), (1, "p1a", None), (2, "p0a", None)]
    for salt in (1, 5):
        got = subtract_reference(mapped, references, salt=salt)
        assert got.columns == columns
        assert rows(got, "event_id", "cat", "value") == expected
    first = subtract_reference(mapped, references, first=True)
    assert rows(first, "event_id", "cat", "value") == [expected[1], expected[2], expected[3]]


def test_tagged_subtraction_equals_the_join_where_a_reference_exists(spark):
    tagged = tag_channels(_hits(spark), _map(spark), _refs(spark)).repartition("event_id")
    assert rows(subtract_tagged(tagged), "event_id", "cat", "value") == [
        (1, "p0a", 45),
        (1, "p0a", 50),
    ]
    assert rows(subtract_tagged(tagged, first=True), "event_id", "value") == [(1, 50)]
    # Matched by event alone, the other module has the reference too.
    assert rows(subtract_tagged(tagged, match=[], first=True), "cat", "value") == [
        ("p0a", 50),
        ("p1a", 60),
    ]


def test_a_channel_in_both_maps_is_hit_and_reference(spark):
    both = spark.createDataFrame([("p0r", 0, 20, 4, 50, 0, 0)], MAP)
    tagged = tag_channels(_hits(spark), both, _refs(spark))
    assert rows(tagged.groupBy("is_reference").count()) == [(False, 3), (True, 2)]


def test_subtract_by_id_matches_events_only(spark):
    mapped = map_channels(_hits(spark), _map(spark), ["event_id", "id", "value", "edge"])
    references = spark.createDataFrame([(1, 6, 100), (1, 7, 1)], "event_id long, id long, value long")
    got = subtract_by_id(mapped, references, 6)
    assert got.columns == ["event_id", "id", "value", "edge"]
    assert rows(got) == [(1, 0, 50, 0), (1, 3, 60, 1), (2, 0, None, 1)]


def test_validate_excludes_limits_and_null(spark):
    df = spark.createDataFrame([(-5,), (-4,), (0,), (4,), (5,), (None,)], "value long")
    assert rows(validate(df, (-5, 5))) == [(-4,), (0,), (4,)]


def test_flip_spares_the_anode(spark):
    df = spark.createDataFrame(
        [(1, "p0a", 0, 1, 0), (1, "p0x", 0, 1, 0), (1, "p0y", 0, 1, 1)], MAPPED
    )
    assert rows(flip_edges(df), "cat", "edge") == [("p0a", 0), ("p0x", 1), ("p0y", 0)]


def test_broadcast_only_within_the_bound(spark):
    table = spark.range(10).withColumnRenamed("id", "k")
    big = spark.range(1000).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = big.join(broadcast_if_small(table, rows=10), "k")
        large = big.join(broadcast_if_small(table, rows=9), "k")
        assert "BroadcastHashJoin" in small._jdf.queryExecution().toString()
        assert "BroadcastHashJoin" not in large._jdf.queryExecution().toString()
        assert small.count() == large.count() == 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_split_hot_loses_no_row(spark):
    df = spark.range(100).select(F.when(F.col("id") < 60, 1).when(F.col("id") < 99, F.col("id")).alias("k"))
    ordinary, hot = split_hot(df, "k", hot_keys(df, "k", 10))
    assert hot.count() == 60
    assert ordinary.count() == 40
    assert ordinary.filter("k IS NULL").count() == 1
    assert split_hot(df, "k", hot_keys(df, "k", 60))[1] is None


def test_references_of_small_keys_are_neither_repeated_nor_broadcast(spark, monkeypatch):
    """Spark took 64 copies of each reference for one, and sent them to the driver to broadcast them."""
    module = [F.lit(1).cast("long").alias(c) for c in ("dev", "fp", "det", "geo")]
    hits = spark.range(600).select((F.col("id") % 200).alias("event_id"), *module, F.lit("a").alias("cat"), "id", (F.col("id") * 7 % 90).alias("value"))
    hits = hits.union(hits.limit(2).withColumn("event_id", F.lit(None).cast("long")))
    references = spark.range(200).select(F.col("id").alias("event_id"), *module, (F.col("id") % 30).alias("value")).distinct()
    for window in (None, (-40, 50)):
        plain = rows(subtract_reference(hits, references, window=window))
        salted = subtract_reference(hits, references, salt=64, window=window)
        assert rows(salted) == plain
        salted.collect()
        plan = salted._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert not [line for line in plan.splitlines() if "BroadcastHashJoin" in line and "_salt#" in line]
        monkeypatch.setattr(reference, "SALTED_ROWS", 2)
        assert rows(subtract_reference(hits, references, salt=64, window=window)) == plain
        monkeypatch.undo()
