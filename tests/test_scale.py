"""Large events and many histograms: bounded joins, parts, sketches."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from hitloom import sizing
from hitloom.functions import band_cell, band_cells
from hitloom.operators import Histogram, chunked, hist1d, hist2d, histograms, subtract_reference, two_sided
from hitloom.operators.chunks import numbered
from hitloom.operators.reference import subtract_tagged
from hitloom.operators.triggers import trigger_chunks, trigger_table
from hitloom.operators.two_sided import FEATURES, band_pairs, strip_features
from hitloom.plans import Layout, trigger_plan, wire_plan
from hitloom.schema import HIT_COUNT
from hitloom.sizing import hot_keys, split_hot
from tests.conftest import explained, rows
from workload import fixture as fx

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("window", [(-100.0, 100.0), (-7.0, -7.0), (0.0, 0.3), (-1e-9, 2e-9), (5, 1000)])
def test_band_cells_miss_no_pair(spark, window):
    rng = random.Random(1)
    values = [rng.uniform(-2000, 2000) for _ in range(120)]
    # pairs exactly on the limits
    others = values[:40] + [v - window[0] for v in values[:60]] + [v - window[1] for v in values[:60]]
    left = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    right = spark.createDataFrame([(j, o) for j, o in enumerate(others)], "j int, o double")
    left = left.withColumn("cell", band_cell(F.col("v"), window))
    right = right.withColumn("cell", F.explode(band_cells(F.col("o"), window)))
    met = left.join(right, "cell").filter((F.col("v") - F.col("o")).between(*window)).select("i", "j").collect()
    expected = {(i, j) for i, v in enumerate(values) for j, o in enumerate(others) if window[0] <= v - o <= window[1]}
    assert len(met) == len(expected) and {tuple(r) for r in met} == expected


def _side(spark, n, step, shift):
    return spark.range(n).select(
        F.lit(1).cast("long").alias("event_id"), F.lit(3).cast("long").alias("id"),
        (F.col("id") % 7 + 1.0).alias("charge"), (F.col("id") * step + shift).alias("timing"),
    )


def test_a_strip_of_a_million_pulses_a_side_is_no_list(spark):
    n = 1_000_000
    left, right = _side(spark, n, 10.0, 0.0), _side(spark, n, 10.0, 3.0)
    pairs = band_pairs(left, right, ["event_id", "id"], (-4.0, 8.0))
    # a pulse meets the right one 3 later and, 7 earlier, that of the one before
    assert pairs.count() == 2 * n - 1
    text = explained(pairs)
    assert "collect_list" not in text and "Window" not in text and "NestedLoop" not in text
    few = strip_features(band_pairs(left.limit(50), right.limit(50), ["event_id", "id"], (-4.0, 8.0)), ["event_id", "id"])
    assert len(few.first()["_found"]) == 99


def test_two_sided_drops_nulls_and_repeats_pairs(spark):
    schema = "event_id long, id long, charge double, timing double"
    left = spark.createDataFrame([(1, 1, 2.0, 5.0), (1, 1, 2.0, 5.0), (None, 1, 1.0, 1.0), (1, None, 1.0, 1.0), (2, 1, 1.0, None)], schema)
    found = two_sided(left, left, "s", (-1.0, 1.0)).collect()
    assert [(r["event_id"], r["s_id"], len(r["s_tdiff"])) for r in found] == [(1, 1, 4)]
    assert [c[2:] for c in two_sided(left, left, "s").columns[2:]] == FEATURES


def test_references_are_matched_inside_the_window_only(spark):
    """A million hits and ten thousand references of a module: a few million of 10^10 pairs are made."""
    n, refs, window = 1_000_000, 10_000, (-30_000, 20_000)
    module = [F.lit(1).cast("long").alias(c) for c in ("event_id", "dev", "fp", "det", "geo")]
    hits = spark.range(n).select(*module, F.lit("a").alias("cat"), F.col("id"), (F.col("id") * 7919).alias("value"), F.lit(0).cast("long").alias("edge"))
    references = spark.range(refs).select(*module, (F.col("id") * 700_001).alias("value"))
    values, starts = np.arange(n, dtype=np.int64) * 7919, np.arange(refs, dtype=np.int64) * 700_001
    expected = int((np.searchsorted(starts, values - window[0], "left") - np.searchsorted(starts, values - window[1], "right")).sum())
    found = subtract_reference(hits, references, salt=4, window=window)
    assert found.count() == expected
    assert found.agg(F.min("value"), F.max("value")).first()[0] > window[0]
    tagged = hits.withColumn("is_reference", F.lit(False)).unionByName(
        references.select("*", F.lit("t").alias("cat"), F.lit(0).cast("long").alias("id"), F.lit(0).cast("long").alias("edge"), F.lit(True).alias("is_reference"))
    )
    assert subtract_tagged(tagged, merge_equal=True, window=window).count() == expected


@pytest.mark.parametrize("first", [False, True])
def test_window_gives_the_rows_of_the_fan_out(spark, first):
    rng = random.Random(2)
    rows_ = [(e, "a", i, rng.randrange(-300, 300), rng.randrange(2), rng.random() < 0.2) for e in (1, 2, 3) for i in range(60)]
    rows_.append((1, "a", 1, None, 0, False))
    tagged = spark.createDataFrame(rows_, "event_id long, cat string, id long, value long, edge long, is_reference boolean")
    for c in ("dev", "fp", "det", "geo"):
        tagged = tagged.withColumn(c, F.col("id") % 2)
    window = (-50, 60)
    every = subtract_tagged(tagged, first=first)
    assert rows(subtract_tagged(tagged, first=first, window=window)) == rows(every.filter("value > -50 and value < 60"))


@pytest.mark.parametrize("cells", [None, 3])
def test_sketch_finds_every_hot_key(spark, monkeypatch, cells):
    if cells:
        monkeypatch.setattr(sizing, "SKETCH_CELLS", cells)
    counts = {k: 5 + k for k in range(40)}
    df = spark.createDataFrame([(k,) for k, n in counts.items() for _ in range(n)] + [(None,)] * 90, "k long")
    assert {r.k for r in hot_keys(df, "k", 30).collect()} == {k for k, n in counts.items() if n > 30}
    assert hot_keys(df, "k", 44) is None
    weighted = spark.createDataFrame([(k, n) for k, n in counts.items()] * 2, f"k long, {HIT_COUNT} long")
    assert {r.k for r in hot_keys(weighted, "k", 80).collect()} == {k for k, n in counts.items() if 2 * n > 80}
    ordinary, hot = split_hot(df, "k", hot_keys(df, "k", 30))
    assert ordinary.count() + hot.count() == df.count() and ordinary.filter("k is null").count() == 90


def test_spread_numbers_equal_those_of_a_sweep(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("event_id"), (F.col("id") % 10 % 4).alias("a"), (F.col("id") * 7 % 11).alias("b"))
    df = df.withColumn("event_id", F.when(F.col("event_id") < 2, F.col("event_id")))
    spread = numbered(df, ["event_id"], ["a", "b"], spread=True)
    assert rows(spread, "event_id", "_rank", "a", "b") == rows(numbered(df, ["event_id"], ["a", "b"]), "event_id", "_rank", "a", "b")


@pytest.mark.parametrize("spread", [False, True])
def test_parts_joined_are_the_whole_arrays(spark, spread):
    layout = Layout(hot_rows=0) if spread else Layout()
    hits, triggers = fx.hits(spark, SF), fx.chmap(spark).filter("cat like '%a'")
    whole = {r.event_id: r for r in trigger_plan(hits, triggers, fx.tmap(spark), full=True).collect()}
    parts = trigger_plan(hits, triggers, fx.tmap(spark), full=True, layout=layout, chunk=3).orderBy("event_id", "part").collect()
    joined = {e: ([], []) for e in whole}
    for r in parts:
        assert len(r.trig_id or []) <= 3 and r.trig == whole[r.event_id].trig
        joined[r.event_id][0].extend(r.trig_id or [])
        joined[r.event_id][1].extend(r.trig_timing or [])
    assert {e: (r.trig_id or [], r.trig_timing or []) for e, r in whole.items()} == joined
    wire = {r.event_id: r for r in wire_plan(hits, fx.chmap(spark), fx.tmap(spark), ["p0a", "p1x"]).collect()}
    lists = {e: {q: [] for q in ("p0a_id", "p1x_timing")} for e in wire}
    for r in wire_plan(hits, fx.chmap(spark), fx.tmap(spark), ["p0a", "p1x"], layout=layout, chunk=2).orderBy("event_id", "part").collect():
        for q in lists[r.event_id]:
            lists[r.event_id][q] += r[q] or []
    assert lists == {e: {q: r[q] or [] for q in ("p0a_id", "p1x_timing")} for e, r in wire.items()}
    needed = wire_plan(hits, fx.chmap(spark), fx.tmap(spark), ["p0a", "p1x"], require="p0a", layout=layout, chunk=2)
    assert {r.event_id for r in needed.collect()} == {e for e, r in wire.items() if r["p0a_id"]}


def test_a_large_event_is_cut_in_parts(spark):
    """Two million hits of one event, many of them equal: every part is full but the last."""
    n = 2_000_003
    hits = spark.range(n).select(F.lit(1).cast("long").alias("event_id"), (F.col("id") % 97).alias("id"), (F.col("id") % 1000).alias("value"))
    parts = chunked(hits, {"h": (F.lit(True), ["value", "id"])}, 10_000, order=["value", "id"], spread=True)
    sizes = {r.part: r.n for r in parts.select("part", F.size("h").alias("n")).collect()}
    assert sizes == {k: 10_000 for k in range(200)} | {200: 3}
    ends = parts.select("part", F.col("h")[0]["value"].alias("lo"), F.element_at("h", -1)["value"].alias("hi")).orderBy("part").collect()
    assert all(a.hi <= b.lo for a, b in zip(ends, ends[1:], strict=False))


def test_many_histograms_take_one_scan_and_one_exchange(spark):
    data = [(float(i % 50), i * 0.25, [float(i % 7), None, 3.0], None if i % 5 else [1.0, 2.0]) for i in range(400)]
    data += [(None, 2.0, None, [1.0]), (3.0, float("inf"), [float("nan")], [2.0])]
    df = spark.createDataFrame(data, "a double, b double, p array<double>, q array<double>").repartition(3)
    path = f"file://{spark.conf.get('spark.checkpoint.dir')[7:]}/hist"
    df.write.mode("overwrite").parquet(path)
    df = spark.read.parquet(path)
    wanted = {
        "a": Histogram(("a",), (11,), ((0.0, 40.0),), outer=True),
        "b": Histogram(("b",), (7,), ((0.0, 70.0),), edges="numpy"),
        "ab": Histogram(("a", "b"), (5, 6), ((0.0, 40.0), (1.0, 90.0))),
        "p": Histogram(("p",), (7,), ((0.0, 7.0),), array=True, edges="numpy"),
        "pq": Histogram(("p", "q"), (4, 4), ((0.0, 7.0), (0.0, 3.0)), array=True, nan="drop"),
    }
    found = histograms(df, wanted)
    got = {name: rows(found.filter(F.col("hist") == name).drop("hist")) for name in wanted}
    one = {
        "a": hist1d(df, "a", 11, (0.0, 40.0), outer=True),
        "b": hist1d(df, "b", 7, (0.0, 70.0), edges="numpy"),
        "p": hist1d(df, "p", 7, (0.0, 7.0), array=True, edges="numpy"),
    }
    for name, single in one.items():
        assert got[name] == rows(single.selectExpr("bin", "cast(null as long)", "center", "cast(null as double)", "n"))
    assert got["ab"] == rows(hist2d(df, ("a", "b"), (5, 6), ((0.0, 40.0), (1.0, 90.0))))
    assert got["pq"] == rows(hist2d(df, ("p", "q"), (4, 4), ((0.0, 7.0), (0.0, 3.0)), array=True, nan="drop"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = explained(histograms(df, wanted)).split("\n\n")[0]
        assert len(re.findall("Scan parquet", text)) == 1 and len(re.findall(r"Exchange \(", text)) == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    with pytest.raises(Exception, match="NaN"):
        histograms(df, {"p": Histogram(("p",), (7,), ((0.0, 7.0),), array=True)}).collect()
    with pytest.raises(ValueError):
        histograms(df, {"x": Histogram(("a", "b"), (5, 6), ((0.0, 40.0), (1.0, 90.0)), outer=True)})


def test_earliest_trigger_comes_from_the_stored_ranges(spark):
    """The hits of a hot event were made once more for it."""
    hits = spark.range(200).select((F.col("id") % 3).alias("event_id"), (F.col("id") * 13 % 17).alias("id"), F.when(F.col("id") % 50 != 7, F.col("id") * 7 % 40).cast("double").alias("value"))
    spread = trigger_chunks(hits, 2, spread=True)
    assert "Range (" not in spread._jdf.queryExecution().optimizedPlan().toString()
    assert rows(spread) == rows(trigger_chunks(hits, 2))
    first = {r["event_id"]: r["trig"] for r in trigger_table(hits).collect()}
    assert {(r["event_id"], r["trig"]) for r in spread.collect()} == set(first.items())
