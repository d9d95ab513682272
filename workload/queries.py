"""The registered queries: each operator and plan over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.operators import (
    Histogram,
    assemble,
    collect_planes,
    distinct_events,
    explode_hits,
    flip_edges,
    hist1d,
    hist1d_stats,
    hist2d,
    hist2d_stats,
    histograms,
    interpolate,
    linear_calib,
    linear_calib_array,
    map_channels,
    pair_edges,
    strip_position,
    subtract_by_id,
    subtract_reference,
    time_reference,
    to_float,
    top2_strips,
    two_sided,
    validate,
    zip_arrays,
)
from hitloom.operators.two_sided import FEATURES
from hitloom.plans import (
    Layout,
    StripPlane,
    TwoSided,
    calibrated_pulses,
    run_batch,
    strip_local,
    strip_plan,
    trigger_plan,
    two_sided_local,
    two_sided_plan,
    wire_local,
    wire_plan,
)
from hitloom.plans.strip import STRIP_FACTOR as FACTOR
from hitloom.sinks import read_committed, to_kafka_rows, write_events
from hitloom.sources import (
    Paths,
    capture_messages,
    decode_events,
    offset_summary,
    read_channel_map,
    read_curves,
)
from hitloom.sources.curves import drop_plateaus
from hitloom.storage import work_folder
from hitloom.streaming import decode_stream, run_local, run_stream
from workload import fixture as fx

Query = Callable[[SparkSession, str], DataFrame]

MODULE = ["event_id", "cat", "value", "id", "edge", "dev", "fp", "det", "geo"]
FIXTURE_PLANES = (StripPlane("x", 1.0, 2.55), StripPlane("y", 1.0, 2.55))
FIXTURE_SIDES = TwoSided("p0", pad="a", left="x", right="y", strip="s", window=(-500.0, 500.0))
# Every event is treated as hot.
SPREAD = Layout(hot_rows=0)

REGISTERED: dict[str, Query] = {}


def register(query: Query) -> Query:
    REGISTERED["q_" + query.__name__] = query
    return query


def r6(column: Column | str) -> Column:
    return F.round(column, 6) + F.lit(0.0)


def micro(column: str) -> Column:
    """An array of doubles as text in whole millionths; null stays null."""
    parts = F.transform(column, lambda v: F.round(v * 1000000).cast("long").cast("string"))
    return F.array_join(parts, ",")


def text(column: str) -> Column:
    return F.array_join(F.transform(column, lambda v: v.cast("string")), ",")


def shown(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Columns renamed, arrays as text and doubles rounded."""
    types = dict(df.dtypes)

    def show(name: str) -> Column:
        kind = types[name]
        if kind.startswith("array"):
            return micro(name) if "double" in kind else text(name)
        return r6(name) if kind == "double" else F.col(name)

    return df.select(*[show(old).alias(new) for old, new in names.items()])


def _mapped(spark: SparkSession, sf: str) -> DataFrame:
    return map_channels(fx.hits(spark, sf), fx.chmap(spark), MODULE)


def _references(spark: SparkSession, sf: str) -> DataFrame:
    return time_reference(fx.hits(spark, sf), fx.tmap(spark))


def _flipped(spark: SparkSession, sf: str) -> DataFrame:
    subtracted = subtract_reference(_mapped(spark, sf), _references(spark, sf))
    flipped = flip_edges(validate(subtracted))
    return flipped.select("event_id", "cat", "id", "value", "edge")


def _pulses(spark: SparkSession, sf: str, dither: str = "mid") -> DataFrame:
    return calibrated_pulses(
        fx.hits(spark, sf), fx.chmap(spark), fx.tmap(spark), FACTOR, flip=True, dither=dither
    )


@register
def explode_hits_(spark: SparkSession, sf: str) -> DataFrame:
    return explode_hits(fx.single_hit_events(fx.hits(spark, sf)))


@register
def explode_hits_keep(spark: SparkSession, sf: str) -> DataFrame:
    events = fx.single_hit_events(fx.hits(spark, sf))
    return explode_hits(events, keep=["runnumber", "ts", "mod"])


@register
def read_map_prefix(spark: SparkSession, sf: str) -> DataFrame:
    part = F.col("p_partkey")
    path = work_folder(spark, "map")
    fx.table(spark, sf, "part").select(
        F.concat(F.lower("p_type"), F.lit("-"), "p_brand").alias("cat"),
        *[
            F.concat(F.lit("  "), number.cast("string"), F.lit(" ")).alias(name)
            for name, number in {
                "id": part, "dev": F.col("p_size"), "fp": part % 64, "det": part % 31,
                "geo": part % 16, "ch": part % 128,
            }.items()
        ],
    ).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    return read_channel_map(spark, path, ["s", "promo"])


@register
def read_map_planes(spark: SparkSession, sf: str) -> DataFrame:
    """A map without names, eight planes told apart by their ranges of ids."""
    part = F.col("p_partkey")
    path = work_folder(spark, "map")
    fx.table(spark, sf, "part").select(
        (part % 128).alias("id"), F.col("p_size").alias("dev"), (part % 64).alias("fp"),
        (part % 31).alias("det"), (part % 16).alias("geo"), part.alias("ch"),
    ).write.option("header", True).csv(path)
    planes = {f"w{i}": (16 * i, 16 * i + 15) for i in range(8)}
    return read_channel_map(spark, path, category=planes)


def _brand_points(spark: SparkSession, sf: str) -> DataFrame:
    """A curve per brand: the price in steps of two, with plateaus."""
    return fx.table(spark, sf, "part").select(
        F.col("p_brand").alias("table"),
        F.col("p_retailprice").alias("x"),
        (F.floor(F.col("p_retailprice") / 2) / 613.0).alias("y"),
    )


@register
def read_curves_(spark: SparkSession, sf: str) -> DataFrame:
    folder = work_folder(spark, "curves")
    _brand_points(spark, sf).write.partitionBy("table").option("header", True).csv(folder)
    brands = [f"Brand#{i}" for i in range(1, 26)]
    return read_curves(spark, {b: f"{folder}/table={b.replace('#', '%23')}" for b in brands})


@register
def map_channels_(spark: SparkSession, sf: str) -> DataFrame:
    return map_channels(fx.hits(spark, sf), fx.chmap(spark))


@register
def time_reference_(spark: SparkSession, sf: str) -> DataFrame:
    return _references(spark, sf)


def _counted(df: DataFrame, *columns: str) -> DataFrame:
    """Equal rows once, with their number."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def _subtracted(df: DataFrame) -> DataFrame:
    return _counted(df, "event_id", "cat", "id", "value", "edge")


@register
def subtract_reference_(spark: SparkSession, sf: str) -> DataFrame:
    return _subtracted(subtract_reference(_mapped(spark, sf), _references(spark, sf)))


@register
def subtract_reference_salted(spark: SparkSession, sf: str) -> DataFrame:
    return _subtracted(subtract_reference(_mapped(spark, sf), _references(spark, sf), salt=16))


@register
def subtract_first_reference(spark: SparkSession, sf: str) -> DataFrame:
    return _subtracted(subtract_reference(_mapped(spark, sf), _references(spark, sf), first=True))


@register
def subtract_by_id_(spark: SparkSession, sf: str) -> DataFrame:
    leading = fx.hits(spark, sf).filter("edge = 0")
    references = map_channels(leading, fx.tmap(spark), ["event_id", "id", "value"])
    return _counted(subtract_by_id(_mapped(spark, sf), references, 1), "event_id", "id", "value", "edge")


@register
def validate_flip(spark: SparkSession, sf: str) -> DataFrame:
    return _subtracted(_flipped(spark, sf))


@register
def pair_edges_(spark: SparkSession, sf: str) -> DataFrame:
    return pair_edges(_flipped(spark, sf))


@register
def pair_edges_cells(spark: SparkSession, sf: str) -> DataFrame:
    return pair_edges(_flipped(spark, sf), cell=4096)


@register
def category_totals(spark: SparkSession, sf: str) -> DataFrame:
    return _pulses(spark, sf).groupBy("cat").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("charge"), 4).alias("total_charge")
    )


@register
def to_float_mid(spark: SparkSession, sf: str) -> DataFrame:
    pairs = pair_edges(_flipped(spark, sf))
    return to_float(pairs, ["charge", "timing"], factor=FACTOR, dither="mid")


@register
def to_float_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """How many dithered values stay within their channel, for both dithers."""
    pairs = pair_edges(_flipped(spark, sf))
    pairs = pairs.select(*pairs.columns, F.col("charge").alias("hashed"), F.col("charge").alias("drawn"))
    df = to_float(pairs, "hashed", factor=FACTOR, keys=["event_id", "cat", "id", "timing"])
    df = to_float(df, "drawn", factor=FACTOR, dither="rand", seed=7)

    def inside(name: str) -> Column:
        shift = F.col(name) / FACTOR - F.col("charge")
        return F.count(F.when((shift >= -1e-9) & (shift < 1 + 1e-9), 1))

    return df.agg(
        F.count(F.lit(1)).alias("n"),
        inside("hashed").alias("hash_inside"),
        inside("drawn").alias("rand_inside"),
    )


@register
def to_float_hash(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs with the channel that each charge falls back to when its hash dither is taken off."""
    pairs = pair_edges(_flipped(spark, sf)).withColumn("scaled", F.col("charge"))
    df = to_float(pairs, "scaled", factor=FACTOR, keys=["event_id", "cat", "id", "timing"])
    return df.select("event_id", "cat", "id", "charge", "timing", F.floor(F.col("scaled") / FACTOR + 1e-9).alias("channel"))


def _coefficients(spark: SparkSession, sf: str) -> DataFrame:
    return fx.table(spark, sf, "supplier").filter("s_acctbal > 0").select(
        F.col("s_suppkey").alias("id"),
        (F.col("s_acctbal") / 1000).alias("p0"),
        (1 + F.col("s_nationkey") / 100.0).alias("p1"),
    )


@register
def linear_calib_(spark: SparkSession, sf: str) -> DataFrame:
    lines = fx.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_suppkey").alias("id"),
        F.col("l_extendedprice").alias("charge"),
    )
    calibrated = linear_calib(lines, _coefficients(spark, sf))
    return calibrated.withColumn("charge", F.round("charge", 6))


@register
def linear_calib_array_(spark: SparkSession, sf: str) -> DataFrame:
    lines = fx.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_suppkey").alias("id"),
        F.array("l_extendedprice", "l_quantity", "l_tax").alias("charge"),
    )
    rows = linear_calib_array(lines, _coefficients(spark, sf))
    return rows.select(
        "l_orderkey", "l_linenumber", "id", F.posexplode("charge").alias("pos", "charge")
    ).withColumn("charge", F.round("charge", 6))


def _top2(spark: SparkSession, sf: str) -> DataFrame:
    return top2_strips(_pulses(spark, sf), by=["cat"])


@register
def interpolate_(spark: SparkSession, sf: str) -> DataFrame:
    c0, c1 = F.col("c0"), F.col("c1")
    rows = _top2(spark, sf).select(
        "event_id", "cat", ((c0 - c1) / (c0 + c1)).alias("c0c1"), F.lit("ramp").alias("table")
    )
    converted = interpolate(rows, fx.curves(spark, "ramp"), "c0c1", "conv")
    return converted.select("event_id", "cat", r6("c0c1").alias("c0c1"), r6("conv").alias("conv"))


@register
def interpolate_curves(spark: SparkSession, sf: str) -> DataFrame:
    """One curve per brand; brand 26 has none."""
    rows = fx.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.concat(F.lit("Brand#"), (1 + F.col("l_partkey") % 26).cast("string")).alias("table"),
        (F.col("l_extendedprice") / 50 + 10).alias("x"),
    )
    converted = interpolate(rows, drop_plateaus(_brand_points(spark, sf)), "x", "y")
    return converted.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round("x", 6).alias("x"), r6("y").alias("y")
    )


@register
def top2(spark: SparkSession, sf: str) -> DataFrame:
    return _top2(spark, sf).select(
        "event_id", "cat", r6("c0").alias("c0"), r6("c1").alias("c1"), "id0", "id1"
    )


@register
def strip_position_(spark: SparkSession, sf: str) -> DataFrame:
    strips = top2_strips(_pulses(spark, sf).filter("cat = 'p0x'"))
    placed = strip_position(strips, fx.curves(spark, "ramp"), 1.0, 2.55, turned=True)
    return placed.select("event_id", r6("pos").alias("pos"), r6("c0c1_conv").alias("c0c1_conv"))


@register
def distinct_events_(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_events(fx.hits(spark, sf))


@register
def collect_planes_(spark: SparkSession, sf: str) -> DataFrame:
    planes = {"p0a": ["timing", "charge"], "p1x": ["id", "timing"]}
    names = {"event_id": "event_id", "p0a_timing": "a_timing", "p0a_charge": "a_charge",
             "p1x_id": "x_id", "p1x_timing": "x_timing"}
    return shown(collect_planes(_pulses(spark, sf), planes), names)


@register
def assemble_(spark: SparkSession, sf: str) -> DataFrame:
    strongest = _top2(spark, sf)
    parts = {
        plane: strongest.filter(F.col("cat") == "p0" + plane).select(
            "event_id", r6("c0").alias(f"{plane}_c0")
        )
        for plane in ("x", "y")
    }
    return assemble(fx.hits(spark, sf), parts, require="x")


def _strip(spark: SparkSession, hits: DataFrame, plan: Callable[..., DataFrame] = strip_plan, **options) -> DataFrame:
    return plan(
        hits,
        fx.chmap(spark),
        fx.tmap(spark),
        fx.curves(spark, *[f"p{d}_{p}c0" for d in (0, 1) for p in "xy"]),
        planes=FIXTURE_PLANES,
        dither="mid",
        **options,
    )


def _strip_full(df: DataFrame, *more: str) -> DataFrame:
    columns = [c for c in df.columns if c.startswith("p")]
    return shown(df, {c: c for c in ("event_id", *more, *columns)})


DETECTORS = ["p0", "p1"]


@register
def strip_full(spark: SparkSession, sf: str) -> DataFrame:
    return _strip_full(_strip(spark, fx.hits(spark, sf), detectors=DETECTORS, full=True))


@register
def strip_full_spread(spark: SparkSession, sf: str) -> DataFrame:
    hits = fx.hits(spark, sf)
    return _strip_full(_strip(spark, hits, detectors=DETECTORS, full=True, layout=SPREAD))


@register
def strip_local_(spark: SparkSession, sf: str) -> DataFrame:
    """Whole events in nested rows: no hit is shuffled."""
    events = fx.whole_events(fx.hits(spark, sf))
    return _strip_full(_strip(spark, events, strip_local, detectors=DETECTORS, full=True))


@register
def strip_local_short(spark: SparkSession, sf: str) -> DataFrame:
    short = _strip(spark, fx.whole_events(fx.hits(spark, sf)), strip_local, detectors=DETECTORS, require="p0")
    return shown(short, {c: c for c in short.columns})


@register
def strip_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Stored nested events to a stored result table."""
    folder = work_folder(spark, "batch")
    paths = Paths(folder, folder, folder)
    write_events(fx.single_hit_events(fx.hits(spark, sf)), paths.events("run1"))
    stored = run_batch(
        spark,
        paths,
        "run1",
        "strip",
        lambda hits, layout, events: _strip(
            spark, hits, detectors=DETECTORS, full=True, layout=layout, events=events
        ),
    )
    return _strip_full(spark.read.parquet(stored))


@register
def strip_short(spark: SparkSession, sf: str) -> DataFrame:
    short = _strip(spark, fx.hits(spark, sf), detectors=["p0", "p1"])
    return shown(short, {c: c for c in short.columns})


@register
def strip_require(spark: SparkSession, sf: str) -> DataFrame:
    short = _strip(spark, fx.hits(spark, sf), detectors=["p0", "p1"], require="p0")
    return shown(short, {c: c for c in short.columns})


def _two_sided(spark: SparkSession, sf: str, compat: bool) -> DataFrame:
    pulses = _pulses(spark, sf)
    left, right = pulses.filter("cat = 'p0x'"), pulses.filter("cat = 'p0y'")
    found = two_sided(left, right, "s", (-2000.0, 2000.0), compat=compat)
    return shown(found, {"event_id": "event_id", "s_id": "id"} | {f"s_{f}": f for f in FEATURES})


@register
def two_sided_(spark: SparkSession, sf: str) -> DataFrame:
    return _two_sided(spark, sf, False)


@register
def two_sided_compat(spark: SparkSession, sf: str) -> DataFrame:
    return _two_sided(spark, sf, True)


def _two_sided_event(spark: SparkSession, sf: str, local: bool = False, **options) -> DataFrame:
    hits = fx.hits(spark, sf)
    plan, source = (two_sided_local, fx.whole_events(hits)) if local else (two_sided_plan, hits)
    df = plan(source, fx.chmap(spark), fx.tmap(spark), [FIXTURE_SIDES], dither="mid", **options)
    renamed = {"p0a": "pad", "p0x": "left", "p0y": "right", "p0s": "strip"}
    names = {c: renamed[c[:3]] + c[3:] for c in df.columns if c != "event_id"}
    return shown(df, {"event_id": "event_id"} | names)


@register
def two_sided_full(spark: SparkSession, sf: str) -> DataFrame:
    return _two_sided_event(spark, sf, full=True)


@register
def two_sided_spread(spark: SparkSession, sf: str) -> DataFrame:
    return _two_sided_event(spark, sf, full=True, layout=SPREAD)


@register
def two_sided_local_(spark: SparkSession, sf: str) -> DataFrame:
    return _two_sided_event(spark, sf, local=True, full=True)


@register
def two_sided_short(spark: SparkSession, sf: str) -> DataFrame:
    return _two_sided_event(spark, sf)


@register
def two_sided_require(spark: SparkSession, sf: str) -> DataFrame:
    return _two_sided_event(spark, sf, require="p0")


def _wire(spark: SparkSession, sf: str, **options) -> DataFrame:
    df = wire_plan(
        fx.hits(spark, sf), fx.chmap(spark), fx.tmap(spark), fx.PLANES, dither="mid", **options
    )
    return shown(df, {c: c for c in df.columns})


@register
def wire(spark: SparkSession, sf: str) -> DataFrame:
    return _wire(spark, sf)


@register
def wire_local_(spark: SparkSession, sf: str) -> DataFrame:
    events = fx.whole_events(fx.hits(spark, sf))
    df = wire_local(events, fx.chmap(spark), fx.tmap(spark), fx.PLANES, dither="mid")
    return shown(df, {c: c for c in df.columns})


@register
def wire_spread(spark: SparkSession, sf: str) -> DataFrame:
    return _wire(spark, sf, layout=SPREAD)


@register
def wire_by_id(spark: SparkSession, sf: str) -> DataFrame:
    return _wire(spark, sf, reference_id=0)


@register
def wire_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Two pulses of each plane to a row."""
    return _wire(spark, sf, chunk=2)


@register
def wire_chunks_spread(spark: SparkSession, sf: str) -> DataFrame:
    return _wire(spark, sf, chunk=2, layout=SPREAD)


def _trigger(spark: SparkSession, sf: str, full: bool, **options) -> DataFrame:
    triggers = fx.chmap(spark).filter(F.col("cat").endswith("a"))
    df = trigger_plan(fx.hits(spark, sf), triggers, fx.tmap(spark), full, dither="mid", **options)
    return shown(df, {c: c for c in df.columns})


@register
def trigger(spark: SparkSession, sf: str) -> DataFrame:
    return _trigger(spark, sf, False)


@register
def trigger_full(spark: SparkSession, sf: str) -> DataFrame:
    return _trigger(spark, sf, True)


@register
def trigger_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return _trigger(spark, sf, True, chunk=2)


@register
def trigger_chunks_spread(spark: SparkSession, sf: str) -> DataFrame:
    return _trigger(spark, sf, True, chunk=2, layout=SPREAD)


def _centered(df: DataFrame) -> DataFrame:
    return df.withColumn("center", r6("center"))


@register
def hist1d_(spark: SparkSession, sf: str) -> DataFrame:
    return _centered(hist1d(_pulses(spark, sf), "charge", 50, (0.0, 5000.0), outer=True))


@register
def hist1d_sales(spark: SparkSession, sf: str) -> DataFrame:
    lines = fx.table(spark, sf, "lineitem")
    return _centered(hist1d(lines, "l_extendedprice", 101, (0.0, 105000.0), outer=True))


@register
def hist1d_numpy(spark: SparkSession, sf: str) -> DataFrame:
    return _centered(hist1d(_pulses(spark, sf), "charge", 50, (0.0, 5000.0), edges="numpy"))


def _plane_arrays(spark: SparkSession, sf: str) -> DataFrame:
    return collect_planes(_pulses(spark, sf), {"p0x": ["charge", "timing"]})


@register
def hist1d_array(spark: SparkSession, sf: str) -> DataFrame:
    return _centered(hist1d(_plane_arrays(spark, sf), "p0x_charge", 50, (0.0, 5000.0), array=True))


@register
def hist1d_array_numpy(spark: SparkSession, sf: str) -> DataFrame:
    arrays = _plane_arrays(spark, sf)
    return _centered(hist1d(arrays, "p0x_timing", 60, (0.0, 9000.0), array=True, edges="numpy"))


@register
def hist1d_stats_(spark: SparkSession, sf: str) -> DataFrame:
    return hist1d_stats(_pulses(spark, sf), "charge", 50, (0.0, 500.0))


SPAN2 = ((0.0, 5000.0), (-500.0, 9500.0))


def _cells(df: DataFrame) -> DataFrame:
    return df.withColumns({"x": r6("x"), "y": r6("y")})


@register
def hist2d_(spark: SparkSession, sf: str) -> DataFrame:
    return _cells(hist2d(_pulses(spark, sf), ("charge", "timing"), (40, 60), SPAN2))


@register
def hist2d_sales(spark: SparkSession, sf: str) -> DataFrame:
    lines = fx.table(spark, sf, "lineitem")
    span = ((1.0, 51.0), (0.0, 105000.0))
    return _cells(hist2d(lines, ("l_quantity", "l_extendedprice"), (51, 43), span))


@register
def hist2d_numpy(spark: SparkSession, sf: str) -> DataFrame:
    pulses = _pulses(spark, sf)
    return _cells(hist2d(pulses, ("charge", "timing"), (40, 60), SPAN2, edges="numpy"))


@register
def hist2d_array(spark: SparkSession, sf: str) -> DataFrame:
    arrays = _plane_arrays(spark, sf)
    return _cells(hist2d(arrays, ("p0x_charge", "p0x_timing"), (40, 60), SPAN2, array=True))


@register
def hist2d_array_numpy(spark: SparkSession, sf: str) -> DataFrame:
    arrays = _plane_arrays(spark, sf)
    columns = ("p0x_charge", "p0x_timing")
    return _cells(hist2d(arrays, columns, (40, 60), SPAN2, array=True, edges="numpy"))


@register
def hist2d_dense(spark: SparkSession, sf: str) -> DataFrame:
    dense = hist2d(_pulses(spark, sf), ("charge", "timing"), (20, 30), SPAN2, dense=True)
    return dense.select("bin_x", "bin_y", "n")


@register
def hist2d_stats_(spark: SparkSession, sf: str) -> DataFrame:
    span = ((0.0, 500.0), (0.0, 5000.0))
    return hist2d_stats(_pulses(spark, sf), ("charge", "timing"), (20, 30), span)


@register
def histograms_(spark: SparkSession, sf: str) -> DataFrame:
    """Three histograms of one table from one scan."""
    wanted = {
        "price": Histogram(("l_extendedprice",), (101,), ((0.0, 105000.0),), outer=True),
        "tax": Histogram(("l_tax",), (9,), ((0.0, 0.08),), edges="numpy"),
        "both": Histogram(("l_quantity", "l_extendedprice"), (51, 43), ((1.0, 51.0), (0.0, 105000.0))),
    }
    return _cells(histograms(fx.table(spark, sf, "lineitem"), wanted))


@register
def histograms_array(spark: SparkSession, sf: str) -> DataFrame:
    """The same over array columns."""
    columns = ("p0x_charge", "p0x_timing")
    wanted = {
        "charge": Histogram(columns[:1], (50,), SPAN2[:1], array=True, outer=True),
        "timing": Histogram(columns[1:], (60,), ((0.0, 9000.0),), array=True, edges="numpy"),
        "both": Histogram(columns, (40, 60), SPAN2, array=True),
    }
    return _cells(histograms(_plane_arrays(spark, sf), wanted))


@register
def zip_arrays_(spark: SparkSession, sf: str) -> DataFrame:
    pairs = zip_arrays(_plane_arrays(spark, sf), "p0x_charge", "p0x_timing")
    return pairs.select(r6("p0x_charge").alias("charge"), r6("p0x_timing").alias("timing"))


@register
def offset_summary_(spark: SparkSession, sf: str) -> DataFrame:
    return offset_summary(fx.event_messages(spark, sf), "click")


EVENT_FIELDS = ["runnumber", "ts", "mod"]


@register
def capture(spark: SparkSession, sf: str) -> DataFrame:
    captured = capture_messages(fx.event_messages(spark, sf), 100, first=20)
    return explode_hits(captured, keep=EVENT_FIELDS)


@register
def decode_first(spark: SparkSession, sf: str) -> DataFrame:
    messages = fx.event_messages(spark, sf).select("value", "timestamp")
    return explode_hits(decode_events(messages, rows="first"), keep=EVENT_FIELDS)


@register
def decode_all(spark: SparkSession, sf: str) -> DataFrame:
    messages = fx.encode(fx.single_hit_events(fx.hits(spark, sf)), per_message=16)
    return explode_hits(decode_events(messages, rows="all"))


@register
def decode_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Messages of several events, each in a record batch of its own and with its fields in another
    order, decoded with the defaults."""
    messages = fx.encode(fx.whole_events(fx.hits(spark, sf)), per_message=5, turned=True)
    return explode_hits(decode_events(messages), keep=["runnumber"])


@register
def kafka_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows for a Kafka sink, with the JSON taken apart again."""
    pairs = pair_edges(_flipped(spark, sf))
    fields = F.from_json("value", pairs.schema.simpleString())
    return to_kafka_rows(pairs).select("key", fields.alias("row")).select("key", "row.*")


def _streamed(spark: SparkSession, sf: str, copies: int, dedup: bool, local: bool = False) -> DataFrame:
    """Events as stored messages, streamed file by file through the strip plan."""
    folder = work_folder(spark, "stream")
    events = fx.whole_events(fx.hits(spark, sf)).withColumn(
        "timestamp", F.timestamp_seconds(1_700_000_000 + F.col("event_id") % 5)
    )
    messages = fx.encode(events)
    for _ in range(copies):
        messages.write.mode("append").parquet(f"{folder}/messages")
    source = (
        spark.readStream.schema(messages.schema)
        .option("maxFilesPerTrigger", 8)
        .parquet(f"{folder}/messages")
    )

    def nested(events: DataFrame) -> DataFrame:
        return _strip(spark, events, strip_local, detectors=DETECTORS, full=True, keep=["runnumber", "stream_uts"])

    query = (run_local if local else run_stream)(
        decode_stream(source),
        nested if local else lambda hits: _strip(spark, hits, detectors=DETECTORS, full=True),
        f"{folder}/processed",
        f"{folder}/checkpoint",
        dedup=dedup,
        trigger={"availableNow": True},
    )
    query.awaitTermination()
    processed = f"{folder}/processed"
    done = spark.read.parquet(processed) if local else read_committed(spark, processed)
    return _strip_full(done.withColumn("stream_uts", F.col("stream_uts").cast("long")), "runnumber", "stream_uts")


@register
def stream_strip(spark: SparkSession, sf: str) -> DataFrame:
    return _streamed(spark, sf, 1, False)


@register
def stream_local(spark: SparkSession, sf: str) -> DataFrame:
    """Append mode, each event in its row from message to result."""
    return _streamed(spark, sf, 1, False, local=True)


@register
def stream_local_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return _streamed(spark, sf, 2, True, local=True)


@register
def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return _streamed(spark, sf, 2, True)


def queries() -> dict[str, Query]:
    return {name.rstrip("_"): query for name, query in REGISTERED.items()}
