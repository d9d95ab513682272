"""Histograms as counts per bin.

Counting is a grouped aggregation whose partial counts are merged before the shuffle, so at most one
row per bin leaves each task.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.functions import bin_edge, bin_guess, bin_number

Range = tuple[float, float]


def _bins(nbins: int, edges: str) -> int:
    """Number of bins: ``"points"`` reads `nbins` as the number of edges, ``"numpy"`` as bins."""
    if edges == "points":
        if nbins < 2:
            raise ValueError("a histogram needs two edges")
        return nbins - 1
    if edges == "numpy":
        return nbins
    raise ValueError(f"unknown edge rule {edges!r}")


def _counted(
    df: DataFrame,
    axes: dict[str, tuple[str, int, Range]],
    edges: str,
    nan: str | None,
    outer: bool,
) -> DataFrame:
    """Rows per combination of bins, for axes ``bin: (column, nbins, span)``; null is left out.

    Rows are chosen by their values before they are binned, so the choice reaches the scan and is
    not repeated on the bin numbers.
    """
    nan = nan or ("error" if edges == "points" else "drop")
    if nan not in ("error", "drop"):
        raise ValueError(f"unknown NaN choice {nan!r}")
    closed = edges == "numpy"
    values = df.select(*[F.col(c).cast("double").alias(f"_v_{b}") for b, (c, _, _) in axes.items()])
    chosen, refused = F.lit(True), F.lit(False)
    guesses, numbers = [], []
    for output, (_, nbins, span) in axes.items():
        bins = _bins(nbins, edges)
        value, guess = F.col(f"_v_{output}"), F.col(f"_g_{output}")
        inside = value.isNotNull() & ~F.isnan(value)
        if not outer:
            below_top = value <= F.lit(float(span[1])) if closed else value < F.lit(float(span[1]))
            inside = (value >= F.lit(float(span[0]))) & below_top
        chosen, refused = chosen & inside, refused | F.isnan(value)
        number = bin_number(value, guess, *span, bins, closed)
        if nan == "error":
            stop = F.raise_error(F.lit("NaN in a histogram column")).cast("long")
            number = F.when(F.isnan(value), stop).otherwise(number)
        guesses += [value, bin_guess(value, *span, bins).alias(f"_g_{output}")]
        numbers.append(number.alias(output))
    kept = values.filter(chosen | refused if nan == "error" else chosen)
    return kept.select(*guesses).select(*numbers).groupBy(*axes).agg(F.count(F.lit(1)).alias("n"))


def _counts_1d(
    df: DataFrame,
    column: str,
    nbins: int,
    span: Range,
    array: bool,
    edges: str,
    nan: str | None,
    outer: bool,
) -> DataFrame:
    values = df.select((F.explode(column) if array else F.col(column)).alias("_value"))
    return _counted(values, {"bin": ("_value", nbins, span)}, edges, nan, outer)


def hist1d(
    df: DataFrame,
    column: str,
    nbins: int,
    span: Range,
    array: bool = False,
    edges: str = "points",
    nan: str | None = None,
    outer: bool = False,
) -> DataFrame:
    """``bin, lo, hi, center, n`` for every bin, empty ones included.

    ``edges="points"``: `nbins` edges from `span` make ``nbins - 1`` half-open bins; values at the
    upper limit are overflow and NaN is an error.  ``edges="numpy"``: `nbins` bins over the closed
    range, NaN dropped.  Nulls are always dropped.  `array` counts the elements of an array column;
    `outer` adds the underflow (bin 0) and overflow bins.
    """
    bins = _bins(nbins, edges)
    counts = _counts_1d(df, column, nbins, span, array, edges, nan, outer)
    first, last = (0, bins + 1) if outer else (1, bins)
    every = df.sparkSession.range(first, last + 1).select(F.col("id").alias("bin"))
    inside = F.col("bin").between(1, bins)
    low = bin_edge(F.col("bin") - 1, *span, bins)
    high = bin_edge(F.col("bin"), *span, bins)
    return every.join(counts, "bin", "left").select(
        "bin",
        F.when(inside | (F.col("bin") == bins + 1), low).alias("lo"),
        F.when(inside | (F.col("bin") == 0), high).alias("hi"),
        F.when(inside, 0.5 * (low + high)).alias("center"),
        F.coalesce("n", F.lit(0).cast("long")).alias("n"),
    )


def hist1d_stats(
    df: DataFrame,
    column: str,
    nbins: int,
    span: Range,
    array: bool = False,
    nan: str | None = None,
) -> DataFrame:
    """One row: total entries and how many lie below, inside and above the range."""
    counts = _counts_1d(df, column, nbins, span, array, "points", nan, True)
    total = F.coalesce(F.sum("n"), F.lit(0).cast("long"))

    def part(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0).cast("long"))

    return counts.agg(
        total.alias("entries"),
        part(F.col("bin") == 0).alias("underflow"),
        part(F.col("bin").between(1, nbins - 1)).alias("inside"),
        part(F.col("bin") == nbins).alias("overflow"),
    )


def zip_arrays(df: DataFrame, first: str, second: str) -> DataFrame:
    """Element pairs of two aligned array columns, to the length of the shorter one."""
    pairs = F.arrays_zip(F.col(first).alias("_x"), F.col(second).alias("_y"))
    common = F.slice(pairs, F.lit(1), F.least(F.size(first), F.size(second)))
    both = F.col(first).isNotNull() & F.col(second).isNotNull()
    rows = df.filter(both).select(F.inline(common))
    return rows.select(F.col("_x").alias(first), F.col("_y").alias(second))


def _counts_2d(
    df: DataFrame,
    columns: tuple[str, str],
    nbins: tuple[int, int],
    span: tuple[Range, Range],
    array: bool,
    edges: str,
    nan: str | None,
    outer: bool,
) -> DataFrame:
    values = zip_arrays(df, *columns) if array else df
    axes = {axis: (columns[i], nbins[i], span[i]) for i, axis in enumerate(("bin_x", "bin_y"))}
    return _counted(values, axes, edges, nan, outer)


def hist2d(
    df: DataFrame,
    columns: tuple[str, str],
    nbins: tuple[int, int],
    span: tuple[Range, Range],
    array: bool = False,
    edges: str = "points",
    nan: str | None = None,
    dense: bool = False,
) -> DataFrame:
    """``bin_x, bin_y, x, y, n`` (bin centres) of the cells inside both ranges.

    Edge rules as in :func:`hist1d`; rows null on either axis are dropped.  `array` pairs the
    elements of two aligned array columns, `dense` adds the empty cells.
    """
    bins = (_bins(nbins[0], edges), _bins(nbins[1], edges))
    counts = _counts_2d(df, columns, nbins, span, array, edges, nan, False)
    if dense:
        cells = df.sparkSession.range(bins[0] * bins[1]).select(
            (F.floor(F.col("id") / bins[1]) + 1).alias("bin_x"),
            (F.col("id") % bins[1] + 1).alias("bin_y"),
        )
        counts = cells.join(counts, ["bin_x", "bin_y"], "left").fillna(0, ["n"])

    def center(axis: int, name: str) -> Column:
        low = bin_edge(F.col(name) - 1, *span[axis], bins[axis])
        return 0.5 * (low + bin_edge(F.col(name), *span[axis], bins[axis]))

    return counts.select(
        "bin_x", "bin_y", center(0, "bin_x").alias("x"), center(1, "bin_y").alias("y"), "n"
    )


def hist2d_stats(
    df: DataFrame,
    columns: tuple[str, str],
    nbins: tuple[int, int],
    span: tuple[Range, Range],
    array: bool = False,
    nan: str | None = None,
) -> DataFrame:
    """Entries in the 3 x 3 zones: 0 below, 1 inside, 2 above the range of each axis."""
    counts = _counts_2d(df, columns, nbins, span, array, "points", nan, True)

    def zone(name: str, edges: int) -> Column:
        bin_ = F.col(name)
        return F.when(bin_ == 0, 0).when(bin_ == edges, 2).otherwise(1)

    zones = counts.groupBy(
        zone("bin_x", nbins[0]).alias("zone_x"), zone("bin_y", nbins[1]).alias("zone_y")
    ).agg(F.sum("n").alias("n"))
    every = df.sparkSession.range(9).select(
        F.floor(F.col("id") / 3).cast("int").alias("zone_x"),
        (F.col("id") % 3).cast("int").alias("zone_y"),
    )
    return every.join(zones, ["zone_x", "zone_y"], "left").fillna(0, ["n"])


@dataclass(frozen=True)
class Histogram:
    """One histogram among several: one or two columns with their bins and ranges, as in :func:`hist1d` and
    :func:`hist2d`.  `outer` adds the outer bins of a histogram of one column."""

    columns: tuple[str, ...]
    nbins: tuple[int, ...]
    span: tuple[Range, ...]
    array: bool = False
    edges: str = "points"
    nan: str | None = None
    outer: bool = False

    @property
    def bins(self) -> list[int]:
        return [_bins(n, self.edges) for n in self.nbins]


def _entry(number: int, h: Histogram, values: list[Column], guesses: list[Column]) -> Column:
    """The cell of a value (pair) as struct(hist, bin_x, bin_y); null for what the histogram leaves out."""
    closed = h.edges == "numpy"
    nan = h.nan or ("drop" if closed else "error")
    if nan not in ("error", "drop"):
        raise ValueError(f"unknown NaN choice {nan!r}")
    chosen, numbers = F.lit(True), []
    for value, guess, bins, span in zip(values, guesses, h.bins, h.span, strict=True):
        kept = value.isNotNull() & ~F.isnan(value)
        if not h.outer:
            low, high = F.lit(float(span[0])), F.lit(float(span[1]))
            kept = (value >= low) & (value <= high if closed else value < high) & ~F.isnan(value)
        chosen = chosen & kept
        numbers.append(bin_number(value, guess, *span, bins, closed).cast("long"))
    cell = F.struct(
        F.lit(number).alias("hist"), numbers[0].alias("bin_x"), (numbers[1] if len(numbers) > 1 else F.lit(None).cast("long")).alias("bin_y")
    )
    found = F.when(F.coalesce(chosen, F.lit(False)), cell)
    if nan == "error":
        refused = F.lit(False)
        for value in values:
            refused = refused | F.coalesce(F.isnan(value), F.lit(False))
        stop = F.raise_error(F.lit("NaN in a histogram column")).cast("struct<hist:int,bin_x:bigint,bin_y:bigint>")
        found = F.when(refused, stop).otherwise(found)
    return found


def histograms(df: DataFrame, wanted: Mapping[str, Histogram]) -> DataFrame:
    """``hist, bin_x, bin_y, x, y, n`` of several histograms from one scan and one exchange.

    Each row gives an entry (histogram, cell) to every histogram it counts in, and entries are counted map-side,
    so that a task passes on one row at most for each cell.  Histograms of one column have a row for every bin,
    empty ones too, with null ``bin_y`` and ``y``; those of two columns a row for each cell that is not empty.
    ``x`` and ``y`` are bin centres, null for outer bins.  Rules as in :func:`hist1d` and :func:`hist2d`.
    """
    specs = list(wanted.items())
    for name, h in specs:
        if not 1 <= len(h.columns) == len(h.nbins) == len(h.span) <= 2 or (h.outer and len(h.columns) > 1):
            raise ValueError(f"histogram {name!r} needs one or two columns with bins and ranges, outer bins one")
    values, guesses, lists = {}, {}, []
    for i, (_, h) in enumerate(specs):
        if h.array:
            parts = [F.col(c) for c in h.columns]
            both = F.arrays_zip(*[p.alias(f"v{a}") for a, p in enumerate(parts)])
            common = F.slice(both, F.lit(1), F.least(*[F.size(p) for p in parts], F.lit((1 << 31) - 1)))

            def guessed(e: Column, h: Histogram = h) -> list[Column]:
                out = []
                for a, (bins, span) in enumerate(zip(h.bins, h.span, strict=True)):
                    v = e[f"v{a}"].cast("double")
                    out += [v.alias(f"v{a}"), bin_guess(v, *span, bins).alias(f"g{a}")]
                return out

            lists.append(_array_entries(i, h, common, guessed))
            continue
        for a, (c, bins, span) in enumerate(zip(h.columns, h.bins, h.span, strict=True)):
            values[f"_v{i}_{a}"] = F.col(c).cast("double")
            guesses[f"_g{i}_{a}"] = bin_guess(F.col(f"_v{i}_{a}"), *span, bins)
        own = [[F.col(f"_{k}{i}_{a}") for a in range(len(h.columns))] for k in "vg"]
        lists.append(F.array(_entry(i, h, *own)))
    kept = {c for _, h in specs if h.array for c in h.columns}
    rows = df.select(*[F.col(c) for c in sorted(kept)], *[v.alias(k) for k, v in values.items()])
    rows = rows.select("*", *[v.alias(k) for k, v in guesses.items()])
    entries = rows.select(F.inline(F.array_compact(F.flatten(F.array(*lists)))))
    single = [(i, 0 if h.outer else 1, h.bins[0] + h.outer) for i, (_, h) in enumerate(specs) if len(h.columns) == 1]
    every = df.sparkSession.createDataFrame(single, "hist int, first long, last long").select(
        "hist", F.explode(F.sequence("first", "last")).alias("bin_x"), F.lit(None).cast("long").alias("bin_y"), F.lit(0).cast("long").alias("n")
    )
    entries = entries.withColumn("n", F.lit(1).cast("long")).unionByName(every)
    filled = entries.groupBy("hist", "bin_x", "bin_y").agg(F.sum("n").alias("n"))
    x, y, label = F.lit(None).cast("double"), F.lit(None).cast("double"), F.lit(None).cast("string")
    for i, (name, h) in enumerate(specs):
        is_it = F.col("hist") == i

        def center(axis: int, column: str, h: Histogram = h) -> Column:
            low = bin_edge(F.col(column) - 1, *h.span[axis], h.bins[axis])
            middle = 0.5 * (low + bin_edge(F.col(column), *h.span[axis], h.bins[axis]))
            return F.when(F.col(column).between(1, h.bins[axis]), middle)

        x, label = F.when(is_it, center(0, "bin_x")).otherwise(x), F.when(is_it, F.lit(name)).otherwise(label)
        if len(h.columns) > 1:
            y = F.when(is_it, center(1, "bin_y")).otherwise(y)
    return filled.select(label.alias("hist"), "bin_x", "bin_y", x.alias("x"), y.alias("y"), "n")


def _array_entries(number: int, h: Histogram, elements: Column, guessed) -> Column:
    """The entries of the elements of array columns; null arrays have none."""
    axes = range(len(h.columns))
    named = F.transform(elements, lambda e: F.struct(*guessed(e)))
    found = F.transform(named, lambda e: _entry(number, h, [e[f"v{a}"] for a in axes], [e[f"g{a}"] for a in axes]))
    return F.coalesce(found, F.array().cast("array<struct<hist:int,bin_x:bigint,bin_y:bigint>>"))
