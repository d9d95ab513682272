"""Column expressions: pure built-in functions, usable in any select or filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# 2^53: the number of equally spaced doubles in [0, 1).
_UNIT_STEPS = 9007199254740992


def in_open_window(value: Column, low: float, high: float) -> Column:
    """``low < value < high``; both limits excluded, null is not inside."""
    return (value > F.lit(low)) & (value < F.lit(high))


def flipped_edge(cat: Column, edge: Column, keep_suffix: str = "a") -> Column:
    """Swap leading and trailing edge except for categories ending in `keep_suffix`."""
    return F.when(cat.endswith(keep_suffix), edge).otherwise(1 - edge)


def dithered(
    value: Column,
    offset: float = 0.0,
    factor: float = 1.0,
    how: str = "hash",
    keys: Sequence[Column] = (),
    seed: int = 0,
) -> Column:
    """``offset + factor * (value + u)`` with u in [0, 1).

    ``hash`` takes u from the row's `keys`, so recomputing a lost partition or reading the table in
    two branches gives the same number; ``rand`` is the generator; ``mid`` is always one half.
    """
    if how == "mid":
        unit = F.lit(0.5)
    elif how == "rand":
        unit = F.rand(seed)
    elif how == "hash":
        if not keys:
            raise ValueError("hash dither needs key columns")
        bits = F.xxhash64(*keys, F.lit(seed)).bitwiseAND(F.lit(_UNIT_STEPS - 1))
        unit = bits / F.lit(float(_UNIT_STEPS))
    else:
        raise ValueError(f"unknown dither {how!r}")
    return F.lit(float(offset)) + F.lit(float(factor)) * (value + unit)


def asymmetry(first: Column, second: Column) -> Column:
    """``(first - second) / (first + second)``, null where the sum is zero or a term is null."""
    return F.try_divide(first - second, first + second)


def strip_coordinate(
    id0: Column,
    id1: Column,
    sharing: Column,
    center: Column,
    pitch: Column,
    offset: Column,
    sign: Column,
) -> Column:
    """Position from the strongest strip, pulled half a pitch at most towards its neighbour."""
    toward = F.when(id0 < id1, F.lit(1)).otherwise(F.lit(-1))
    strips = id0 - center + (1 - sharing) * toward * 0.5
    return sign * (strips * pitch - offset)


def pair_features(
    t_left: Column, t_right: Column, q_left: Column, q_right: Column, compat: bool = False
) -> dict[str, Column]:
    """Time and charge features of a left/right pulse pair, by name.

    `compat` keeps the older averages, ``left + right / 2``.
    """

    def mean(left: Column, right: Column) -> Column:
        return left + right / 2.0 if compat else (left + right) / 2.0

    return {
        "tdiff": t_left - t_right,
        "tavg": mean(t_left, t_right),
        "qdiff": q_left - q_right,
        "qavg": mean(q_left, q_right),
        "qlog": F.log(F.try_divide(q_left, q_right)),
        "qsqsum": F.sqrt(q_left * q_right),
    }


def bin_edge(index: Column, low: float, high: float, bins: int) -> Column:
    """Edge number `index` (0 … bins) of `bins` equal bins; the last one is exactly `high`."""
    step = (high - low) / bins
    return F.when(index >= bins, F.lit(float(high))).otherwise(index * F.lit(step) + F.lit(float(low)))


def bin_guess(value: Column, low: float, high: float, bins: int) -> Column:
    """Bin of `value` by division: right up to one bin next to an edge.  Null and NaN give null."""
    return F.width_bucket(value, F.lit(float(low)), F.lit(float(high)), F.lit(bins))


def bin_number(
    value: Column, guess: Column, low: float, high: float, bins: int, closed: bool = False
) -> Column:
    """Bin of `value` among `bins` equal half-open bins: 0 below, 1 … bins inside, bins + 1 above.

    The `guess` from :func:`bin_guess`, best kept in a column, is compared with the edges themselves,
    so a value on an edge lands where a search through the edge list would put it.  With `closed` the
    upper limit belongs to the last bin.
    """
    step, last = (high - low) / bins, F.lit(bins).cast("long")
    lower = (guess - 1) * F.lit(step) + F.lit(float(low))
    upper = guess * F.lit(step) + F.lit(float(low))
    beyond = value > F.lit(float(high)) if closed else value >= F.lit(float(high))
    return (
        F.when(guess == 0, guess)
        .when(guess > bins, F.when(beyond, guess).otherwise(last))
        .when(value < lower, guess - 1)
        .when((guess < bins) & (value >= upper), guess + 1)
        .otherwise(guess)
    )


def _band(window: tuple[float, float]) -> tuple[float, float]:
    """Width of the cells of a band join, and how far its intervals are widened against rounding."""
    reach = float(window[1]) - float(window[0])
    return (reach * 1.001, reach * 0.0004) if reach > 0 else (1.0, 0.0004)


def band_cell(value: Column, window: tuple[float, float]) -> Column:
    """Cell of `value` in a band join: what lies within `window` of it, ``low <= value - other <= high``, has
    this cell among its two :func:`band_cells`."""
    width, margin = _band(window)
    return F.floor((value - F.lit(float(window[1]) + margin)) / F.lit(width))


def band_cells(other: Column, window: tuple[float, float]) -> Column:
    """The two cells of the other side of a band join, as an array."""
    own = F.floor(other / F.lit(_band(window)[0]))
    return F.array(own, own - 1)
