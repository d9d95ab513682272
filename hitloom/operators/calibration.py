"""Channel units to physical units."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.functions import dithered
from hitloom.sizing import broadcast_if_small


def to_float(
    df: DataFrame,
    columns: str | Sequence[str],
    offset: float = 0.0,
    factor: float = 1.0,
    dither: str = "hash",
    keys: Sequence[str] | None = None,
    seed: int = 0,
) -> DataFrame:
    """Replace integer `columns` by ``offset + factor * (column + u)``, u in [0, 1).

    See :func:`hitloom.functions.dithered` for the choices of u.  Hash keys default to all columns;
    each replaced column has a sequence of its own.
    """
    names = [columns] if isinstance(columns, str) else list(columns)
    key_columns = [F.col(k) for k in (keys if keys is not None else df.columns)]
    replaced = {
        name: dithered(F.col(name), offset, factor, dither, key_columns, seed + i)
        for i, name in enumerate(names)
    }
    return df.select(*[replaced[c].alias(c) if c in replaced else F.col(c) for c in df.columns])


def linear_calib(
    df: DataFrame,
    coefficients: DataFrame,
    charge: str = "charge",
    id: str = "id",
    p0: str = "p0",
    p1: str = "p1",
) -> DataFrame:
    """``charge`` becomes ``p0 + p1 * charge`` of its `id`; ids without coefficients give null."""
    table = coefficients.select(id, F.col(p0).alias("_p0"), F.col(p1).alias("_p1"))
    joined = df.join(broadcast_if_small(table), id, "left")
    calibrated = F.col("_p0") + F.col("_p1") * F.col(charge)
    return joined.select(*[calibrated.alias(c) if c == charge else F.col(c) for c in df.columns])


def linear_calib_array(
    df: DataFrame,
    coefficients: DataFrame,
    charge: str = "charge",
    id: str = "id",
    p0: str = "p0",
    p1: str = "p1",
) -> DataFrame:
    """:func:`linear_calib` where `charge` is an array of one element's charges."""
    table = coefficients.select(id, F.col(p0).alias("_p0"), F.col(p1).alias("_p1"))
    joined = df.join(broadcast_if_small(table), id, "left")
    calibrated = F.transform(charge, lambda q: F.col("_p0") + F.col("_p1") * q)
    return joined.select(*[calibrated.alias(c) if c == charge else F.col(c) for c in df.columns])
