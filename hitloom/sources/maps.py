"""Channel maps: which electronic channel is which detector element."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.schema import CHANNEL_MAP, CHANNEL_MAP_UNNAMED


def _named(category: str | Mapping[str, tuple[int, int]]) -> Column:
    """The category of a row of a map without names."""
    if isinstance(category, str):
        return F.lit(category)
    inside = F.array_compact(
        F.array(*[F.when(F.col("id").between(*ends), F.lit(name)) for name, ends in category.items()])
    )
    wrong = F.concat(F.lit("id "), F.coalesce(F.col("id").cast("string"), F.lit("null")), F.lit(" is not in one range"))
    return F.when(F.size(inside) == 1, F.get(inside, F.lit(0))).otherwise(F.raise_error(wrong))


def read_channel_map(
    spark: SparkSession,
    path: str | Sequence[str],
    prefixes: Sequence[str] = (),
    category: str | Mapping[str, tuple[int, int]] | None = None,
) -> DataFrame:
    """Read ``cat,id,dev,fp,det,geo,ch`` with header, ``#`` comments and padded fields.

    Only categories starting with one of `prefixes` are kept; no prefix keeps all.  A file without
    the ``cat`` column is read by naming its `category`, or by a category for each range of ids (both
    ends included); an id outside all ranges, or in two, is an error when the map is read.
    """
    if isinstance(prefixes, str):
        raise TypeError("prefixes must be a list of names, not one string")
    schema = CHANNEL_MAP if category is None else CHANNEL_MAP_UNNAMED
    table = (
        spark.read.schema(schema)
        .option("header", True)
        .option("comment", "#")
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .csv(path if isinstance(path, str) else list(path))
    )
    if category is not None:
        table = table.select(_named(category).alias("cat"), *CHANNEL_MAP_UNNAMED.names)
    if prefixes:
        table = table.filter(reduce(or_, [F.col("cat").startswith(p) for p in prefixes]))
    return table
