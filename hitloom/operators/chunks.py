"""Result rows of bounded length: the arrays of an event cut into parts by rank."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitloom.schema import EVENT_KEY
from hitloom.storage import work_folder


def numbered(df: DataFrame, group: Sequence[str], order: Sequence[str], spread: bool = False) -> DataFrame:
    """`df` with ``_rank``, the place of each row in its group by `order`, from 0.

    Ordinary groups are numbered by one sweep each.  Groups that are `spread` have too many rows for that: rows
    are dealt to ranges of (group, order) of about equal size, which is stored so that a row keeps its range when
    a task is repeated, counted by range, and numbered within the range from the rows of the ranges before.
    """
    if not spread:
        sweep = Window.partitionBy(*group).orderBy(*order)
        return df.withColumn("_rank", F.row_number().over(sweep).cast("long") - 1)
    spark = df.sparkSession
    path = work_folder(spark, "ranges")
    df.repartitionByRange(*group, *order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.parquet(path)
    keys = [*group, "_range"]
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    counts = counts.select(*[F.col(k).alias(f"_of_{k}") for k in keys], "_before")
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    joined = ranged.join(counts, same).drop(*[f"_of_{k}" for k in keys])
    sweep = Window.partitionBy(*group, "_range").orderBy(*order)
    return joined.withColumn("_rank", F.col("_before") + F.row_number().over(sweep) - 1).drop("_range", "_before")


def chunked(
    df: DataFrame,
    lists: dict[str, tuple[Column, Sequence[str]]],
    size: int,
    category: str | None = None,
    order: Sequence[str] = ("timing", "id", "charge"),
    spread: bool = False,
    event_key: str = EVENT_KEY,
) -> DataFrame:
    """``event, part`` and the lists of each part: the rows of an event in `order`, `size` to a part, from part 0.

    `lists` gives for each output struct array the rows it takes and their columns; with `category` each category
    of the event is numbered by itself, so part k holds the k-th `size` rows of every category.  An array is null
    where its part is empty.  The parts of an event joined in order are its whole arrays.
    """
    group = [event_key] if category is None else [event_key, category]
    ranked = numbered(df, group, order, spread)
    parts = ranked.withColumn("part", F.floor(F.col("_rank") / F.lit(size)))

    def listed(condition: Column, columns: Sequence[str]) -> Column:
        entry = F.struct("_rank", *columns)
        found = F.sort_array(F.collect_list(F.when(condition, entry)))
        return F.when(F.size(found) > 0, F.transform(found, lambda e: F.struct(*[e[c].alias(c) for c in columns])))

    return parts.groupBy(event_key, "part").agg(*[listed(*spec).alias(name) for name, spec in lists.items()])
