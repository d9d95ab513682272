"""Classes of near-equal texts from buckets of possible partners.

Two texts that share a bucket may be linked: the weighted Jaccard likeness of their items is at least a
threshold. Only classes, the connected components, are asked for, so a bucket of n linked texts needs
n - 1 comparisons with one of them, its head. In buckets that then hold more than one class, every text
outside the largest class is compared with all texts of other classes, so no link between texts that share
a bucket is lost. This is done block by block inside tasks, against an inverted index of a block; pairs
are never rows, and a pair that shares several buckets is compared in one of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.llm.common import classes, stage, whole_groups

# Members that one task compares with one head before the head is repeated for the next task.
SALT_ROWS = 1000

# Members of a bucket in a block.
BLOCK = 512

# A text made ready: its different items in ascending order, and their weights.
Items = tuple[np.ndarray, np.ndarray]


def likeness(x: Items, y: Items) -> float:
    """Weighted Jaccard: sum of the smaller weights over sum of the larger."""
    _, i, j = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
    low = np.minimum(x[1][i], y[1][j]).sum()
    total = x[1].sum() + y[1].sum() - low
    return float(low / total) if total else 0.0


def plain_likeness(x: Items, y: Items) -> float:
    """Jaccard of the items without their weights."""
    both = len(np.intersect1d(x[0], y[0], assume_unique=True))
    total = len(x[0]) + len(y[0]) - both
    return both / total if total else 0.0


class Index:
    """Inverted index of some texts."""

    def __init__(self, texts: list[Items], plain: bool = False):
        if plain:
            texts = [(t[0], np.ones(len(t[0]))) for t in texts]
        items = np.concatenate([t[0] for t in texts])
        order = np.argsort(items, kind="stable")
        self.items = items[order]
        self.weight = np.concatenate([t[1] for t in texts])[order]
        self.owner = np.repeat(np.arange(len(texts)), [len(t[0]) for t in texts])[order]
        self.total = np.array([t[1].sum() for t in texts])

    def likeness(self, x: Items) -> np.ndarray:
        """Likeness of `x` with each of the texts."""
        low = np.searchsorted(self.items, x[0], "left")
        n = np.searchsorted(self.items, x[0], "right") - low
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        both = np.bincount(self.owner[at], np.minimum(self.weight[at], np.repeat(x[1], n)), len(self.total))
        return both / np.maximum(self.total + x[1].sum() - both, 1e-300)


def compare(
    pairs: DataFrame, texts: DataFrame, prepare: Callable[[list[bytes]], list[Items]], plain: bool = False
) -> DataFrame:
    """(a, b, sim) for each of `pairs` (a, b); `texts` is (id, text). With `plain` the likeness is the larger
    of the weighted one and that without weights.

    Members of a head are dealt to tasks by (head, salt) with as many salts as `SALT_ROWS` needs, and the
    head's text is sent once for each. A task holds one prepared head and streams its members.
    """
    heads = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / SALT_ROWS).alias("salts"))
    salted = pairs.join(heads, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")))
    member = salted.join(texts.withColumnRenamed("id", "b"), "b").select("a", "salt", F.lit(1).alias("kind"), "b", "text")
    head = (
        heads.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"))
        .join(texts.withColumnRenamed("id", "a"), "a")
        .select("a", "salt", F.lit(0).alias("kind"), F.col("a").alias("b"), "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, ready = None, None
        for batch in batches:
            a, salt, kind, b = (batch.column(i).to_pylist() for i in range(4))
            texts = batch.column(4).cast(pa.binary()).to_pylist()
            made = prepare([t or b"" for t in texts])
            out: tuple[list, list, list] = ([], [], [])
            for i in range(len(a)):
                if kind[i] == 0:
                    current, ready = (a[i], salt[i]), made[i]
                elif current == (a[i], salt[i]):
                    sim = likeness(ready, made[i])
                    if plain:
                        sim = max(sim, plain_likeness(ready, made[i]))
                    for column, value in zip(out, (a[i], b[i], sim), strict=True):
                        column.append(value)
                else:
                    raise ValueError("member without its head")
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())],
                names=["a", "b", "sim"],
            )

    return (
        head.unionByName(member)
        .repartition("a", "salt")
        .sortWithinPartitions("a", "salt", "kind")
        .mapInArrow(run, "a long, b long, sim double")
    )


def compare_blocks(
    members: DataFrame,
    texts: DataFrame,
    prepare: Callable[[list[bytes]], list[Items]],
    threshold: float,
    plain: bool = False,
) -> DataFrame:
    """(a, b, sim): links that join the classes of ids which share a bucket of `members` (bucket, id, class);
    of the links of a group that join the same classes one stands for all.

    Ids outside the bucket's largest class and ids of that class are cut in blocks of some `BLOCK` ids;
    two blocks, one of them of the first kind, are a group of bounded size. An id carries its buckets; a
    pair counts in the smallest it shares."""
    kinds = members.groupBy("bucket", "class").agg(F.count(F.lit(1)).alias("n"))
    blocks = kinds.groupBy("bucket").agg(
        F.max_by("class", F.struct("n", "class")).alias("major"), F.max("n").alias("most"), F.sum("n").alias("all")
    )
    blocks = blocks.select(
        "bucket", "major", F.ceil((F.col("all") - F.col("most")) / BLOCK).alias("minors"), F.ceil(F.col("most") / BLOCK).alias("majors")
    )
    of_id = members.groupBy("id").agg(F.sort_array(F.collect_set("bucket")).alias("buckets"))
    rows = members.join(blocks, "bucket").join(of_id, "id").join(texts, "id")
    is_major, deal = F.col("class") == F.col("major"), F.xxhash64(F.lit(3), F.col("id"))
    rows = rows.withColumn(
        "chunk", F.when(is_major, F.col("minors") + F.pmod(deal, F.col("majors"))).otherwise(F.pmod(deal, F.col("minors")))
    )
    last = F.when(is_major, F.col("minors")).otherwise(F.col("minors") + F.col("majors")) - 1
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), last))).select(
        "bucket", F.least("chunk", "other").alias("ci"), F.greatest("chunk", "other").alias("cj"),
        "chunk", "id", "class", "buckets", "text",
    )

    def group(t: pa.Table) -> tuple[list[int], list[int], list[float]]:
        c = {k: t.column(k).to_pylist() for k in ("bucket", "ci", "cj", "chunk", "id", "class", "buckets")}
        ready = prepare([x or b"" for x in t.column("text").cast(pa.binary()).to_pylist()])
        n, first = len(ready), np.array([k == c["ci"][0] for k in c["chunk"]])
        kind, held = np.array(c["class"]), [frozenset(b) for b in c["buckets"]]
        left = np.flatnonzero(first)
        right = np.arange(n) if c["ci"][0] == c["cj"][0] else np.flatnonzero(~first)
        found: tuple[list[int], list[int], list[float]] = ([], [], [])
        if not len(left) or not len(right):
            return found
        index = Index([ready[k] for k in right])
        bare = Index([ready[k] for k in right], plain=True) if plain else None
        # links that join classes which earlier links of the group have joined say nothing new
        joined: dict[int, int] = {}

        def root(k: int) -> int:
            while joined.get(k, k) != k:
                k = joined[k]
            return k

        for i in left.tolist():
            sim = index.likeness(ready[i])
            if bare is not None:
                sim = np.maximum(sim, bare.likeness((ready[i][0], np.ones(len(ready[i][0])))))
            for k in np.flatnonzero((sim >= threshold) & (kind[right] != kind[i])).tolist():
                j = int(right[k])
                x, y = root(c["class"][i]), root(c["class"][j])
                if x != y and min(held[i] & held[j]) == c["bucket"][0]:
                    joined[max(x, y)] = min(x, y)
                    for column, value in zip(found, (c["id"][i], c["id"][j], float(sim[k])), strict=True):
                        column.append(value)
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["bucket", "ci", "cj"]):
            keys = np.stack([np.asarray(table.column(k)) for k in ("bucket", "ci", "cj")])
            cut = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(0))).tolist()
            for a, b in zip(cut, [*cut[1:], table.num_rows], strict=True):
                x, y, sim = group(table.slice(a, b - a))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()), pa.array(y, pa.int64()), pa.array(sim, pa.float64())], names=["a", "b", "sim"]
                )

    return (
        rows.repartition("bucket", "ci", "cj")
        .sortWithinPartitions("bucket", "ci", "cj")
        .mapInArrow(run, "a long, b long, sim double")
    )


def near_classes(
    buckets: DataFrame,
    fetch: Callable[[DataFrame], DataFrame],
    prepare: Callable[[list[bytes]], list[Items]],
    threshold: float,
    slack: float = 1e-9,
    plain: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(id, class) of the ids that are linked, and the verified links (a, b, sim).

    `buckets` is (bucket, id, size): texts that share a bucket are possible partners. `size` bounds the
    likeness of two texts from above by (smaller / larger). `fetch` gives (id, text) for a table of ids,
    those that share a bucket. `prepare` turns texts into items and weights. With `plain` texts are linked
    too whose likeness without weights is at least the threshold; `size` is that of the bucket's own measure.
    """
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("bucket")
    member = stage(buckets.join(shared, "bucket"), "bucket_members")
    texts = stage(fetch(member.select("id").distinct()), "candidate_texts")
    bound = F.least("size", "head_size") >= F.lit(threshold - slack) * F.greatest("size", "head_size")
    head = member.groupBy("bucket").agg(F.min(F.struct(F.col("id").alias("head"), F.col("size").alias("head_size"))).alias("h"))
    pairs = member.join(head.select("bucket", "h.head", "h.head_size"), "bucket").filter("id != head").filter(bound)
    pairs = pairs.select(F.col("head").alias("a"), F.col("id").alias("b")).distinct()
    links = stage(compare(pairs, texts, prepare, plain).filter(F.col("sim") >= threshold), "head_links")
    at = classes(links)
    # buckets that still hold more than one class; two ids have been compared
    own = member.join(at, "id", "left").select("bucket", "id", F.coalesce("class", "id").alias("class"))
    mixed = own.groupBy("bucket").agg(
        F.min("class").alias("lo"), F.max("class").alias("hi"), F.count(F.lit(1)).alias("n")
    )
    open_ = stage(own.join(mixed.filter("lo != hi and n > 2").select("bucket"), "bucket"), "open_buckets")
    more = stage(compare_blocks(open_, texts, prepare, threshold, plain), "block_links")
    if more.isEmpty():
        return at, links
    links = links.unionByName(more)
    return classes(links), links
