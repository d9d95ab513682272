"""Near-equal vectors by cross-polytope hashing after fast Hadamard rotations."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.llm.common import classes, stage, whole_groups

# Rows of a bucket that one task compares with as many others; larger buckets are cut in blocks.
BLOCK = 256
PAIRS_AT_ONCE = 400_000

# Tables that leave less than one in a million pairs of cosine 0.98 unseen with four probes, by the
# number of hashes that make a bucket (measured in 64 dimensions).
TABLES = {1: 4, 2: 6, 3: 9, 4: 14}


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row (a power of two long), scaled to keep lengths."""
    n, width = x.shape
    h = 1
    while h < width:
        v = x.reshape(n, width // (2 * h), 2, h)
        x = np.stack([v[:, :, 0] + v[:, :, 1], v[:, :, 0] - v[:, :, 1]], axis=2).reshape(n, width)
        h *= 2
    return x / np.sqrt(width)


def corners(x: np.ndarray, seed: int, ranks: int) -> tuple[np.ndarray, np.ndarray]:
    """The `ranks` nearest corners of the cross-polytope after three signed rotations, and how far each
    is behind the first."""
    rng = np.random.default_rng(seed)
    for _ in range(3):
        x = hadamard(x * rng.choice([-1.0, 1.0], x.shape[1]))
    size = np.abs(x)
    at = np.argsort(-size, axis=1, kind="stable")[:, :ranks]
    size = np.take_along_axis(size, at, 1)
    return 2 * at + (np.take_along_axis(x, at, 1) < 0), size[:, :1] - size


def buckets(x: np.ndarray, functions: int, tables: int, probes: int, seed: int) -> np.ndarray:
    """Bucket numbers (rows, tables, probes); the first probe is the vector's own bucket."""
    width = 1 << max(x.shape[1] - 1, 1).bit_length()
    x = np.pad(x, ((0, 0), (0, width - x.shape[1])))
    ranks = min(3, width)
    combos = list(itertools.product(range(ranks), repeat=functions))
    out = np.empty((len(x), tables, probes), dtype=np.int64)
    for t in range(tables):
        found = [corners(x, seed + 1000 * t + f, ranks) for f in range(functions)]
        cost = np.stack([sum(d[:, r] for (_, d), r in zip(found, c, strict=True)) for c in combos], 1)
        code = np.stack(
            [sum(k[:, r] * (2 * width) ** f for f, ((k, _), r) in enumerate(zip(found, c, strict=True))) for c in combos],
            1,
        )
        best = np.argsort(cost, axis=1, kind="stable")[:, :probes]
        chosen = np.take_along_axis(code, best, 1)
        if chosen.shape[1] < probes:
            chosen = np.pad(chosen, ((0, 0), (0, probes - chosen.shape[1])), mode="edge")
        out[:, t] = chosen
    return out


def _codes(functions: int, tables: int, probes: int, seed: int):
    """Batches of (…, vec) with the bucket numbers of each vector added; vectors are of one width each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec = batch.column(batch.schema.get_field_index("vec"))
            width = np.asarray(vec.value_lengths())
            flat, end = np.asarray(vec.flatten()), np.cumsum(width)
            codes = np.zeros((batch.num_rows, tables * probes), dtype=np.int64)
            for w in np.unique(width):
                rows = np.flatnonzero(width == w)
                x = flat[(end[rows] - w)[:, None] + np.arange(w)]
                x = x / np.abs(x).max(1)[:, None]
                x /= np.linalg.norm(x, axis=1)[:, None]
                for a in range(0, len(rows), 2000):
                    part = buckets(x[a : a + 2000], functions, tables, probes, seed)
                    codes[rows[a : a + 2000]] = part.reshape(len(part), -1)
            offsets = np.arange(batch.num_rows + 1, dtype=np.int32) * (tables * probes)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(codes.ravel()))],
                names=[*batch.schema.names, "codes"],
            )

    return run


def _verify(threshold: float, tables: int, probes: int):
    """Links in each group (g, ci, cj): for a vector of the group how many vectors it links with, and the
    smallest vector that links of this group reach. A pair counts in the first table where it meets, and
    there in the smaller of the two buckets, so that sums over groups are right."""

    def count(t: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray, links: np.ndarray, root: np.ndarray) -> None:
        ok = (
            (t["rep"][i] != t["rep"][j]) & (t["label"][i] == t["label"][j]) & (t["dim"][i] == t["dim"][j])
            & (t["own"][i] | t["own"][j]) & ((t["chunk"][i] != t["chunk"][j]) | (t["ci"][i] == t["cj"][i]))
        )
        i, j = i[ok], j[ok]
        a, b = t["codes"][i], t["codes"][j]
        there = (b == a[:, :, :1]).any(2)
        back = (a == b[:, :, :1]).any(2)
        first = np.argmax(there | back, axis=1)
        k = np.arange(len(i))
        big = np.iinfo(np.int64).max
        at = np.minimum(
            np.where(there[k, first], a[k, first, 0], big), np.where(back[k, first], b[k, first, 0], big)
        )
        ok = (first == t["table"][i]) & (at == t["bucket"][i])
        i, j = i[ok], j[ok]
        dot = np.zeros(len(i))
        for w in np.unique(t["dim"][i]):
            m = np.flatnonzero(t["dim"][i] == w)
            x, y = t["vec"][i[m], :w], t["vec"][j[m], :w]
            dot[m] = np.einsum("ij,ij->i", x, y)
        dot /= t["norm"][i] * t["norm"][j]
        ok = dot >= threshold
        i, j = i[ok], j[ok]
        np.add.at(links, i, t["mult"][j])
        np.add.at(links, j, t["mult"][i])
        while len(i):
            low = np.minimum(root[i], root[j])
            if (low == root[i]).all() and (low == root[j]).all():
                break
            np.minimum.at(root, i, low)
            np.minimum.at(root, j, low)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["g", "ci", "cj"]):
            table = table.combine_chunks()
            t = {
                c: table.column(c).combine_chunks().to_numpy(zero_copy_only=False)
                for c in ("g", "ci", "cj", "chunk", "rep", "label", "dim", "mult", "table", "bucket", "own")
            }
            n = len(t["g"])
            codes = table.column("codes").combine_chunks()
            t["codes"] = np.asarray(codes.flatten()).reshape(n, tables, probes)
            vec = table.column("vec").combine_chunks()
            wide = int(t["dim"].max())
            t["vec"] = np.zeros((n, wide))
            flat, end = np.asarray(vec.flatten()), np.cumsum(t["dim"])
            for w in np.unique(t["dim"]):
                rows = np.flatnonzero(t["dim"] == w)
                x = flat[(end[rows] - w)[:, None] + np.arange(w)]
                t["vec"][rows, :w] = x / np.abs(x).max(1)[:, None]
            t["norm"] = np.linalg.norm(t["vec"], axis=1)
            new = np.ones(n, dtype=bool)
            new[1:] = (t["g"][1:] != t["g"][:-1]) | (t["ci"][1:] != t["ci"][:-1]) | (t["cj"][1:] != t["cj"][:-1])
            starts = np.flatnonzero(new)
            last = np.repeat(np.append(starts[1:], n), np.diff(np.append(starts, n)))
            links, root = np.zeros(n, dtype=np.int64), t["rep"].copy()
            partners = last - np.arange(n) - 1
            total = np.cumsum(partners)
            a = 0
            while a < n:
                b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + PAIRS_AT_ONCE)))
                p = partners[a:b]
                i = np.repeat(np.arange(a, b), p)
                j = i + 1 + np.arange(p.sum()) - np.repeat(np.cumsum(p) - p, p)
                if len(i):
                    count(t, i, j, links, root)
                a = b
            found = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(t["rep"][found]), pa.array(links[found]), pa.array(root[found])],
                names=["rep", "links", "root"],
            )

    return run


def near_vectors(
    df: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    threshold: float = 0.98,
    probes: int = 4,
    seed: int = 5,
) -> DataFrame:
    """(id, n_links, component_id, kept): vectors of one label linked by cosine >= `threshold`.

    Each vector has a bucket per table, made of cross-polytope hashes, and looks into `probes` buckets
    per table, those of the nearest corners. Candidates are verified in double precision, so no link is
    below the threshold; the tables are as many as leave less than one in a million links of cosine 0.98
    unseen (see `TABLES`; lower thresholds need more). The number of hashes of a bucket follows the
    largest label, so buckets keep their size.

    Vectors that are null, empty or zero, that hold null or non-finite components, and rows with a null
    label or id link with nothing: ``n_links`` 0, their own id as component. Vectors of different lengths do
    not link. Equal vectors are compared as one, with their number; rows that repeat an id are vectors of
    their own. ``n_links`` counts the other vectors linked directly, ``component_id`` is the smallest id
    that links reach, ``kept`` tells whether it is the row's id (null id: false). An empty table gives an
    empty table; other columns are left out.

    Buckets of more than `BLOCK` vectors are cut in blocks and compared block by block; tasks return sums
    and roots, not pairs. Vectors move only for buckets that hold a possible pair.
    """
    ids, label, vec = F.col(id_col).cast("long"), F.col(label_col), F.col(vec_col).cast("array<double>")
    rows = df.select(ids.alias("id"), F.xxhash64(label.cast("string")).alias("label"), label.isNotNull().alias("known"), vec.alias("vec"))
    usable = (
        F.col("known") & F.col("id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0)
        & F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists("vec", lambda v: v != 0)
    )
    # -0.0 equals 0.0 here
    rows = rows.withColumn("ok", F.coalesce(usable, F.lit(False))).withColumn(
        "vec", F.when(F.col("ok"), F.transform("vec", lambda v: v + F.lit(0.0)))
    )
    rows = rows.select(
        "*", F.xxhash64("vec").alias("v1"), F.xxhash64(F.lit(1), F.col("vec")).alias("v2"), F.size("vec").cast("long").alias("dim")
    )
    rows = stage(rows, "vectors")
    key = ["label", "dim", "v1", "v2"]
    one = rows.filter("ok").groupBy(*key).agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("mult"), F.first("vec").alias("vec")
    )
    most = rows.filter("ok").groupBy("label").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    width = rows.filter("ok").agg(F.coalesce(F.max("dim"), F.lit(1))).first()[0]
    functions, corner = 2, 2 * (1 << max(width - 1, 1).bit_length())
    while functions < max(TABLES) and most > 32 * corner**functions:
        functions += 1
    tables = TABLES[functions]
    schema = "label long, dim long, v1 long, v2 long, rep long, mult long, vec array<double>, codes array<long>"
    one = stage(one.mapInArrow(_codes(functions, tables, probes, seed), schema), "codes")

    places = one.select("rep", "label", "dim", F.posexplode("codes").alias("pos", "bucket")).select(
        "rep",
        (F.col("pos") / probes).cast("int").alias("table"),
        "bucket",
        (F.col("pos") % probes == 0).alias("own"),
        F.xxhash64("label", "dim", (F.col("pos") / probes).cast("int"), "bucket").alias("g"),
    )
    sizes = (
        places.groupBy("g")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("own").cast("int")).alias("owners"))
        .filter("n > 1 and owners > 0")
        .select("g", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    )
    chunk = F.pmod(F.xxhash64(F.lit(7), F.col("rep")), F.col("blocks"))
    met = places.join(sizes, "g").withColumn("chunk", chunk)
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "g", F.least("chunk", "other").alias("ci"), F.greatest("chunk", "other").alias("cj"),
        "chunk", "rep", "table", "bucket", "own",
    )
    full = met.join(one.select("rep", "label", "dim", "mult", "vec", "codes"), "rep")
    found = (
        full.repartition("g", "ci", "cj")
        .sortWithinPartitions("g", "ci", "cj")
        .mapInArrow(_verify(threshold, tables, probes), "rep long, links long, root long")
    )
    found = stage(found, "vector_links")
    sums = found.groupBy("rep").agg(F.sum("links").alias("links"))
    at = classes(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    at = at.select(F.col("id").alias("rep"), "class")
    whole = one.select(*key, "rep", "mult").join(sums, "rep", "left").join(at, "rep", "left")
    whole = whole.select(
        *key,
        (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"),
        F.coalesce("class", "rep").alias("component_id"),
    )
    out = rows.filter("ok").select("id", *key).join(whole, key).select("id", "n_links", "component_id")
    alone = rows.filter("not ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return out.unionByName(alone).select(
        F.col("id").alias(id_col),
        "n_links",
        "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )
