"""Repeated paragraphs by MinHash banding, exact Jaccard and components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.llm.common import bucket_count, bucketed, discard, fresh, map_batches, mix, shingle_hashes, slices, small, stage, words_of
from hitloom.llm.near_links import Items, near_classes
from hitloom.llm.passages import cut_passages

SLICE_BYTES = 500_000

# Bands and rows of a band: a pair of likeness 0.8 shares a band with probability 0.999.
BANDS, ROWS = 10, 3


def different_shingles(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of the different shingles of each text, by text, then hash."""
    shingle, owner = shingle_hashes(texts, size)
    # text numbers of 16 bits are sorted by radix
    order = np.argsort(shingle)
    order = order[np.argsort(owner[order].astype(np.min_scalar_type(len(texts))), kind="stable")]
    shingle, owner = shingle[order], owner[order]
    new = np.ones(len(shingle), dtype=bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (owner[1:] != owner[:-1])
    return shingle[new], owner[new]


def signatures(texts: list[bytes], size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(band keys, number of different shingles) of each text; every text must have words."""
    shingle, owner = different_shingles(texts, size)
    start = np.flatnonzero(np.diff(owner, prepend=-1))
    salts = np.random.default_rng(seed).integers(0, 1 << 62, (BANDS, ROWS), dtype=np.uint64)
    keys = np.empty((len(start), BANDS), dtype=np.uint64)
    for b in range(BANDS):
        key = np.full(len(start), b, dtype=np.uint64)
        for r in range(ROWS):
            # xor before and multiplication after permute the shingles
            h = (shingle ^ salts[b, r]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
            key = mix(key * np.uint64(0xC2B2AE3D27D4EB4F) ^ np.minimum.reduceat(h, start))
        keys[:, b] = key
    return keys.view(np.int64), np.diff(np.append(start, len(shingle)))


def shingle_sets(texts: list[bytes], size: int) -> list[Items]:
    """Sorted different shingles of each text, of weight 1."""
    out = []
    for a, b in slices(np.array([len(t) for t in texts]), SLICE_BYTES):
        shingle, owner = different_shingles(texts[a:b], size)
        cut = np.searchsorted(owner, np.arange(b - a + 1)).tolist()
        out += [(shingle[i:j], np.ones(j - i)) for i, j in zip(cut[:-1], cut[1:], strict=True)]
    return out


def _paragraphs(texts: list[bytes | None], min_words: int) -> list[tuple[list[bytes], list[int]]]:
    """(lines, places of the paragraphs among them) of each text; words are counted for many texts at once."""
    lines = [(text or b"").split(b"\n") for text in texts]
    long = [(i, j) for i, parts in enumerate(lines) for j, p in enumerate(parts) if len(p) >= 2 * min_words - 1]
    good: list[list[int]] = [[] for _ in lines]
    for a, b in slices(np.array([len(lines[i][j]) for i, j in long]), SLICE_BYTES):
        for (i, j), n in zip(long[a:b], words_of([lines[i][j] for i, j in long[a:b]]).tolist(), strict=True):
            if n >= min_words:
                good[i].append(j)
    return list(zip(lines, good, strict=True))


def dedup_paragraphs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.8,
    shingle: int = 5,
    min_words: int = 20,
    seed: int = 23,
) -> DataFrame:
    """Remove paragraphs that repeat others, near copies included, wherever they stand.

    A paragraph is a line (ends at ``\\n``) of at least `min_words` words; shorter lines stay. Paragraphs
    whose sets of runs of `shingle` words have a Jaccard likeness >= `threshold` are linked, equal ones
    too; of each connected component the first paragraph (smallest id, then place) stays in its document
    and all others are removed, also where the component lies within one document.

    Then passages go that repeat earlier ones word for word, inside a line or over lines of any length: runs of
    at least `min_words` words of pieces that stand earlier (see :mod:`hitloom.llm.passages`). The words at the
    ends of a passage, up to where its first piece starts and its last ends, stay.

    All columns stay; the text holds what is left, lines joined by ``\\n`` (null stays null); five follow, with
    underscores where the name is taken: ``n_paragraphs`` (of `min_words` words), ``n_removed`` (paragraphs and
    passages), ``removed`` (places, from 0, of the lines that lost all or a part), ``removed_bytes`` and
    ``kept_in`` (the ids whose paragraphs or pieces stayed for them). Rows that repeat id and text are one document. A null id is one that comes first.
    An empty table gives an empty table. Paragraphs are told apart by 128 bits and named by 64 of them.

    Equal paragraphs are one row with a count from the first shuffle on. See
    :mod:`hitloom.llm.near_links` for buckets of many.
    """
    key, cut, kept_in, dx = fresh(docs, "text_key", "cut_places", "cut_heads", "cut_x")
    doc = F.col(f"`{id_col}`").cast("long")
    # texts are moved once, to buckets; what is found of a text is joined to it there
    buckets_of_texts = bucket_count(docs, text_col)
    stored = docs.withColumn(key, F.xxhash64(doc, F.col(f"`{text_col}`")))
    stored = bucketed(stored, key, buckets_of_texts, "texts")
    rows = stored.select(doc.alias("doc"), F.col(key).alias("x"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        owner, place, found = [], [], []
        texts = batch.column(2).cast(pa.binary()).to_pylist()
        for i, (parts, good) in enumerate(_paragraphs(texts, min_words)):
            owner += [i] * len(good)
            place += good
            found += [parts[g] for g in good]
        digest = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, found)), dtype="<i8").reshape(-1, 2)
        keys, size = np.zeros((0, BANDS), dtype=np.int64), np.zeros(0, dtype=np.int64)
        done = [signatures(found[a:b], shingle, seed) for a, b in slices(np.array([len(p) for p in found]), SLICE_BYTES)]
        if done:
            keys, size = (np.concatenate(c) for c in zip(*done, strict=True))
        at = pa.array(owner, pa.int64())
        offsets = np.arange(len(found) + 1, dtype=np.int32) * BANDS
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(at), batch.column(1).take(at), pa.array(place, pa.int64()),
             pa.array(digest[:, 0]), pa.array(digest[:, 1]), pa.array(size.astype(float)),
             pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel()))],
            names=["doc", "x", "place", "p1", "p2", "size", "bands"],
        )

    found = map_batches(rows, run, "doc long, x long, place long, p1 long, p2 long, size double, bands array<long>")
    found = stage(found, "paragraphs")
    where = F.struct("doc", "place", "x")
    distinct = found.groupBy("p1", "p2").agg(
        F.count(F.lit(1)).alias("n"), F.min(where).alias("first"), F.first("size").alias("size"), F.first("bands").alias("bands")
    )
    distinct = stage(distinct, "distinct_paragraphs")
    buckets = distinct.select(F.explode("bands").alias("bucket"), F.col("p1").alias("id"), "size")

    def fetch(ids: DataFrame) -> DataFrame:
        """Texts of paragraphs, each from its first document."""
        wanted = ids.join(distinct.select(F.col("p1").alias("id"), "first"), "id")
        wanted = wanted.groupBy(F.col("first.x").alias("dx")).agg(
            F.collect_list(F.struct("id", F.col("first.place").alias("place"), F.col("first.doc").alias("doc"))).alias("asked")
        )
        wanted = stage(wanted, "wanted_paragraphs")
        held = rows.join(small(wanted), rows["x"] == wanted["dx"])
        # texts of one key are told apart by their ids
        asked = F.filter("asked", lambda a: a["doc"].eqNullSafe(F.col("doc")))
        parts = F.split("text", "\n")
        one = held.select(F.explode(F.transform(asked, lambda a: F.struct(a["id"].alias("id"), F.get(parts, a["place"].cast("int")).alias("text")))).alias("p"))
        return one.select("p.id", "p.text").dropDuplicates(["id"])

    at, _ = near_classes(buckets, fetch, lambda texts: shingle_sets(texts, shingle), threshold)
    classed = distinct.select("p1", "p2", "n", "first").join(at.withColumnRenamed("id", "p1"), "p1", "left")
    classed = classed.withColumn("class", F.coalesce("class", "p1"))
    heads = classed.groupBy("class").agg(F.sum("n").alias("total"), F.min("first").alias("head")).filter("total > 1")
    repeated = stage(classed.select("p1", "p2", "class").join(heads, "class").select("p1", "p2", "head"), "repeated_paragraphs")
    gone = found.select("doc", "x", "place", "p1", "p2").join(repeated, ["p1", "p2"])
    gone = gone.filter(~F.struct("doc", "place", "x").eqNullSafe(F.col("head")))
    gone = gone.groupBy(F.col("x").alias(dx)).agg(
        F.collect_set(F.struct("doc", "place")).alias(cut), F.collect_set(F.struct("doc", F.col("head.doc").alias("head"))).alias(kept_in)
    )

    def own(lists: str, field: str) -> F.Column:
        """Of the entries of a key those of the row's id."""
        mine = F.filter(lists, lambda e: e["doc"].eqNullSafe(doc))
        return F.array_sort(F.array_distinct(F.transform(mine, lambda e: e[field])))

    joined = stored.join(small(gone), stored[key] == gone[dx], "left").drop(dx)
    joined = joined.withColumns({cut: own(cut, "place"), kept_in: own(kept_in, "head")})
    names = stored.columns
    more = fresh(docs, "n_paragraphs", "n_removed", "removed", "removed_bytes", "kept_in")

    def remove(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = batch.schema.get_field_index(text_col)
        texts, cuts = batch.column(at).cast(pa.binary()).to_pylist(), batch.column(cut).to_pylist()
        kept, total, bytes_gone = [], [], []
        for text, places, (parts, good) in zip(texts, cuts, _paragraphs(texts, min_words), strict=True):
            bad = set(places or ())
            left = [p for i, p in enumerate(parts) if i not in bad]
            kept.append(b"\n".join(left) if text is not None else None)
            total.append(len(good))
            bytes_gone.append(sum(len(parts[i]) for i in bad))
        columns = [batch.column(c) for c in names]
        columns[names.index(text_col)] = pa.array(kept, pa.binary()).cast(pa.string())
        lists = [[c or [] for c in batch.column(k).to_pylist()] for k in (cut, kept_in)]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(total, pa.int64()), pa.array([len(c) for c in lists[0]], pa.int64()),
             pa.array(lists[0], pa.list_(pa.int64())), pa.array(bytes_gone, pa.int64()),
             pa.array(lists[1], pa.list_(pa.int64()))],
            names=[*names, *more],
        )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored.schema)
    kinds = ["long", "long", "array<long>", "long", "array<long>"]
    left = map_batches(joined, remove, f"{fields}, " + ", ".join(f"`{n}` {k}" for n, k in zip(more, kinds, strict=True)), text_col)
    left = bucketed(left, key, buckets_of_texts, "paragraphs_left", dealt=True)
    discard(found, distinct, repeated, stored)
    return cut_passages(left, id_col, text_col, key, more[1:], min_words).drop(key)
