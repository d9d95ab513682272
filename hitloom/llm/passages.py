"""Repeated passages inside lines and over lines, by pieces cut at places that depend on the words alone."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.llm.common import _WORD_TABLE, discard, fresh, map_batches, mix, prefix_hash, range_hash, release, slices, small, stage, text_bytes, word_edges

SLICE_BYTES = 500_000

# A piece starts at a word pair whose hash is the least among so many before and after it.
REACH = 2


def pieces(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text number, place in the text, first byte, end byte, words, hash, second hash) of each piece.

    Pieces are runs of words, white space and case aside, that cover a text. Where one starts depends on
    the `REACH` words before it and the `REACH` + 1 after it, so equal passages have equal pieces inside,
    whatever stands around them. The first piece of a text starts with the text.
    """
    data, start, end, first = word_edges(texts)
    words = range_hash(prefix_hash(_WORD_TABLE.take(data)), start, end)
    owner = np.searchsorted(first, start, "right") - 1
    n = len(words)
    pair = words.copy()
    same = owner[1:] == owner[:-1]
    pair[:-1][same] += words[1:][same] * np.uint64(0x9E3779B97F4A7C15)
    pair = mix(pair)
    cut = np.ones(n, dtype=bool)
    for d in range(1, min(REACH, max(n - 1, 0)) + 1):
        near = owner[d:] == owner[:-d]
        # of equal pairs only the first can start a piece
        cut[d:] &= ~near | (pair[d:] < pair[:-d])
        cut[:-d] &= ~near | (pair[:-d] <= pair[d:])
    cut |= np.diff(owner, prepend=-1) != 0
    at = np.flatnonzero(cut)
    stop = np.append(at, n)[1:]
    text = owner[at]
    place = np.arange(len(at)) - np.searchsorted(text, text, "left")
    one, two = (range_hash(prefix_hash(w), at, stop).view(np.int64) for w in (words, mix(words ^ np.uint64(0x5BD1E995))))
    return text, place, start[at] - first[text], end[stop - 1] - first[text], stop - at, one, two


def _runs(words: np.ndarray, bad: np.ndarray, min_words: int) -> list[tuple[int, int]]:
    """(first piece, end piece) of runs of repeated pieces with at least `min_words` words together."""
    edge = np.flatnonzero(np.diff(bad.astype(np.int8), prepend=0, append=0))
    return [(a, b) for a, b in zip(edge[0::2].tolist(), edge[1::2].tolist(), strict=True) if words[a:b].sum() >= min_words]


def longest_run(listed: Column) -> Column:
    """Words of the longest run of consecutive pieces in a list of struct(doc, place, words, ...)."""
    none = F.struct(F.lit(None).cast("long"), F.lit(-2).cast("long"), F.lit(0).cast("long"), F.lit(0).cast("long"))

    def step(s: Column, e: Column) -> Column:
        follows = e["doc"].eqNullSafe(s["col1"]) & (e["place"] == s["col2"] + 1)
        run = F.when(follows, s["col3"]).otherwise(F.lit(0)) + e["words"]
        return F.struct(e["doc"], e["place"], run, F.greatest(s["col4"], run))

    return F.aggregate(F.array_sort(listed), none, step)["col4"]


def _cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """`text` without the spans, the blanks after each, and the line end where nothing else is in its lines."""
    out, last = [], 0
    for a, b in spans:
        while b < len(text) and text[b] in b" \t":
            b += 1
        if a == 0 or text[a - 1] == 10:
            if b < len(text) and text[b] == 10:
                b += 1
            elif b == len(text) and a > last:
                a -= 1
        out.append(text[last:a])
        last = b
    return b"".join([*out, text[last:]])


def cut_passages(docs: DataFrame, id_col: str, text_col: str, key: str, more: list[str], min_words: int) -> DataFrame:
    """`docs` without the runs of at least `min_words` words that are made of pieces which stand earlier,
    in the order of id and place; the first occurrence of each piece stays.

    `docs` lies in buckets of `key`, a hash of id and text; `more` names the columns for the number of removed parts, the places of their lines, their bytes and the
    ids that keep them, which are added to. Pieces are told apart by 128 bits.
    """
    own_id = F.col(f"`{id_col}`").cast("long")
    rows = docs.select(own_id.alias("doc"), F.col(key).alias("x"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def cut_up(texts: list[bytes]) -> list[np.ndarray]:
        done = []
        for a, b in slices(np.array([len(t) for t in texts]), SLICE_BYTES):
            text, *others = pieces(texts[a:b])
            done.append([text + a, *others])
        return [np.concatenate(c) for c in zip(*done, strict=True)]

    def hashes(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(cut_up(text_bytes(batch.column(0)))[5], pa.int64())], names=["h"])

    def places(batch: pa.RecordBatch) -> pa.RecordBatch:
        text, place, _, _, words, one, two = cut_up(text_bytes(batch.column(2)))
        at = pa.array(text, pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(at), batch.column(1).take(at), pa.array(place, pa.int64()), pa.array(words, pa.int64()),
             pa.array(one), pa.array(two)],
            names=["doc", "x", "place", "words", "h", "h2"],
        )

    # counts alone first: a hash is all that is shuffled for the many pieces that stand once
    counted = map_batches(rows.select("text"), hashes, "h long").groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    several = stage(counted.filter("n > 1").select("h"), "repeated_pieces")
    release(several)
    found = map_batches(rows, places, "doc long, x long, place long, words long, h long, h2 long")
    found = stage(found.join(small(several), "h"), "pieces")
    discard(several)
    where = F.struct("doc", "place", "x")
    heads = found.groupBy("h", "h2").agg(F.min(where).alias("head"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    heads = stage(heads.drop("n"), "first_pieces")
    gone = found.join(small(heads), ["h", "h2"]).filter(~where.eqNullSafe(F.col("head")))
    dx, cut = fresh(docs, "passage_x", "passage_cut")
    gone = gone.groupBy(F.col("x").alias(dx)).agg(
        F.collect_set(F.struct("doc", "place", "words", F.col("head.doc").alias("head"))).alias(cut)
    )
    # most lists have no run that is long enough: their texts stay as they are
    gone = gone.filter(longest_run(F.col(cut)) >= min_words)
    joined = docs.join(small(gone), docs[key] == gone[dx], "left").drop(dx)
    # texts of one key are told apart by their ids
    joined = joined.withColumn(cut, F.filter(cut, lambda e: e["doc"].eqNullSafe(own_id)))
    names = docs.columns

    def remove(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = dict(zip(batch.schema.names, batch.columns, strict=True))
        texts, cuts = columns[text_col].cast(pa.binary()).to_pylist(), columns[cut].to_pylist()
        listed = [i for i, asked in enumerate(cuts) if asked]
        if not listed:
            return batch.select(names)
        n, lines, size, ids = (columns[k].to_pylist() for k in more)
        owner, _, starts, ends, counts, _, _ = cut_up([texts[i] for i in listed])
        edge = np.searchsorted(owner, np.arange(len(listed) + 1)).tolist()
        for i, first, last in zip(listed, edge[:-1], edge[1:], strict=True):
            text, asked = texts[i], cuts[i]
            start, end, words = (c[first:last] for c in (starts, ends, counts))
            bad = np.zeros(len(start), dtype=bool)
            bad[[p["place"] for p in asked]] = True
            runs = _runs(words, bad, min_words)
            if not runs:
                continue
            inside = np.zeros(len(start), dtype=bool)
            for a, b in runs:
                inside[a:b] = True
            spans = [(int(start[a]), int(end[b - 1])) for a, b in runs]
            # places of lines in the text before whole lines went from it
            before, touched = set(lines[i]), set()
            left = [k for k in range(text.count(b"\n") + 1 + len(before)) if k not in before]
            for a, b in spans:
                low = text.count(b"\n", 0, a)
                touched |= {left[k] for k in range(low, low + text.count(b"\n", a, b) + 1)}
            texts[i] = _cut(text, spans)
            n[i] += len(spans)
            size[i] += sum(b - a for a, b in spans)
            lines[i] = sorted(before | touched)
            kept = set(ids[i]) | {p["head"] for p in asked if inside[p["place"]]}
            ids[i] = sorted(kept, key=lambda k: (k is not None, k or 0))
        columns[text_col] = pa.array(texts, pa.binary()).cast(pa.string())
        longs = pa.list_(pa.int64())
        for k, v, kind in zip(more, (n, lines, size, ids), (pa.int64(), longs, pa.int64(), longs), strict=True):
            columns[k] = pa.array(v, kind)
        return pa.RecordBatch.from_arrays([columns[k] for k in names], names=names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_batches(joined, remove, fields, text_col)
