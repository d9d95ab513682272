"""Document fingerprints by locally consistent parsing with deterministic coin tossing."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitloom.llm.common import mix, prefix_hash, range_hash, slices, stage

# Levels of phrases; a phrase of the last has some 30 code points.
LEVELS = 3
# Values of a fingerprint, a byte each.
VALUES = 64
SLICE_CHARS = 500_000

_LOW_BIT = np.array([8] + [(i & -i).bit_length() - 1 for i in range(1, 256)], dtype=np.uint8)
_NONE = np.uint8(255)


def _three_colours(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A label of 0, 1 or 2 for each name, different from its neighbours' in the same text.

    Coin tossing: the label is twice the place of the lowest bit in which the name differs from the one
    before, plus that bit. Four rounds leave six labels; then 3, 4 and 5 take the smallest label that no
    neighbour has. A label depends on a handful of names around it and on nothing else.
    """
    x = names ^ np.concatenate([names[:1], names[:-1]])
    x[first] = 1
    place = (np.frexp((x & (~x + np.uint64(1))).astype(np.float64))[1] - 1).astype(np.uint8)
    label = (2 * place + ((names >> place.astype(np.uint64)) & np.uint64(1)).astype(np.uint8)).astype(np.uint8)
    for _ in range(3):
        y = label ^ np.concatenate([label[:1], label[:-1]])
        y[first] = 1
        place = _LOW_BIT[y]
        label = 2 * place + ((label >> place) & np.uint8(1))
    last = np.append(first[1:], True)
    for colour in (3, 4, 5):
        at = np.flatnonzero(label == colour)
        left = np.where(first[at], _NONE, label[at - 1])
        right = np.where(last[at], _NONE, label[np.minimum(at + 1, len(label) - 1)])
        free = np.full(len(at), 2, dtype=np.uint8)
        for c in (1, 0):
            free[(left != c) & (right != c)] = c
        label[at] = free
    return label


def phrases(names: np.ndarray, first: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of the next level's phrases and which of them begin a text.

    Runs of one name become one; then phrases begin where a label is larger than both its neighbours,
    so they have two to four names.
    """
    new = np.append(True, names[1:] != names[:-1]) | first
    at = np.flatnonzero(new)
    length = np.diff(np.append(at, len(names)))
    run = length > 1
    names, first = names[at].copy(), first[at]
    names[run] = mix(names[run] * np.uint64(0x9E3779B97F4A7C15) + length[run].astype(np.uint64))
    label = _three_colours(names, first).astype(np.int8)
    left = np.concatenate([label[:1], label[:-1]])
    left[first] = -1
    right = np.append(label[1:], np.int8(-1))
    right[np.append(first[1:], True)] = -1
    start = np.flatnonzero(((label > left) & (label > right)) | first)
    end = np.append(start[1:], len(names))
    return mix(range_hash(prefix_hash(names), start, end) + np.uint64(level)), first[start]


def parse(texts: list[str], levels: int = LEVELS) -> tuple[np.ndarray, np.ndarray]:
    """(name, text number) of the phrases of level `levels`; an empty text has none."""
    size = np.array([len(t) for t in texts])
    names = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    names = mix(names + np.uint64(1))
    full = np.flatnonzero(size)
    first = np.zeros(len(names), dtype=bool)
    first[(np.cumsum(size) - size)[full]] = True
    if len(names):
        for level in range(levels):
            names, first = phrases(names, first, level + 1)
    return names, full[np.cumsum(first) - 1]


def fingerprints(texts: list[str]) -> np.ndarray:
    """(texts, VALUES) bytes: of each of VALUES orders of the text's phrases a byte of the smallest name."""
    out = np.zeros((len(texts), VALUES), dtype=np.uint8)
    salts = np.random.default_rng(29).integers(0, 1 << 62, VALUES, dtype=np.uint64)
    for a, b in slices(np.array([len(t) for t in texts]), SLICE_CHARS):
        names, owner = parse(texts[a:b])
        if not len(names):
            continue
        start = np.flatnonzero(np.diff(owner, prepend=-1))
        for k in range(VALUES):
            h = (names ^ salts[k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
            least = np.minimum.reduceat(h, start) * np.uint64(0xC2B2AE3D27D4EB4F)
            out[a + owner[start], k] = least >> np.uint64(56)
    return out


def likeness(x: np.ndarray, y: np.ndarray, n_x: int, n_y: int) -> float:
    """Share of equal values less what chance gives; texts without characters are like each other only."""
    if n_x == 0 or n_y == 0:
        return float(n_x == n_y)
    chance = 1 / 256
    return max(0.0, (float((x == y).mean()) - chance) / (1 - chance))


def _hex(value: np.ndarray, n: int) -> str:
    return value.tobytes().hex() if n else ""


def edit(text: str, following: str) -> str:
    """`text` with its last half replaced by as many code points from the start of `following`."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_FIELDS = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _rows(texts: list[str], following: list[str], own: np.ndarray, after: np.ndarray) -> list[pa.Array]:
    edited = [edit(t, f) for t, f in zip(texts, following, strict=True)]
    changed = fingerprints(edited)
    n = [len(t) for t in texts]
    return [
        pa.array(n, pa.int64()),
        pa.array([hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited]),
        pa.array([_hex(f, m) for f, m in zip(own, n, strict=True)], pa.string()),
        pa.array([_hex(f, len(e)) for f, e in zip(changed, edited, strict=True)], pa.string()),
        pa.array([likeness(f, g, m, len(e)) for f, g, m, e in zip(own, changed, n, edited, strict=True)], pa.float64()),
        pa.array([likeness(f, g, m, len(e)) for f, g, m, e in zip(own, after, n, following, strict=True)], pa.float64()),
    ]


def fingerprint_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each whole text and of the text edited with the next document's.

    Documents are ordered by id (null first), rows of one id by text; the next of the last is the first,
    so a single document follows itself. Null texts count as empty; an empty text has the empty fingerprint. Equal
    texts have equal fingerprints wherever they stand, and equal substrings share the phrases that lie more than a few phrases
    inside. Columns: the id, then n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next; others are left out. An empty table gives an empty table. Memory of a task grows with the
    longest text, by some 150 bytes for each of its code points.

    Texts are shuffled once, to ranges of the id. Each range hands its last document and the text of its
    first to a small second step, which joins neighbouring ranges.
    """
    spark = docs.sparkSession
    ids = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = [f.split()[0] for f in _FIELDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held, opened = None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = batch.column(1).to_pylist()
            prints = fingerprints(texts)
            doc = batch.column(0)
            head = None if opened else texts[0]
            if held is not None:
                doc = pa.concat_arrays([held[0], doc])
                texts, prints = [held[1], *texts], np.vstack([held[2], prints])
            # the last row waits for its next
            n = len(texts) - 1
            held = (doc[n:], texts[n], prints[n:])
            made = _rows(texts[:n], texts[1:], prints[:n], prints[1:])
            if not opened:
                yield ends(doc[:1], part, head, None)
                opened = True
            if n:
                nothing = pa.nulls(n, pa.string())
                yield pa.RecordBatch.from_arrays(
                    [doc[:n], *made, pa.array([part] * n, pa.int64()), nothing, nothing], names=["doc", *names, "part", "head", "tail"]
                )
        if opened:
            yield ends(held[0], part, None, held[1])

    def ends(doc: pa.Array, part: int, head: str | None, tail: str | None) -> pa.RecordBatch:
        blank = [pa.nulls(1, t) for t in (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())]
        return pa.RecordBatch.from_arrays(
            [doc, *blank, pa.array([part], pa.int64()), pa.array([head], pa.string()), pa.array([tail], pa.string())],
            names=["doc", *names, "part", "head", "tail"],
        )

    done = (
        rows.repartitionByRange(parts, "doc")
        .sortWithinPartitions("doc", "text")
        .mapInArrow(run, f"doc {ids}, {_FIELDS}, part long, head string, tail string")
    )
    done = stage(done, "fingerprints")
    inner = done.filter("head is null and tail is null").select("doc", *names)
    # one row for each range: the range that follows, or the first
    order = Window.orderBy("part")
    heads = done.filter("head is not null").select("part", "head")
    after = done.filter("head is not null").select("part").withColumn("after", F.lead("part").over(order))
    after = after.withColumn("after", F.coalesce("after", F.min("part").over(order)))
    tails = done.filter("tail is not null").select("doc", "part", "tail").join(after, "part")
    joined = tails.join(heads.withColumnRenamed("part", "after"), "after").select("doc", "tail", "head")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own, following = batch.column(1).to_pylist(), batch.column(2).to_pylist()
                made = _rows(own, following, fingerprints(own), fingerprints(following))
                yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=["doc", *names])

    last = joined.mapInArrow(close, f"doc {ids}, {_FIELDS}")
    return inner.unionByName(last).select(F.col("doc").alias(id_col), *names)
