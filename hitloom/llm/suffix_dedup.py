"""Removal of long substrings that repeat anywhere, by suffix orders of phrase runs and exact windows."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitloom.llm.common import (
    INVERSE, bucket_count, bucketed, byte_table, discard, fresh, mix, parts, powers, prefix_hash, range_hash, slices, small,
    stage,
)
from hitloom.llm.suffix_groups import suffix_order

# Bytes whose hash places an anchor.
GRAM = 16
# Bytes of text that are scanned at once: their arrays stay in a core's cache.
SLICE_BYTES = 150_000
# Phrases of the runs that one task orders, on average.
RANGE_PHRASES = 500_000

_BYTES = byte_table(fold_case=False, seed=3)


def sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    """Least key of every `width` consecutive ones."""
    have = 1
    while 2 * have <= width:
        keys = np.minimum(keys[:-have], keys[have:])
        have *= 2
    rest = width - have
    return np.minimum(keys[:-rest], keys[rest:]) if rest else keys


class Scan:
    """Anchors, phrases and windows of a few texts of at least `size` bytes, as flat arrays.

    Every run of `reach` grams selects its least (the last of equals) as an anchor, and a window of `size`
    bytes holds two runs of grams side by side. What its first run selects, what its last run selects
    and all anchors between depend on the window alone, so equal windows have equal cores: the phrases from
    one anchor to the other. A phrase goes from an anchor to the end of the next one's gram. What a step
    does not ask for is not computed.
    """

    def __init__(self, texts: list[bytes], size: int):
        self.size, self.reach = size, (size - GRAM + 1) // 2
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        lengths = np.array([len(t) for t in texts])
        self.first = np.cumsum(lengths) - lengths
        self.prefix = prefix_hash(_BYTES[data])
        # the upper half of a gram's hash, and below it how far from the end it stands
        key = self.prefix[GRAM:] - self.prefix[:-GRAM]
        key *= powers(len(data) + 1, INVERSE)[: len(key)]
        key = mix(key)
        key &= np.uint64(0xFFFFFFFF00000000)
        key |= np.arange(0xFFFFFFFF, 0xFFFFFFFF - len(key), -1, dtype=np.uint64)
        self._least = least = sliding_min(key, self.reach)
        self._moves = moves = np.append(True, least[1:] != least[:-1])
        moves[self.first[1:]] = True
        self._ends = self.first + lengths
        self._ahead = size - GRAM + 1 - self.reach

    def _placed(self, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of these places of something `width` bytes wide those inside a text, their texts and the last
        place in each."""
        doc = np.searchsorted(self.first, at, "right") - 1
        last = self._ends[doc] - width
        inside = at <= last
        return at[inside], doc[inside], last[inside]

    def _anchor_of(self, run: np.ndarray) -> np.ndarray:
        return (np.uint64(0xFFFFFFFF) - (self._least[run] & np.uint64(0xFFFFFFFF))).astype(np.int64)

    @cached_property
    def _anchors(self) -> tuple[np.ndarray, np.ndarray]:
        run, doc, _ = self._placed(np.flatnonzero(self._moves), GRAM - 1 + self.reach)
        return self._anchor_of(run), doc

    @property
    def anchor(self) -> np.ndarray:
        return self._anchors[0]

    @property
    def anchor_doc(self) -> np.ndarray:
        return self._anchors[1]

    @cached_property
    def phrase(self) -> np.ndarray:
        """Hash of each anchor's phrase; the phrase of an anchor that is its text's last is none and has hash 0."""
        anchor, doc = self._anchors
        phrase = np.zeros(len(anchor), dtype=np.uint64)
        j = np.flatnonzero(doc[1:] == doc[:-1])
        phrase[j] = range_hash(self.prefix, anchor[j], anchor[j + 1] + GRAM)
        return phrase

    @cached_property
    def _cores(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = len(self.prefix) - 1
        starts = np.flatnonzero(self._moves[: n - self.size + 1] | self._moves[self._ahead : self._ahead + n - self.size + 1])
        low, doc, end = self._placed(starts, self.size)
        return low, doc, np.minimum(np.append(low[1:], n) - 1, end)

    @property
    def low(self) -> np.ndarray:
        """First window of each core."""
        return self._cores[0]

    @property
    def doc(self) -> np.ndarray:
        """Text of each core."""
        return self._cores[1]

    @property
    def high(self) -> np.ndarray:
        """Last window of each core."""
        return self._cores[2]

    @cached_property
    def _core_anchors(self) -> tuple[np.ndarray, np.ndarray]:
        return self._anchor_of(self.low), self._anchor_of(self.low + self._ahead)

    @cached_property
    def from_anchor(self) -> np.ndarray:
        return np.searchsorted(self.anchor, self._core_anchors[0])

    @cached_property
    def n_phrases(self) -> np.ndarray:
        return np.searchsorted(self.anchor, self._core_anchors[1]) - self.from_anchor

    @cached_property
    def core(self) -> np.ndarray:
        first, last = self._core_anchors
        return range_hash(self.prefix, first, last + GRAM)

    @cached_property
    def block(self) -> np.ndarray:
        """Hash of all bytes of a core's windows; equal blocks have equal windows."""
        return range_hash(self.prefix, self.low, self.high + self.size)

    def runs(self, repeated: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each anchor the number of phrases that follow it, all repeated, within `size` bytes, and
        the hash of these phrases."""
        n = len(self.anchor)
        stop = np.where(repeated, n, np.arange(n))
        stop = np.minimum.accumulate(stop[::-1])[::-1]  # the first phrase from here on that is not repeated
        end = np.searchsorted(self.anchor, self.anchor + self.size - GRAM, "right") - 1
        count = np.maximum(np.minimum(stop, end) - np.arange(n), 0)
        return count, range_hash(prefix_hash(self.phrase), np.arange(n), np.arange(n) + count)

    def windows(self, cores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, core) of every window of the given cores."""
        n = self.high[cores] - self.low[cores] + 1
        core = np.repeat(cores, n)
        return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + self.low[core], core

    def window_hash(self, start: np.ndarray) -> np.ndarray:
        return range_hash(self.prefix, start, start + self.size)


def _scans(column: pa.Array, size: int) -> Iterator[tuple[np.ndarray, Scan]]:
    """(rows, scan) for the texts of a batch that are long enough, a bounded number of bytes at a time."""
    texts = column.cast(pa.binary()).to_pylist()
    rows = np.array([i for i, t in enumerate(texts) if t is not None and len(t) >= size], dtype=np.int64)
    for a, b in slices(np.array([len(texts[i]) for i in rows]), SLICE_BYTES):
        yield rows[a:b], Scan([texts[i] for i in rows[a:b]], size)


def _i64(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def _members(values: np.ndarray, wanted: pa.Array) -> np.ndarray:
    """Whether each 64-bit word is one of `wanted`."""
    keys = np.sort(np.asarray(wanted).view(np.uint64))
    if not len(keys):
        return np.zeros(len(values), dtype=bool)
    return keys[np.minimum(np.searchsorted(keys, values), len(keys) - 1)] == values


def _find_phrases(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in parts(whole, "text"):
                for rows, s in _scans(batch.column(1), size):
                    cut = np.searchsorted(s.anchor_doc, np.arange(len(rows) + 1)).astype(np.int32)
                    at = s.anchor - s.first[s.anchor_doc]
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(rows)),
                            pa.ListArray.from_arrays(pa.array(cut), pa.array(at.astype(np.int32))),
                            pa.ListArray.from_arrays(pa.array(cut), _i64(s.phrase)),
                        ],
                        names=["doc", "at", "phrases"],
                    )

    return run


def _find_runs(size: int):
    """(doc, run): for each repeated phrase the repeated phrases from it on within a window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, phrase = (np.asarray(batch.column(i).flatten()) for i in (1, 2))
            cut = np.append(0, np.cumsum(np.asarray(batch.column(1).value_lengths()))).astype(np.int64)
            doc = np.repeat(np.arange(batch.num_rows), np.diff(cut))
            n = len(at)
            repeated = phrase != 0
            for i in range(batch.num_rows):
                part = slice(cut[i], cut[i + 1])
                repeated[part] &= _members(phrase[part].view(np.uint64), batch.column(3)[i].values)
            # a text's last phrase is none, so no run leaves its text
            stop = np.minimum.accumulate(np.where(repeated, n, np.arange(n))[::-1])[::-1]
            step = np.int64(1) << 32  # beyond any place in a text
            end = np.searchsorted(at + doc * step, at + doc * step + size - GRAM, "right") - 1
            count = np.maximum(np.minimum(stop, end) - np.arange(n), 0)
            own = np.flatnonzero(count)
            count = count[own]
            offsets = np.append(0, np.cumsum(count))
            flat = phrase[np.arange(offsets[-1]) - np.repeat(offsets[:-1] - own, count)]
            runs = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc[own])), runs], names=["doc", "run"])

    return run


def _order_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the different runs of one range: how many phrases each shares with another, from the suffix order
    of all of them. Runs that stand more than once share all. The ends of the range are marked."""
    part = TaskContext.get().partitionId()
    kept = [b for b in batches if b.num_rows]
    if not kept:
        return
    table = pa.Table.from_batches(kept)
    runs, n = table.column("run").combine_chunks(), np.asarray(table.column("n"))
    size = np.asarray(runs.value_lengths(), dtype=np.int64)
    # symbols in the order of the values, so that ranges and suffixes are ordered alike
    symbol = np.unique(np.asarray(runs.flatten()), return_inverse=True)[1] + 1
    start = np.cumsum(size + 1) - size
    text = np.zeros(size.sum() + len(size) + 1, dtype=np.int64)
    text[np.arange(len(symbol)) + np.repeat(np.arange(len(size)) + 1, size)] = symbol
    run_at = np.full(len(text), -1)
    run_at[start] = np.arange(len(size))
    order = run_at[suffix_order(text.tolist())]
    order = order[order >= 0]
    # phrases that neighbours share
    a, b = start[order[:-1]], start[order[1:]]
    common, at = np.zeros(len(a), dtype=np.int64), np.arange(len(a))
    while len(at):
        at = at[(text[a[at]] == text[b[at]]) & (text[a[at]] > 0)]
        common[at] += 1
        a[at] += 1
        b[at] += 1
    shared = np.zeros(len(size), dtype=np.int64)
    shared[order[:-1]] = common
    shared[order[1:]] = np.maximum(shared[order[1:]], common)
    ends = {int(order[0]): 0, int(order[-1]): 1} if len(order) > 1 else {int(order[0]): 2}
    # a run that is not marked and shares all, or stands more than once, is as the reader assumes
    wanted = (n == 1) & (shared < size)
    wanted[list(ends)] = True
    out = np.flatnonzero(wanted)
    yield pa.RecordBatch.from_arrays(
        [
            table.column("doc").combine_chunks().take(pa.array(out)),
            runs.take(pa.array(out)),
            pa.array(n[out]),
            pa.array(shared[out]),
            pa.array([part] * len(out), pa.int64()),
            pa.array([ends.get(k) for k in out.tolist()], pa.int64()),
        ],
        names=["doc", "run", "n", "shared", "part", "end"],
    )


def run_key(run: np.ndarray) -> int:
    """The hash that :meth:`Scan.runs` gives for a run."""
    words = np.asarray(run, dtype=np.int64).view(np.uint64)
    return int(range_hash(prefix_hash(words), np.array([0]), np.array([len(words)])).view(np.int64)[0])


def _key_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [run_key(r) for r in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(keys, pa.int64()), batch.column(2)], names=["doc", "run", "shared"]
        )


def _close_ranges(ordered: DataFrame) -> DataFrame:
    """Runs at the ends of ranges compared with the neighbouring range's end; two rows for each range."""
    ends = ordered.filter("end is not null").select("part", "end", "run", "doc", "n", "shared")
    order = Window.orderBy("part", "end")
    near = ends.select(
        "*", F.lag("run").over(order).alias("before"), F.lag("part").over(order).alias("part_before"),
        F.lead("run").over(order).alias("after"), F.lead("part").over(order).alias("part_after"),
    )

    def common(other: str, part: str) -> F.Column:
        pairs = F.zip_with("run", other, lambda a, b: a.eqNullSafe(b))
        differ = F.array_position(pairs, False)
        n = F.when(differ == 0, F.size("run")).otherwise(differ - 1)
        return F.when(F.col(other).isNotNull() & (F.col(part) != F.col("part")), F.least(n, F.size("run"))).otherwise(0)

    best = F.greatest("shared", common("before", "part_before"), common("after", "part_after"))
    return near.select("doc", "run", "n", best.alias("shared"))


def find_repeats(rows: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """(doc, phrases) of the phrases that repeat, and (doc, exceptions) of the runs of these that share fewer
    phrases with another place than they have: (run, shared)."""
    kind = rows.schema["doc"].dataType.simpleString()
    found = stage(rows.mapInArrow(_find_phrases(size), f"doc {kind}, at array<int>, phrases array<long>"), "phrases")
    each = found.select("doc", F.explode("phrases").alias("phrase")).filter("phrase != 0")
    repeated = stage(each.groupBy("phrase").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("phrase"), "repeated")
    mine = each.join(small(repeated), "phrase").groupBy("doc").agg(F.collect_set("phrase").alias("repeated"))
    mine = stage(mine, "repeated_phrases")
    held = mine.withColumnRenamed("doc", "d")
    joined = found.join(held, found["doc"] == held["d"]).select("doc", "at", "phrases", "repeated")
    runs = joined.mapInArrow(_find_runs(size), f"doc {kind}, run array<long>")
    runs = runs.groupBy("run").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("doc"))
    runs = stage(runs, "runs")
    discard(found, repeated)
    total = runs.agg(F.coalesce(F.sum(F.size("run")), F.lit(0))).first()[0]
    ranges = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // RANGE_PHRASES))
    ordered = runs.repartitionByRange(ranges, "run").mapInArrow(
        _order_runs, f"doc {kind}, run array<long>, n long, shared long, part long, end long"
    )
    ordered = stage(ordered, "ordered_runs")
    discard(runs)
    less = ordered.filter("end is null").select("doc", "run", "n", "shared").unionByName(_close_ranges(ordered))
    less = less.filter("n = 1 and shared < size(run)").select("doc", "run", "shared")
    less = less.mapInArrow(_key_runs, f"doc {kind}, run long, shared long")
    less = less.groupBy("doc").agg(F.collect_list(F.struct("run", "shared")).alias("less"))
    return mine, stage(less, "shorter_runs")


def _find_blocks(size: int):
    """(doc, core, block) for each core of a document that stands somewhere else too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in parts(whole, "text"):
                repeated, less = batch.column(2), batch.column(3)
                for rows, s in _scans(batch.column(1), size):
                    flag = np.zeros(len(s.anchor), dtype=bool)
                    cut = np.searchsorted(s.anchor_doc, np.arange(len(rows) + 1))
                    for k, row in enumerate(rows.tolist()):
                        part = slice(cut[k], cut[k + 1])
                        flag[part] = _members(s.phrase[part], repeated[row].values)
                    shared, keys = s.runs(flag & (s.phrase != 0))
                    for k, row in enumerate(rows.tolist()):
                        if less[row].is_valid:
                            known = {d["run"]: d["shared"] for d in less[row].as_py()}
                            part = np.arange(cut[k], cut[k + 1])
                            mine = part[_members(keys[part], pa.array(list(known), pa.int64()))]
                            shared[mine] = [known[x] for x in keys[mine].view(np.int64).tolist()]
                    own = np.flatnonzero(shared[s.from_anchor] >= s.n_phrases)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(rows[s.doc[own]])), _i64(s.core[own]), _i64(s.block[own])],
                        names=["doc", "core", "block"],
                    )

    return run


def _find_windows(size: int):
    """(doc, core, window, open) for the windows of the blocks asked for (block, open)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in parts(whole, "text"):
                asked = batch.column(2)
                for rows, s in _scans(batch.column(1), size):
                    cut = np.searchsorted(s.doc, np.arange(len(rows) + 1))
                    picked, is_open = [], []
                    for k, row in enumerate(rows.tolist()):
                        block, opened = asked[row].values.flatten()
                        order = np.argsort(np.asarray(block).view(np.uint64))
                        known = np.asarray(block).view(np.uint64)[order]
                        part = np.arange(cut[k], cut[k + 1])
                        mine = part[_members(s.block[part], block)]
                        # a block that stands twice in the document is asked for once
                        _, once = np.unique(s.block[mine], return_index=True)
                        mine = mine[np.sort(once)]
                        picked.append(mine)
                        is_open.append(opened.to_numpy(zero_copy_only=False)[order[np.searchsorted(known, s.block[mine])]])
                    cores = np.concatenate(picked)
                    start, core = s.windows(cores)
                    count = s.high[cores] - s.low[cores] + 1
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(rows[s.doc[core]])), _i64(s.core[core]), _i64(s.window_hash(start)),
                            pa.array(np.repeat(np.concatenate(is_open).astype(bool), count)),
                        ],
                        names=["doc", "core", "window", "open"],
                    )

    return run


def repeated_windows(rows: DataFrame, size: int) -> DataFrame:
    """(doc, blocks, windows): what repeats in each document, named by its bytes. All windows of a block in
    `blocks` repeat; of other blocks those in `windows` do. Documents without any are left out."""
    kind = rows.schema["doc"].dataType.simpleString()
    phrases, less = find_repeats(rows, size)
    held = phrases.withColumnRenamed("doc", "d")
    less = less.withColumnRenamed("doc", "e")
    joined = rows.join(small(held), rows["doc"] == held["d"]).join(small(less), rows["doc"] == less["e"], "left")
    blocks = joined.select("doc", "text", "repeated", "less").mapInArrow(
        _find_blocks(size), f"doc {kind}, core long, block long"
    )
    blocks = stage(blocks, "blocks")
    discard(phrases, less)
    # equal blocks are one row from here on
    kinds = blocks.groupBy("core", "block").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("doc"))
    kinds = stage(kinds, "block_kinds")
    per_core = kinds.groupBy("core").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least"))
    mixed = per_core.filter("kinds > 1 and least = 1").select("core")
    asked = kinds.join(small(mixed), "core").groupBy(F.col("doc").alias("d")).agg(
        F.collect_list(F.struct("block", (F.col("n") == 1).alias("open"))).alias("asked")
    )
    asked = stage(asked, "asked_blocks")
    # a block's bytes hold its core, so the block alone tells which it is
    whole = blocks.select("doc", "block").join(small(kinds.filter("n > 1").select("block")), "block")
    whole = stage(whole.groupBy("doc").agg(F.collect_set("block").alias("blocks")), "whole_blocks")
    discard(blocks, kinds)
    joined = rows.join(small(asked), rows["doc"] == asked["d"]).select("doc", "text", "asked")
    windows = joined.mapInArrow(_find_windows(size), f"doc {kind}, core long, window long, open boolean")
    windows = stage(windows, "windows")
    discard(asked)
    again = windows.groupBy("core", "window").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("core", "window")
    single = windows.filter("open").join(small(again), ["core", "window"]).groupBy("doc").agg(F.collect_set("window").alias("windows"))
    none = F.array().cast("array<long>")
    found = whole.join(single, "doc", "full").select(
        "doc", F.coalesce("blocks", none).alias("blocks"), F.coalesce("windows", none).alias("windows")
    )
    found = stage(found, "found_repeats")
    discard(whole, windows)
    return found


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 200) -> DataFrame:
    """Remove each byte covered by a string of `size` bytes that also starts anywhere else.

    Texts are UTF-8 bytes (null: empty); strings do not cross documents, may overlap, and are judged on the
    input. All columns stay but the text, which gives way to what is left as binary in ``kept`` (a cut may part
    a character); ``n_bytes``, ``n_removed``, ``n_spans`` and ``spans`` (start and end of the maximal removed
    runs) follow, with underscores where a name is taken. Rows that repeat a text are documents that
    repeat each other; rows of one id and text share what is looked up, which names strings by their bytes.
    Texts are read in slices of a bounded size, a longer one alone and whole. An empty table gives an empty table.

    1. Texts are cut into phrases at anchors that depend on the bytes around them (:class:`Scan`), so that equal
       windows share the phrases of their core. Phrases that stand once end the search.
    2. The runs of repeated phrases, equal ones once, are dealt to ranges of their order. Each task orders
       the suffixes of its runs by linear grouping (:func:`suffix_order`); neighbours tell how far each run
       stands somewhere else, and so which windows have a repeated core.
    3. Exact check: windows of one core that lie side by side are a block. Equal blocks are one row with a
       count; blocks that stand alone but share their core with others are compared window by window.

    Texts are stored once in buckets, and what is found is joined to them there, so only lists move; the number
    of buckets and of ranges follows the input, so no task grows with it.

    Phrases, runs, blocks and windows are compared by 64-bit hashes, blocks and windows within their core.
    Hot strings are counted before they are shuffled and never listed; lists are of one document.
    """
    key, own, blocks, windows = fresh(docs, "repeat_key", "repeat_doc", "repeat_blocks", "repeat_windows")
    text = F.col(f"`{text_col}`").cast("string")
    # texts are moved once, to the buckets of a key that no two different texts of an id, or of no id, share
    stored = docs.withColumn(key, F.xxhash64(F.col(f"`{id_col}`"), text))
    stored = bucketed(stored, key, bucket_count(docs, text_col), "texts")
    rows = stored.select(F.col(key).alias("doc"), text.alias("text"))
    rows = rows.filter(F.octet_length("text") >= size)
    found = repeated_windows(rows, size)
    found = found.select(F.col("doc").alias(own), F.col("blocks").alias(blocks), F.col("windows").alias(windows))
    joined = stored.join(small(found), stored[key] == found[own], "left").drop(own, key)
    names = [c for c in docs.columns if c != text_col]
    more = fresh(docs.drop(text_col), "kept", "n_bytes", "n_removed", "n_spans", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in parts(whole, text_col):
                column = batch.column(batch.schema.get_field_index(text_col))
                texts = [t or b"" for t in column.cast(pa.string()).cast(pa.binary()).to_pylist()]
                by_block, by_window = batch.column(blocks), batch.column(windows)
                spans: list[list[int]] = [[] for _ in texts]
                hit = np.array([v.is_valid for v in by_block])
                long = pa.array([t if h else None for t, h in zip(texts, hit, strict=True)], pa.binary())
                for rows, s in _scans(long, size):
                    cut = np.searchsorted(s.doc, np.arange(len(rows) + 1))
                    for k, row in enumerate(rows.tolist()):
                        part = np.arange(cut[k], cut[k + 1])
                        all_of = _members(s.block[part], by_block[row].values)
                        start, _ = s.windows(part[~all_of])
                        if len(by_window[row].values):
                            start = start[_members(s.window_hash(start), by_window[row].values)]
                        else:
                            start = start[:0]
                        base = s.first[k]
                        delta = np.zeros(len(texts[row]) + 1, dtype=np.int64)
                        np.add.at(delta, s.low[part[all_of]] - base, 1)
                        np.add.at(delta, s.high[part[all_of]] - base + size, -1)
                        np.add.at(delta, start - base, 1)
                        np.add.at(delta, start - base + size, -1)
                        gone = np.cumsum(delta)[:-1] > 0
                        spans[row] = np.flatnonzero(np.diff(gone, prepend=False, append=False)).tolist()
                kept = []
                for text, edges in zip(texts, spans, strict=True):
                    bounds = [0, *edges, len(text)]
                    kept.append(b"".join(text[a:b] for a, b in zip(bounds[0::2], bounds[1::2], strict=True)))
                pairs = [[{"start": a, "end": b} for a, b in zip(e[0::2], e[1::2], strict=True)] for e in spans]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(batch.schema.get_field_index(c)) for c in names],
                        pa.array(kept, pa.binary()),
                        pa.array([len(t) for t in texts], pa.int64()),
                        pa.array([len(t) - len(x) for t, x in zip(texts, kept, strict=True)], pa.int64()),
                        pa.array([len(p) for p in pairs], pa.int64()),
                        pa.array(pairs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    ],
                    names=[*names, *more],
                )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text_col]
    kinds = ["binary", "long", "long", "long", "array<struct<start:long,end:long>>"]
    return joined.mapInArrow(run, ", ".join([*fields, *[f"`{n}` {k}" for n, k in zip(more, kinds, strict=True)]]))
