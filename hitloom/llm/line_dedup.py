"""Line dedup with levelled sorted runs of line hashes."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.llm.common import fresh, map_batches, small, stage

KEY = ["k1", "k2"]


def line_key(line: bytes) -> bytes:
    """White space (bytes 9 to 13 and 32) off both ends, A-Z lower-cased."""
    return line.strip(b"\x20\x09\x0a\x0b\x0c\x0d").lower()


def _digests(keys: list[bytes]) -> np.ndarray:
    """128-bit hash of each key as two signed words."""
    joined = b"".join(xxhash.xxh3_128_digest(k) for k in keys)
    return np.frombuffer(joined, dtype="<i8").reshape(-1, 2)


def line_keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(doc, k1, k2): the different line keys of each document that have `min_chars` code points."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found, owner = [], []
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        for i, text in enumerate(texts):
            own = {line_key(line) for line in (text or b"").split(b"\n")}
            own = [k for k in own if len(k) >= min_chars and len(k.decode("utf-8", "replace")) >= min_chars]
            found += own
            owner += [i] * len(own)
        words = _digests(found)
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(owner, pa.int64())), pa.array(words[:, 0]), pa.array(words[:, 1])],
            names=["doc", *KEY],
        )

    picked = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"))
    kind = picked.schema["doc"].dataType.simpleString()
    return map_batches(picked, run, f"doc {kind}, k1 long, k2 long")


class LineRuns:
    """Counts of line keys in sorted runs, levelled like a log-structured table.

    A run is a table (k1, k2, n) bucketed and sorted by its key, so that a batch is shuffled once to
    the buckets and then merge-joined with all runs where they lie. `fanout` runs of a level are
    compacted to one of the next. Counts stop at `threshold`: such a key is settled, and later
    batches drop it by an anti-join instead of storing it again.
    """

    def __init__(self, spark: SparkSession, threshold: int, fanout: int = 3, buckets: int | None = None):
        self.spark, self.threshold, self.fanout = spark, threshold, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]

    def _write(self, counts: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (
            counts.repartition(self.buckets, *KEY)
            .write.bucketBy(self.buckets, *KEY)
            .sortBy(*KEY)
            .format("parquet")
            .saveAsTable(name)
        )
        return name

    def _runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def _sum(self, names: list[str]) -> DataFrame:
        """Runs merged by full joins on the key, which need neither shuffle nor sort."""
        out = self.spark.table(names[0])
        for name in names[1:]:
            more = self.spark.table(name).withColumnRenamed("n", "m")
            both = F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))
            out = out.join(more, KEY, "full").select(*KEY, F.least(both, F.lit(self.threshold)).alias("n"))
        return out

    def add(self, keys: DataFrame) -> None:
        """A batch (doc, k1, k2): drop settled keys, count the documents of the others, store a run."""
        counts = keys.select("doc", *KEY).distinct().groupBy(*KEY).agg(
            F.least(F.count(F.lit(1)), F.lit(self.threshold)).cast("long").alias("n")
        )
        for name in self._runs():
            settled = self.spark.table(name).filter(F.col("n") >= self.threshold).select(*KEY)
            counts = counts.join(settled, KEY, "left_anti")
        self.levels[0].append(self._write(counts))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            merged = self._write(self._sum(self.levels[level]))
            for name in self.levels[level]:
                self.spark.sql(f"DROP TABLE {name}")
            self.levels[level] = []
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(merged)
            level += 1

    def settled(self) -> DataFrame:
        """(k1, k2) of the keys found in `threshold` documents over all runs."""
        return self._sum(self._runs()).filter(F.col("n") >= self.threshold).select(*KEY)

    def drop(self) -> None:
        for name in self._runs():
            self.spark.sql(f"DROP TABLE {name}")
        self.levels = [[]]


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = 10,
    min_chars: int = 1,
    batches: int = 4,
) -> DataFrame:
    """Drop the lines whose key stands in at least `min_docs` documents, in every document.

    Lines end at ``\\n``; null and empty texts have one empty line. The key is the line stripped of
    white space with A-Z lower-cased; keys under `min_chars` code points are never dropped. A document
    is a value of `id_col`: rows with equal ids (null counts as one id) are one document, and each of
    them loses the lines. All columns stay, the text holds the lines left (null only where it was
    null and stays empty); two columns follow, ``n_lines`` and ``n_dropped`` (with an underscore
    added where `docs` has such a name). An empty table gives an empty table.

    The documents come in `batches` batches by hash of the id; see :class:`LineRuns`. Hot lines are
    counts, never lists: a document gets its own dropped keys only, bounded by its own lines.
    """
    spark = docs.sparkSession
    keys = line_keys(docs, id_col, text_col, min_chars).withColumn(
        "batch", F.pmod(F.xxhash64("doc"), F.lit(batches)).cast("int")
    )
    keys = stage(keys, "line_keys")
    runs = LineRuns(spark, min_docs)
    try:
        for i in range(batches):
            runs.add(keys.filter(F.col("batch") == i))
        settled = stage(runs.settled(), "settled_lines")
    finally:
        runs.drop()
    hit, at = fresh(docs, "dropped_keys", "hit_doc")
    hits = (
        keys.join(small(settled), KEY)
        .groupBy(F.col("doc").alias(at))
        .agg(F.collect_set(F.struct(*KEY)).alias(hit))
    )
    joined = docs.join(small(hits), docs[id_col].eqNullSafe(hits[at]), "left").drop(at)
    n_lines, n_dropped = fresh(docs, "n_lines", "n_dropped")
    names = docs.columns

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        place = batch.schema.get_field_index(text_col)
        texts, drops = batch.column(place).cast(pa.binary()).to_pylist(), batch.column(hit).to_pylist()
        kept, total, gone = [], [], []
        for text, drop in zip(texts, drops, strict=True):
            lines = (text or b"").split(b"\n")
            left = lines
            if drop:
                bad = {(d["k1"], d["k2"]) for d in drop}
                words = _digests([line_key(line) for line in lines]).tolist()
                left = [
                    line for line, w in zip(lines, words, strict=True)
                    if tuple(w) not in bad or len(line_key(line)) < min_chars
                ]
            kept.append(b"\n".join(left) if text is not None else None)
            total.append(len(lines))
            gone.append(len(lines) - len(left))
        columns = [batch.column(c) for c in names]
        columns[names.index(text_col)] = pa.array(kept, pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(total, pa.int64()), pa.array(gone, pa.int64())], names=[*names, n_lines, n_dropped]
        )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_batches(joined, run, f"{fields}, `{n_lines}` long, `{n_dropped}` long", text_col)
