"""What the operators share: stored stages, plain column names, rolling hashes, classes of linked ids."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.storage import work_folder


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` below ``spark.checkpoint.dir`` and read it back: lineage ends here, and a lost
    executor costs only the tasks it was running."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Bytes of text in a bucket, on average.
BUCKET_BYTES = 128_000_000


def bucket_count(df: DataFrame, text: str) -> int:
    """Shuffle partitions, or more where a bucket would hold over `BUCKET_BYTES` of the column `text`."""
    size = df.agg(F.coalesce(F.sum(F.octet_length(f"`{text}`")), F.lit(0))).first()[0]
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))


def bucketed(df: DataFrame, key: str, n: int, name: str, dealt: bool = False) -> DataFrame:
    """`df` stored in `n` buckets of `key` below ``spark.checkpoint.dir``: joins on `key` move the other side only.

    With `dealt` the rows of a bucket lie in one partition already, and nothing is shuffled. The catalog keeps no
    entry: the table is known by its files.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    placed = df if dealt else df.repartition(n, key)
    placed.write.format("parquet").bucketBy(n, key).option("path", work_folder(spark, name)).saveAsTable(table)
    stored = spark.table(table)
    stored.schema  # resolved while the catalog still knows it
    spark.sql(f"DROP TABLE {table}")
    return stored


def small(lists: DataFrame) -> DataFrame:
    """The side of a join that is moved and held, so that the other is not sorted: keys or lists, never texts. It has
    one row for each key."""
    return lists.hint("shuffle_hash")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of `df` has, made of `names` with underscores."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


# Bytes of text that a task has as Python objects at once; a longer text stands alone.
PART_BYTES = 1_000_000


def parts(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """`batch` in parts of at most `PART_BYTES` of the column `text`."""
    column = batch.column(batch.schema.get_field_index(text))
    for a, b in slices(np.asarray(pc.fill_null(pc.binary_length(column), 0)), PART_BYTES):
        yield batch.slice(a, b - a)


def map_batches(
    df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, text: str = "text"
) -> DataFrame:
    """`fn` on parts of each Arrow batch of `df` that hold a bounded size of the column `text`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, text):
                yield fn(part)

    return df.mapInArrow(run, schema)


def slices(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows whose lengths sum to at most `most`; a longer row stands alone.

    This bounds the memory of vectorised work; every row is in exactly one range.
    """
    start, total = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if len(lengths):
        yield start, len(lengths)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text, null as empty."""
    return [b if b is not None else b"" for b in column.cast(pa.binary()).to_pylist()]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads all bits of 64-bit words (a bijection)."""
    h = h.copy()
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


_MULTIPLIER = 0x9E3779B97F4A7C15
INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def powers(n: int, base: int = _MULTIPLIER) -> np.ndarray:
    """``base**i`` modulo 2**64 for i below `n` (kept between calls)."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        have[0] = 1
        _POWERS[base] = have = np.multiply.accumulate(have)
    return have[:n]


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Prefix sums of ``values[i] * M**i`` (64-bit, n + 1 long), from which any range is hashed."""
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(len(values)), out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values[start:end]; equal ranges have equal hashes wherever they stand."""
    start = np.asarray(start)
    return mix((prefix[end] - prefix[start]) * powers(len(prefix), INVERSE)[start])


def byte_table(fold_case: bool, seed: int = 1) -> np.ndarray:
    """A random word for each byte; with `fold_case` A-Z share those of a-z."""
    table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(2 * seed + 1))
    if fold_case:
        table[65:91] = table[97:123]
    return table


_WORD_TABLE = byte_table(fold_case=True)


def word_edges(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all texts, start and end of every word in them, start of each text and of what would be the next):
    words are maximal runs without ASCII white space."""
    data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    # 9 to 13 and the blank; smaller bytes wrap around
    space = (data - np.uint8(9) < 5) | (data == 32)
    edges = np.flatnonzero(np.diff(space, prepend=True))
    return data, edges[0::2], edges[1::2], np.cumsum([0] + [len(t) + 1 for t in texts])


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of every word, A-Z folded."""
    data, start, end, first = word_edges(texts)
    return range_hash(prefix_hash(_WORD_TABLE.take(data)), start, end), np.searchsorted(first, start, "right") - 1


def shingle_hashes(texts: list[bytes], size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of every run of `size` words; a shorter text with words has one shingle."""
    words, owner = word_hashes(texts)
    count = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(count) - count
    n = np.where(count == 0, 0, np.maximum(count - size + 1, 1))
    text = np.repeat(np.arange(len(texts)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    prefix = prefix_hash(words)
    return range_hash(prefix, at, np.minimum(at + size, (first + count)[text])), text


def words_of(batch_texts: list[bytes]) -> np.ndarray:
    """Number of words of each text."""
    _, start, _, first = word_edges(batch_texts)
    return np.diff(np.searchsorted(start, first))


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables that end where the key changes, from batches sorted by `keys`."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        same = np.ones(batch.num_rows, dtype=bool)
        for k in keys:
            v = np.asarray(batch.column(batch.schema.get_field_index(k)))
            same &= v == v[-1]
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if cut:
            yield pa.Table.from_batches([*rest, batch.slice(0, cut)])
            rest = [batch.slice(cut)]
        else:
            if rest and any(
                rest[0].column(rest[0].schema.get_field_index(k))[0] != batch.column(batch.schema.get_field_index(k))[0]
                for k in keys
            ):
                yield pa.Table.from_batches(rest)
                rest = []
            rest.append(batch)
    if rest:
        yield pa.Table.from_batches(rest)


def text_key(text: Column) -> tuple[Column, Column]:
    """128 bits that stand for a text (two 64-bit hashes with different seeds)."""
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def classes(links: DataFrame) -> DataFrame:
    """(id, class) of every id in `links` (a, b): the smallest id that links reach.

    Each id points to its smallest neighbour, or to itself; pointers are doubled until all point to the
    end of their chain; then links between different ends are the links of the next, smaller round. A
    star takes one round. Minima are combined before the shuffle; nothing is collected.
    """
    edges = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))
    edges = stage(edges.filter("u != v").distinct(), "links")
    found = None
    while found is None or not edges.isEmpty():
        at = stage(edges.groupBy(F.col("u").alias("id")).agg(F.least("id", F.min("v")).alias("class")), "classes")
        moved = True
        while moved:
            up = at.select(F.col("id").alias("class"), F.col("class").alias("up"))
            new = at.join(up, "class", "left").select("id", F.col("class").alias("was"), F.coalesce("up", "class").alias("class"))
            new = stage(new, "classes")
            at, moved = new.select("id", "class"), not new.filter("was != class").isEmpty()
        ends = edges.join(at.toDF("u", "x"), "u").join(at.toDF("v", "y"), "v")
        edges = stage(ends.filter("x != y").select(F.col("x").alias("u"), F.col("y").alias("v")).distinct(), "links")
        if found is None:
            found = at
        else:
            found = found.join(at.toDF("class", "up"), "class", "left").select("id", F.coalesce("up", "class").alias("class"))
    return found


def discard(*tables: DataFrame) -> None:
    """Delete the files of stored stages that are no longer needed, and let the driver drop what it
    holds of finished plans, so that executors free their shuffle files."""
    for df in tables:
        jvm, hadoop = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(hadoop).delete(path, True)
        release(df)


def release(df: DataFrame) -> None:
    """Let the driver drop finished plans, so that executors free the shuffle files of stages stored so far."""
    df.sparkSession._jvm.System.gc()
