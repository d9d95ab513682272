"""Near-duplicate documents by improved consistent weighted sampling over TF-IDF shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.llm.common import fresh, map_batches, mix, parts, shingle_hashes, slices, stage, text_bytes, text_key
from hitloom.llm.near_links import near_classes
from hitloom.llm.paragraph_dedup import BANDS as PLAIN
from hitloom.llm.paragraph_dedup import signatures
from hitloom.sizing import broadcast_if_small

# Counters of document frequencies; a shingle's frequency is that of its counter.
COUNTERS = 1 << 18
SLICE_BYTES = 500_000

# Bands and samples in a band: a pair of likeness 0.8 shares a band with probability 0.9998.
BANDS, ROWS = 12, 3


def weights(
    texts: list[bytes], idf: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingle, text number, weight) of the different shingles of each text, in order of both."""
    shingle, owner = shingle_hashes(texts, size)
    order = np.lexsort((shingle, owner))
    shingle, owner = shingle[order], owner[order]
    new = np.ones(len(shingle), dtype=bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(shingle)))
    shingle, owner = shingle[at], owner[at]
    return shingle, owner, count * idf[shingle >> np.uint64(46)]


def document_frequencies(docs: DataFrame, text_col: str, size: int) -> tuple[np.ndarray, int]:
    """Documents of each counter over all rows, and the number of rows.

    Tasks count into an array of fixed length and return what is not zero; the driver gets at most
    `COUNTERS` sums, whatever the input.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(COUNTERS, dtype=np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for part in parts(batch, "text"):
                shingle, _, _ = weights(text_bytes(part.column(0)), np.ones(COUNTERS), size)
                total += np.bincount((shingle >> np.uint64(46)).astype(np.int64), minlength=COUNTERS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1), pa.int64()), pa.array(np.append(total[at], rows), pa.int64())],
            names=["counter", "n"],
        )

    counts = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "counter long, n long")
    found = counts.groupBy("counter").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(COUNTERS, dtype=np.int64)
    real = found["counter"] >= 0
    out[found["counter"][real].to_numpy()] = found["n"][real].to_numpy()
    return out, int(found["n"][~real].sum())


def _halves(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Upper and lower 32 bits."""
    return (h >> np.uint64(32)).astype(np.uint32), h.astype(np.uint32)


def _gamma(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Gamma(2, 1) numbers, above 0, from the upper 24 bits of two words: -ln of a product of uniform numbers."""
    p = (u >> np.uint32(8)).view(np.int32).astype(np.float32) + np.float32(0.5)
    p *= ((v >> np.uint32(8)).view(np.int32).astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-48)
    return np.maximum(-np.log(p), np.float32(2.0**-24))


class Sampler:
    """Improved consistent weighted sampling.

    For a shingle of weight S and draws r ~ Gamma(2, 1), c ~ Gamma(2, 1), b ~ U(0, 1):
    t = floor(ln S / r + b), ln y = r (t - b), ln a = ln c - ln y - r; the sample is (shingle, t) of the
    smallest a. Two texts have equal samples with the probability of their weighted Jaccard likeness.
    """

    def __init__(self, samples: int, seed: int):
        self.salt = np.random.default_rng(seed).integers(0, 1 << 63, samples, dtype=np.uint64)

    def draws(self, shingle: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(r, ln c, b) of each shingle in sample k, from its hash alone, so no two share their numbers."""
        h = mix(shingle ^ self.salt[k])
        g = h * np.uint64(0x9E3779B97F4A7C15)
        g ^= g >> np.uint64(32)
        (u, v), (x, y) = _halves(h), _halves(g)
        r, log_c = _gamma(u, v), np.log(_gamma(x, y))
        beta = (((u & 0xFF) << 8) | (v & 0xFF)).view(np.int32).astype(np.float32) * np.float32(2.0**-16)
        return r, log_c, beta

    def sample(self, shingle: np.ndarray, start: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Samples (texts, samples) as 64-bit words; text i has the shingles from start[i] to the next."""
        out = np.empty((len(start), len(self.salt)), dtype=np.uint64)
        log_s = np.log(weight).astype(np.float32)
        size = np.diff(np.append(start, len(shingle)))
        for k in range(len(self.salt)):
            r, log_c, beta = self.draws(shingle, k)
            t = np.floor(log_s / r + beta)
            a = log_c - r * (t - beta + 1)
            least = np.repeat(np.minimum.reduceat(a, start), size)
            # of equal numbers, rare at 24 bits, the smallest shingle is the sample
            tied = np.where(a == least, shingle, np.uint64(0xFFFFFFFFFFFFFFFF))
            first = np.minimum.reduceat(tied, start)
            hit = np.flatnonzero(tied == np.repeat(first, size))
            out[:, k] = mix(shingle[hit] ^ (t[hit].astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        return out


_SAMPLERS: dict[tuple[int, int], Sampler] = {}


def sampler(samples: int, seed: int) -> Sampler:
    """The sampler of a seed, made once in a task."""
    if (samples, seed) not in _SAMPLERS:
        _SAMPLERS[samples, seed] = Sampler(samples, seed)
    return _SAMPLERS[samples, seed]


def near_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.8,
    shingle: int = 5,
    seed: int = 11,
    plain: bool = False,
) -> DataFrame:
    """(id, class, kept): documents whose texts have a weighted Jaccard likeness >= `threshold` over the
    TF-IDF weights of their runs of `shingle` words are linked; linked documents are a class, named by its
    smallest id. `kept` is true for the row whose id is the class.

    TF is the count in the text, IDF is ln((1 + rows) / (1 + rows of the shingle's counter)) + 1 over all
    rows; there are `COUNTERS` counters, so what rare shingles get is a little less than their exact IDF. Texts of
    any length are sampled from all their shingles, a slice of a batch at a time.
    Texts of fewer words than `shingle` have one shingle of all their words. Equal texts are always of one
    class, empty ones too; null texts and rows with a null id are in no class but their own (class is the id,
    and ``kept`` is true). Rows that repeat an id and a text are all kept or all dropped. Other columns are
    left out, an empty table gives an empty table.

    With `plain` documents are linked too whose sets of shingles have a Jaccard likeness >= `threshold`: in a
    large group of copies the shared shingles weigh little, so copies of plain likeness 0.8 are less alike by
    weight. Their candidates share one of the bands of :func:`hitloom.llm.paragraph_dedup.signatures`.

    Equal texts are compared once. Candidates share one of `BANDS` bands of `ROWS` samples; see
    :mod:`hitloom.llm.near_links` for large groups.
    """
    frequency, n = document_frequencies(docs, text_col, shingle)
    idf = np.log((1.0 + n) / (1.0 + np.minimum(frequency, n))) + 1.0
    shared = docs.sparkSession.sparkContext.broadcast(idf)  # COUNTERS numbers
    x1, x2 = text_key(F.col(text_col).cast("string"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), x1.alias("x1"), x2.alias("x2"), F.col(text_col).cast("string").alias("text"))

    def sign(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = text_bytes(batch.column(3))
        bands = np.zeros((len(texts), BANDS), dtype=np.int64)
        size = np.zeros(len(texts))
        more, items = np.zeros((len(texts), PLAIN if plain else 0), dtype=np.int64), np.zeros(len(texts))
        for a, b in slices(np.array([len(t) for t in texts]), SLICE_BYTES):
            s, owner, w = weights(texts[a:b], shared.value, shingle)
            if not len(s):
                continue
            start = np.flatnonzero(np.diff(owner, prepend=-1))
            words = sampler(BANDS * ROWS, seed).sample(s, start, w).reshape(len(start), BANDS, ROWS)
            key = np.repeat(np.arange(BANDS, dtype=np.uint64)[None], len(start), 0)
            for r in range(ROWS):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) ^ words[:, :, r])
            bands[a + owner[start]] = key.view(np.int64)
            size[a + owner[start]] = np.add.reduceat(w, start)
            if plain:
                more[a + owner[start]], items[a + owner[start]] = signatures(texts[a:b], shingle, seed)
        also = np.arange(len(texts) + 1, dtype=np.int32) * more.shape[1]
        offsets = np.arange(len(texts) + 1, dtype=np.int32) * BANDS
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:3], batch.column(3).is_valid(), pa.array(size),
             pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands.ravel())), pa.array(items),
             pa.ListArray.from_arrays(pa.array(also), pa.array(more.ravel()))],
            names=["id", "x1", "x2", "known", "size", "bands", "items", "plain"],
        )

    signed = stage(
        map_batches(
            rows, sign,
            "id long, x1 long, x2 long, known boolean, size double, bands array<long>, items double, plain array<long>",
        ),
        "signed",
    )
    usable = signed.filter("known and id is not null")
    # one row for each different text; its smallest id stands for it
    distinct = usable.groupBy("x1", "x2").agg(F.min("id").alias("rep"), F.first(F.struct("size", "bands", "items", "plain")).alias("s")).select("x1", "x2", "rep", "s.*")
    distinct = stage(distinct, "distinct_texts")
    worded = distinct.filter("size > 0")
    buckets = worded.select(F.explode("bands").alias("bucket"), F.col("rep").alias("id"), "size")
    if plain:
        bare = worded.select(F.explode("plain").alias("bucket"), F.col("rep").alias("id"), F.col("items").alias("size"))
        buckets = buckets.unionByName(bare)

    def fetch(ids: DataFrame) -> DataFrame:
        wanted = ids.join(distinct.select(F.col("rep").alias("id"), "x1", "x2"), "id")
        wanted = stage(wanted.withColumnsRenamed({"id": "y", "x1": "y1", "x2": "y2"}), "candidates")
        same = (rows["id"] == wanted["y"]) & (rows["x1"] == wanted["y1"]) & (rows["x2"] == wanted["y2"])
        return rows.join(broadcast_if_small(wanted), same).select("id", "text").dropDuplicates(["id"])

    def prepare(batch: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        out = []
        for a, b in slices(np.array([len(t) for t in batch]), SLICE_BYTES):
            s, owner, w = weights(batch[a:b], shared.value, shingle)
            cut = np.searchsorted(owner, np.arange(b - a + 1))
            out += [(s[i:j], w[i:j]) for i, j in zip(cut[:-1], cut[1:], strict=True)]
        return out

    at, _ = near_classes(buckets, fetch, prepare, threshold, plain=plain)
    named = distinct.select("x1", "x2", "rep").join(at.withColumnRenamed("id", "rep"), "rep", "left")
    named = named.select("x1", "x2", F.coalesce("class", "rep").alias("class"))
    classed = usable.select("id", "x1", "x2").join(named, ["x1", "x2"]).select("id", "class")
    alone = signed.filter("not (known and id is not null)").select("id", F.col("id").alias("class"))
    return classed.unionByName(alone).select(
        F.col("id").alias(id_col), "class", F.col("id").eqNullSafe(F.col("class")).alias("kept")
    )


def keep_one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The documents without the near copies: of each class the document of the smallest id stays.

    All columns stay as they are; null texts and null ids stay.
    """
    gone = near_documents(docs, **options).filter("not kept").select("doc_id").distinct()
    (name,) = fresh(docs, "gone_id")
    gone = stage(gone.withColumnRenamed("doc_id", name), "near_copies")
    return docs.join(broadcast_if_small(gone), docs["doc_id"] == gone[name], "left_anti")
