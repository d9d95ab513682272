"""Language of a text by Bayesian fusion of what the text, its markup, its address and its host say."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.llm.common import fresh, map_batches, slices, stage, text_bytes
from hitloom.sizing import broadcast_if_small

BINS = 1 << 15
SLICE_BYTES = 500_000

# Letters of a text fall in three overlapping trigrams, so a trigram counts as a third of a draw.
OVERLAP = 3.0

# Texts of a label that the fitting sample takes at least, on average; range of the hashes that choose them.
LEAST = 40
RANGE = 1 << 40

# A-Z folded; other ASCII than letters is one separator; bytes of non-ASCII letters stay.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[:65] = 32
_FOLD[91:97] = 32
_FOLD[123:128] = 32


def trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bin, text number) of each byte trigram of the folded texts; separators count once in a row."""
    data = _FOLD[np.frombuffer(b" ".join([b"", *texts, b""]), dtype=np.uint8)]
    end = np.cumsum([1] + [len(t) + 1 for t in texts])
    keep = (data != 32) | np.append(True, data[:-1] != 32)
    at = np.flatnonzero(keep)
    d = data[keep].astype(np.uint32)
    if len(d) < 3:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    h = (d[:-2] * np.uint32(0x01000193) ^ d[1:-1] * np.uint32(0x85EBCA6B)) * np.uint32(0xC2B2AE35) ^ d[2:] * np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h = (h >> np.uint32(17)).astype(np.int64)
    # the middle byte tells the owner, and trigrams around a separator belong to no letter of it
    letter = d[1:-1] != 32
    owner = np.searchsorted(end, at[1:-1], "right") - 1
    return h[letter], owner[letter]


class LanguageModel:
    """Log-probabilities of trigrams for each language, and of a text in no language in the last row."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        smooth = 0.1
        known = np.log(counts + smooth) - np.log(counts.sum(1, keepdims=True) + smooth * BINS)
        self.table = np.vstack([known, np.full((1, BINS), -np.log(BINS))]).astype(np.float32)

    def score(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(log-likelihood of each text and class, number of trigrams)."""
        bins, owner = trigrams(texts)
        out = np.stack([np.bincount(owner, row[bins], len(texts)) for row in self.table], axis=1)
        return out / OVERLAP, np.bincount(owner, minlength=len(texts))


def train(labelled: DataFrame, text: Column, language: Column, sample: int = 4000) -> LanguageModel:
    """A model from about `sample` labelled rows, chosen by the hash of their text.

    Up to `sample` rows all are used. Of more, each label gets an equal part of the sample, but `LEAST` at
    least, out of its different texts: copies count once, and a label with fewer texts is used whole.
    The bound is on rows used for fitting only; which rows are scored and all priors are counted over
    every row. Counts are summed in the tasks; the driver gets at most `BINS` numbers per language.
    Rows without language or text are not used; no row at all gives a model without languages.
    """
    rows = labelled.select(language.cast("string").alias("lang"), text.cast("string").alias("text"))
    rows = rows.filter("lang is not null and text is not null")
    if rows.count() > sample:
        rows = rows.withColumn("h", F.xxhash64("text"))
        per = stage(rows.select("lang", "h").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "labels")
        quota = max(sample / max(per.count(), 1), LEAST)
        # all texts of a label up to its quota, then those of the smallest hashes
        limit = F.when(F.col("n") <= quota, F.lit(RANGE)).otherwise((F.lit(float(RANGE)) * quota / F.col("n")).cast("long"))
        per = per.select(F.col("lang").alias("label"), limit.alias("limit"))
        rows = rows.join(broadcast_if_small(per), rows["lang"] == per["label"])
        rows = rows.filter(F.pmod("h", F.lit(RANGE)) < F.col("limit")).dropDuplicates(["lang", "h"]).select("lang", "text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        names = np.array(batch.column(0).to_pylist(), dtype=object)
        texts = text_bytes(batch.column(1))
        lang, bins, counts = [], [], []
        for name in sorted(set(names)):
            found, _ = trigrams([texts[i] for i in np.flatnonzero(names == name)])
            n = np.bincount(found, minlength=BINS)
            at = np.flatnonzero(n)
            lang += [name] * len(at)
            bins.append(at)
            counts.append(n[at])
        return pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.string()), pa.array(np.concatenate(bins), pa.int64()), pa.array(np.concatenate(counts), pa.int64())],
            names=["lang", "bin", "n"],
        )

    sums = map_batches(rows, run, "lang string, bin long, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    found = sums.toPandas()
    languages = sorted(found["lang"].unique())
    counts = np.zeros((len(languages), BINS))
    for i, name in enumerate(languages):
        own = found[found["lang"] == name]
        counts[i, own["bin"].to_numpy()] = own["n"].to_numpy()
    return LanguageModel(languages, counts)


def _soft(scores: list[Column]) -> list[Column]:
    """Probabilities in proportion to exp(score)."""
    most = F.greatest(*scores) if len(scores) > 1 else scores[0]
    total = reduce(lambda a, b: a + b, [F.exp(s - most) for s in scores])
    return [F.exp(s - most) / total for s in scores]


def identify(
    df: DataFrame,
    model: LanguageModel,
    text: Column,
    declared: Column,
    suffix: Column,
    host: Column,
    parent: Column,
    keep: list[Column],
    min_posterior: float = 0.5,
    host_weight: float = 10.0,
    parent_weight: float = 50.0,
) -> DataFrame:
    """`keep` of each row, then ``language``, ``posterior``, ``letters`` (trigrams) and ``kept``.

    log P(l | all) = log P(text | l) + log P(declared | l) + log P(suffix | l) + log P(l | host) + c.

    * P(text | l): trigrams of the whole text (see :class:`LanguageModel`), with a class for no language.
    * P(l | host): what the texts of the other rows of the host say, smoothed by the host's `parent`
      with the weight of `host_weight` rows, and that by all rows with `parent_weight`.
    * P(declared | l), P(suffix | l): what the texts of all rows with that declaration or suffix say,
      smoothed by one row per language. A null gives no evidence.

    All are sums of the texts' posteriors by group over all rows, combined before the shuffle. A text
    without letters has a null language. A row is kept if its language is not null and its posterior
    is at least `min_posterior`. Null host and parent are groups like others. Repeated rows
    count as rows. An empty table gives an empty table. Names of `keep` should differ from those above.
    """
    n = len(model.languages) + 1
    ll = [f"ll{i}" for i in range(n)]
    names = [f"k{i}" for i in range(len(keep))]
    picked = df.select(
        *[c.alias(k) for c, k in zip(keep, names, strict=True)],
        F.lower(declared.cast("string")).alias("declared"),
        F.lower(suffix.cast("string")).alias("suffix"),
        host.cast("string").alias("host"),
        parent.cast("string").alias("parent"),
        text.cast("string").alias("text"),
    )

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        place = batch.schema.get_field_index("text")
        texts = text_bytes(batch.column(place))
        parts = [model.score(texts[a:b]) for a, b in slices(np.array([len(t) for t in texts]), SLICE_BYTES)]
        scores = np.concatenate([p[0] for p in parts])
        letters = np.concatenate([p[1] for p in parts])
        columns = [c for i, c in enumerate(batch.columns) if i != place]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(letters, pa.int64()), *[pa.array(scores[:, i]) for i in range(n)]],
            names=[*[c for c in batch.schema.names if c != "text"], "letters", *ll],
        )

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in picked.drop("text").schema)
    rows = map_batches(picked, run, f"{fields}, letters long, {', '.join(f'{c} double' for c in ll)}")
    # a text without letters says nothing and is no evidence for its group
    said = [F.when(F.col("letters") > 0, p).otherwise(0.0) for p in _soft([F.col(c) for c in ll])]
    rows = stage(rows.withColumns({f"p{i}": p for i, p in enumerate(said)}), "evidence")

    sums = [F.sum(f"p{i}") for i in range(n)]
    total = rows.agg(*[s.alias(f"t{i}") for i, s in enumerate(sums)]).first()
    total = [float(x or 0.0) for x in total]
    overall = [(t + 1.0) / (sum(total) + n) for t in total]

    by_parent = rows.groupBy("parent").agg(*[s.alias(f"d{i}") for i, s in enumerate(sums)])
    size = reduce(lambda a, b: a + b, [F.col(f"d{i}") for i in range(n)])
    by_parent = by_parent.select(
        F.col("parent").alias("dp"),
        *[((F.col(f"d{i}") + parent_weight * overall[i]) / (size + parent_weight)).alias(f"d{i}") for i in range(n)],
    )
    by_host = rows.groupBy("host", "parent").agg(*[s.alias(f"h{i}") for i, s in enumerate(sums)])
    by_host = by_host.join(broadcast_if_small(by_parent), by_host["parent"].eqNullSafe(by_parent["dp"]))
    by_host = by_host.withColumnsRenamed({"host": "hh", "parent": "hp"}).drop("dp")
    same = rows["host"].eqNullSafe(by_host["hh"]) & rows["parent"].eqNullSafe(by_host["hp"])
    full = rows.join(broadcast_if_small(by_host), same).drop("hh", "hp")

    evidence = []
    for what in ("declared", "suffix"):
        v = what[0]
        found = rows.filter(F.col(what).isNotNull()).groupBy(F.col(what).alias(f"{v}_")).agg(
            *[s.alias(f"{v}_{i}") for i, s in enumerate(sums)]
        )
        full = full.join(broadcast_if_small(found), full[what] == found[f"{v}_"], "left")
        evidence.append(
            [
                F.coalesce(F.log((F.col(f"{v}_{i}") + 1.0) / F.lit(total[i] + n)), F.lit(0.0))
                for i in range(n)
            ]
        )
    others = reduce(lambda a, b: a + b, [F.col(f"h{i}") - F.col(f"p{i}") for i in range(n)])
    prior = [
        F.log((F.greatest(F.col(f"h{i}") - F.col(f"p{i}"), F.lit(0.0)) + host_weight * F.col(f"d{i}")) / (others + host_weight))
        for i in range(n)
    ]
    score = [F.col(ll[i]) + prior[i] + evidence[0][i] + evidence[1][i] for i in range(n)]
    post = full.withColumns({f"q{i}": p for i, p in enumerate(_soft(score))})
    best = F.greatest(*[F.col(f"q{i}") for i in range(n)]) if n > 1 else F.col("q0")
    language = F.lit(None).cast("string")
    for i in reversed(range(n - 1)):
        language = F.when(F.col(f"q{i}") == best, F.lit(model.languages[i])).otherwise(language)
    language = F.when(F.col("letters") > 0, language)
    out = post.select(
        *names, language.alias("language"), best.alias("posterior"), "letters"
    ).withColumn("kept", F.col("language").isNotNull() & (F.col("posterior") >= min_posterior))
    labels = [df.select(c).columns[0] for c in keep]
    return out.select(*[F.col(k).alias(c) for k, c in zip(names, labels, strict=True)], "language", "posterior", "letters", "kept")


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]*)", 1))


def identify_pages(pages: DataFrame, model: LanguageModel, keep: list[Column]) -> DataFrame:
    """Web pages: text without markup, the language of the html tag, the last label of the host, the host,
    and the last two labels as its parent."""
    html = F.coalesce(F.col("html"), F.lit(""))
    text = F.regexp_replace(html, r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>", " ")
    declared = F.regexp_extract(html, r"(?i)<html[^>]*\blang\s*=\s*[\"']?([a-z]{2,3})", 1)
    host = host_of(F.col("url"))
    suffix = F.regexp_extract(host, r"\.([a-z]+)$", 1)
    none = lambda c: F.when(c != "", c)
    parent = F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)
    return identify(pages, model, text, none(declared), none(suffix), none(host), none(parent), keep)


def identify_documents(docs: DataFrame, model: LanguageModel, keep: list[Column]) -> DataFrame:
    """Documents: the stated language for the markup's, the source for the host, the source's name
    without its number for the parent; there is no address."""
    parent = F.regexp_replace("source", r"\d+$", "")
    return identify(docs, model, F.col("text"), F.col("lang"), F.lit(None), F.col("source"), parent, keep)


def keep_identified(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The documents whose language is identified, with their columns as they are.

    A decision holds for the rows of one id and text: they go if all of them are rejected.
    """
    found = identify_documents(
        docs, model, [F.col("doc_id"), F.xxhash64("text").alias("x1"), F.xxhash64(F.lit(1), F.col("text")).alias("x2")]
    )
    gone = found.groupBy("doc_id", "x1", "x2").agg(F.max("kept").alias("any")).filter("not any")
    names = fresh(docs, "gone_id", "gone_x1", "gone_x2")
    gone = gone.select(*[F.col(c).alias(n) for c, n in zip(("doc_id", "x1", "x2"), names, strict=True)])
    gone = stage(gone, "rejected")
    same = (
        docs["doc_id"].eqNullSafe(gone[names[0]])
        & (F.xxhash64(docs["text"]) == gone[names[1]])
        & (F.xxhash64(F.lit(1), docs["text"]) == gone[names[2]])
    )
    return docs.join(broadcast_if_small(gone), same, "left_anti")
