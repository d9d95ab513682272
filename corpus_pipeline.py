"""From `documents` to token ids in five stages, each an operator of ``hitloom.llm``.

Stages take (spark, docs, sf_dir) and return a DataFrame; each one's result is written as Parquet and read
again as the next one's documents. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.llm import language_id, line_dedup, mixing, queries, sentencepiece_chunks, weighted_minhash
from hitloom.llm.common import stage

# Part of the tokens left that the mixture takes; no document is used twice.
MIXED_SHARE = 0.9

# Bytes of rows that Spark hands to Python at once. Five stages share the executors, whose buffers stay as large as the
# largest batch; Spark's default lets 10,000 texts of any size up to 64 MB be one.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_DEFAULT, BATCH_BYTES = "67108864b", 2_097_152

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def bounded(step: Stage) -> Stage:
    """`step` with batches of at most `BATCH_BYTES` (a larger row alone), unless the session has its own bound. The session
    keeps the setting, as the stage's result is computed after the call."""

    @wraps(step)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.conf.get(BATCH) == BATCH_DEFAULT:
            spark.conf.set(BATCH, str(BATCH_BYTES))
        return step(spark, docs, sf_dir)

    return run


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that text, stated language and source agree on; the others go."""
    model = language_id.train(docs, F.col("text"), F.col("lang"), sample=4000)
    return language_id.keep_identified(docs, model)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand in ten or more documents go from all of them; `n_chars` follows the text."""
    left = line_dedup.dedup_lines(docs, min_docs=10, min_chars=1)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five words, likeness 0.8 or more, weighted or plain."""
    return weighted_minhash.keep_one_of_each(docs, threshold=0.8, shingle=5, plain=True)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mixture; a document chosen several times stands as often."""
    mixed = mixing.mix_sources(docs, *queries.source_tree(), share=MIXED_SHARE, max_epochs=1.0)
    copies = mixed.columns[len(docs.columns)]
    return mixed.withColumn(copies, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of them and of the text they decode to."""
    return queries.tokens(docs).select("doc_id", "lang", "source", "ids", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", bounded(identify_language)),
    ("line_dedup", bounded(drop_common_lines)),
    ("minhash", bounded(drop_near_copies)),
    ("mixing", bounded(mix)),
    ("sentencepiece", bounded(tokenize)),
]

# SQL has neither the language model, the sampling nor the tokenizer.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
