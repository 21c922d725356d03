"""The corpus pipeline: quality rules, near duplicates, decontamination, personal data, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a table that is written as
Parquet and read again as the next one's docs.  All but the last return the
columns of ``docs``; the last adds the token ids.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import bpe, decontamination, ngram_join, pii, quality
from daybook.sources.store import materialize

TOKENIZER = "byte_bpe_50k.tiktoken"
#: Words per shingle and least similarity (percent) of near duplicates.
SHINGLE, SIMILAR = 5, 80
#: Rows of an Arrow batch: whole texts go through it, so a batch of Spark's 10,000 rows may hold a gigabyte.
BATCH_ROWS = 1000


def _in_small_batches(stage):
    """The stage in a session whose Arrow batches hold ``BATCH_ROWS`` rows at most."""

    @functools.wraps(stage)
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
        rows = int(spark.conf.get(setting))
        spark.conf.set(setting, str(min(rows, BATCH_ROWS) if rows > 0 else BATCH_ROWS))
        return stage(spark, docs, sf_dir)

    return bounded


@_in_small_batches
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text passes the quality rules; null, empty and short texts go."""
    return quality.quality_rules(docs).where("kept").select("row.*")


@_in_small_batches
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: that of the smallest doc_id (null first).

    Rows equal in doc_id and text are one document and one of them stays;
    rows without text stay, as they are near to nothing.
    """
    named = docs.withColumn(key := _unused("key", docs), F.xxhash64("doc_id", F.coalesce("text", F.lit("")), F.col("text").isNull()))
    slim = named.select(F.col(key).alias("key"), F.col("doc_id").alias("id"))
    classes = ngram_join.jaccard_classes(named.select(F.col(key).alias("doc_id"), "text"), SHINGLE, SIMILAR)
    classes = materialize(classes.select(F.col("doc_id").alias("key"), F.col("component_id").alias("group")).distinct(), "pipeline/classes")
    first = slim.join(classes, "key").groupBy("group").agg(F.min(F.struct("id", "key")).alias("first"))
    stay = first.select(F.col("first.key").alias(key))
    again = slim.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select(F.col("key").alias(key))
    kept = named.join(stay, key, "left_semi")
    once = kept.join(again, key, "left_anti").union(kept.join(again, key, "left_semi").dropDuplicates([key]))
    return once.drop(key)


@_in_small_batches
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds or paraphrases no benchmark item."""
    found = decontamination.find_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where(F.size("hits") == 0).select("row.*")


@_in_small_batches
def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with personal data in text replaced by marks; n_chars, where there is one, follows."""
    found = pii.find_pii(docs, pii.fit(docs), with_text=True)
    columns = {"text": F.col("redacted"), "n_chars": F.length("redacted").cast("long")}
    return found.select(*(columns[c].alias(c) if c in columns else F.col("row")[c].alias(c) for c in docs.columns))


@_in_small_batches
def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, text decoded from its ids again, with ids and n_tokens (columns of these names are replaced)."""
    path = public_tokenizers.path(TOKENIZER)
    carry = [c for c in docs.columns if c.lower() not in ("text", "ids", "n_tokens")]
    decoded = bpe.decode(bpe.encode(docs, path, public_tokenizers.PATTERN, carry), path, public_tokenizers.PATTERN)
    text = F.col("decoded").cast("string").alias("text")
    return decoded.select("row.*", text, "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii", redact_pii),
    ("byte_bpe", byte_bpe),
]

#: No SQL can express the stages' methods; tests hold the rows against brute force.
ORACLE_SQL = None


def _unused(name: str, docs: DataFrame) -> str:
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, for ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline/{name}")
    return docs
