"""Registered corpus queries and, where SQL can express them, their DuckDB oracles.

Each query applies one operator with production parameters to its whole table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import bpe, decontamination, language, licenses, negatives, ngram_join, periodic, pieces, pii, quality, sharding, token_counts, warc
from daybook.llm.oracle import ORACLES
from daybook.session import scratch_path


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_classes(_documents(spark, sf_dir), k=4, percent=85)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    manifest = warc.write_archives(pages, scratch_path(spark, f"daybook/warc/{uuid.uuid4().hex}"))
    return warc.read_archives(spark, manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    found = pii.find_pii(docs, pii.fit(docs), ["doc_id"])
    joined = "array_join(transform({}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    base = "filter(spans, s -> s.base)"
    return found.select(
        "row.doc_id",
        *(F.expr(f"CAST(size(filter(spans, s -> s.base AND s.kind = '{k}')) AS LONG)").alias(f"n_{k}") for k in pii.KINDS),
        F.sha2(F.expr(joined.format(base)).cast("binary"), 256).alias("base_sha256"),
        F.expr(joined.format("spans")).alias("spans"),
    )


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    docs = _documents(spark, sf_dir).select("doc_id", "text", size.alias("n_bytes"))
    counted = token_counts.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), ["doc_id", "n_bytes"])
    return counted.select("row.doc_id", "row.n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_benchmark(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), ["doc_id"])
    return found.select("row.doc_id", F.explode("hits").alias("hit")).select("doc_id", "hit.*")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    placed = sharding.histogram_sort(docs.select("doc_id", "text", crc.alias("text_crc32")), 40, ["doc_id", "text_crc32"])
    return placed.select(
        "row.doc_id", "size", "row.text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op7_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.detect_licenses(_documents(spark, sf_dir), ["doc_id"])
    return found.select(
        "row.doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.word").alias("first_word"),
        F.array_max("base.word").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base.label")), ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(0)) % 5 == 0
    model = language.fit(docs.where(~held_out))
    said = language.predict(docs.select("doc_id", "text", held_out.alias("held_out")), model, ["doc_id", "held_out"])
    return said.select("row.doc_id", "row.held_out", "lang_pred", "score", "accepted")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(_documents(spark, sf_dir), path, public_tokenizers.PATTERN, ["doc_id"])
    decoded = bpe.decode(encoded, path, public_tokenizers.PATTERN)
    return decoded.select(
        "row.doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality_rules(_documents(spark, sf_dir), ["doc_id"])
    return judged.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    decoded = pieces.decode(pieces.encode(_documents(spark, sf_dir), path, ["doc_id"], check=pieces.SPANS), path)
    return decoded.select(
        "row.doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = vectors.withColumn("label", F.expr("IF(vec_id % 7 = 0, (label + 1) % 10, label)"))
    return negatives.hard_negatives(moved, F.col("vec_id") % 100 == 0)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = _documents(spark, sf_dir).select("doc_id", "text", hashed.alias("h"))
    # Of a tenth of the texts the words from a on become copies of p of them; only those are cut, and one without words stays.
    cut = docs.withColumn("w", F.expr(r"IF(h % 10 = 0, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0), NULL)")).withColumn("n", F.size("w"))
    tail = cut.selectExpr("*", "h div 10 % nullif(n, 0) AS a", "h div 10 % 8 + 3 AS parts").selectExpr("*", "1 + (n - a) div parts AS p")
    text = "IF(h % 10 = 0 AND n > 0, array_join(transform(w, (x, i) -> IF(i < a, x, w[CAST(a + (i - a) % p AS INT)])), ' '), text) AS text"
    found = periodic.periodic_runs(tail.selectExpr("doc_id", text), ["doc_id"])
    first = "CASE WHEN {0} < {1} THEN -1 WHEN {0} > {1} THEN 1 ELSE 0 END"
    order = "CASE WHEN r.length * s.period <> s.length * r.period THEN " + first.format("s.length * r.period", "r.length * s.period")
    order += " WHEN r.start <> s.start THEN " + first.format("r.start", "s.start") + " ELSE " + first.format("r.period", "s.period") + " END"
    return found.withColumn("best", F.expr(f"try_element_at(array_sort(runs, (r, s) -> {order}), 1)")).select(
        "row.doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.expr(r"array_join(transform(runs, r -> concat(concat_ws(',', r.start, r.length, r.period), '\n')), '')").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ngram_jaccard": op1_ngram_jaccard,
        "op2_warc": op2_warc,
        "op3_pii": op3_pii,
        "op4_token_counts": op4_token_counts,
        "op5_decontamination": op5_decontamination,
        "op6_sharding": op6_sharding,
        "op7_license_scans": op7_license_scans,
        "op8_language_id": op8_language_id,
        "op9_byte_bpe": op9_byte_bpe,
        "op10_quality_rules": op10_quality_rules,
        "op11_sentencepiece": op11_sentencepiece,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_periodic_runs": op13_periodic_runs,
    }


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
