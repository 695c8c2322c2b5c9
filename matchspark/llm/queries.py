"""Registered queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchspark.llm import (backoff, collocations, copies, language, licenses, neardup, packing, quality, secrets, substrings,
                            tiling, toxicity, whitening)
from matchspark.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn
    return register


def word_tokenizer() -> str:
    """File of the public word-level BPE vocabulary (a parameter of the operators)."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def held_out() -> Column:
    """Documents kept for testing: crc32 of doc_id as text, modulo 3, is 1."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1


@query("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.train(docs, ~held_out())
    return language.predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


#: A document whose best language is less probable than this has none.
LEAST_SCORE = 0.4


def stage_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in no learnt language (no letter, or no clear best
    language); columns unchanged."""
    return language.in_known_language(docs, language.train(docs, ~held_out()), LEAST_SCORE)


@query("op3_minhash_near_dedup")
def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), shingle=5, percent=85).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def stage_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each component of documents whose sets of five-word
    shingles have a similarity of 0.8 or more (two of exactly 0.8 meet in the index
    with probability 0.998); rows without a doc_id stay; columns unchanged."""
    marked = neardup.near_duplicates(docs, shingle=5, percent=80, collections=10)
    dropped = marked.groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("component_id")).alias("kept")).filter("not kept")
    return docs.join(dropped.select("doc_id"), "doc_id", "left_anti").select(*docs.columns)


@query("op8_benchmark_decontamination")
def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def stage_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark passage; columns unchanged."""
    found = tiling.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return docs.join(found.filter("contaminated").select("doc_id"), "doc_id", "left_anti").select(*docs.columns)


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query("op2_secret_scans")
def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secrets.scan(docs, secrets.train(docs))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != "model")
    return found.select("doc_id", *(count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")),
                        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def stage_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every found secret is replaced by a mark; ``n_chars`` follows the text."""
    clean = secrets.redact(docs, secrets.train(docs))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), "n_chars"))
    return clean


def _packed_digests(docs: DataFrame, kept: int = packing.KEPT) -> DataFrame:
    """Digest columns first, so that ids leave the tokenising task as one number."""
    pieces = packing.token_pieces(docs, word_tokenizer(), max_len=4096, end_id=1, kept=kept)
    pieces = packing.materialize(pieces.select(
        "doc_id", "row", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))
    return packing.place(pieces, max_len=4096)


@query("op5_best_fit_packing")
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packed_digests(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


#: Chunks kept by a tokenising worker of the pipeline, whose executors still hold what the stages before took.
STAGE_KEPT = 60_000


def stage_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last stage of the pipeline: a place in a training sequence for every piece."""
    return _packed_digests(docs.select("doc_id", "text"), STAGE_KEPT).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op9_quality_rules")
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op4_license_scans")
def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.known_digests(spark))


ORACLE_SQL["op4_license_scans"] = licenses.oracle()


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.predict(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query("op10_substring_dedup")
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.remove_repeats(table(spark, sf_dir, "documents"), window=20)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op1_lm_scoring")
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff.whole_scores(table(spark, sf_dir, "documents"))


@query("op11_exact_dedup")
def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies.exact_duplicates(spark, f"{sf_dir.rstrip('/')}/documents.parquet")


ORACLE_SQL["op11_exact_dedup"] = copies.ORACLE


@query("op12_phrase_collocations")
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLE_SQL["op12_phrase_collocations"] = collocations.ORACLE


@query("op13_embedding_whitening")
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
