"""Exact deduplication by streams with keyed state (operator 11).

Texts are equal when they are identical after lower-casing A-Z only; of equal
texts the row with the largest doc_id stays.  Only DataFrame functions run.

1. ``arrive``: a stream over the document files appends one narrow row per
   document to a table: ``doc_id``, the SHA-256 of the normalised text, and the
   content locator (file and row index in it).
2. ``remember``: a stream over that table folds it into state kept by digest, on
   disk (RocksDB) and without expiry: the stable identifier (largest doc_id), its
   locator and the number of rows.  Partial results are combined before the
   shuffle, so a digest that a third of all rows holds is one row per task.
   Both streams end when all files are read (``availableNow``) and start where
   they stopped when called again with the same store: new files alone are read.
3. ``verdicts``: the state is read as a table.  Rows whose digest the state holds
   more than once are hits; their full texts are fetched by locator and grouped
   by (digest, all bytes), again combined before the shuffle.  Digests with several
   different texts are split into one group for each text.

Defined results: a null text is the empty text; rows with a null doc_id are ordinary
rows, and a null id is smaller than any other (``keep_id`` is null only if all ids
of the group are); of rows that repeat the largest doc_id the one with the last
locator stays, so that every group keeps one row; an empty table gives an empty
result; texts of any length are compared whole; other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchspark.llm.common import materialize, remove_at_exit
from matchspark.session import broadcast_if_small, ensure_checkpoint_dir, file_or_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # one budget for all state of an executor instead of one for each partition
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # no space reserved ahead for the logs of many small partitions
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
ROWS = "doc_id long, digest binary, file string, row long"


def normalised(text: Column) -> Column:
    """Null as empty, A-Z in lower case (``lower`` does just that to texts of ASCII alone, and faster)."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """A stream takes the settings of the moment at which it starts."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _documents(reader, path: str, id_col: str, text_col: str) -> DataFrame:
    located = reader.parquet(path).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return located


def arrive(spark: SparkSession, path: str, store: str, id_col: str = "doc_id", text_col: str = "text",
           digest: Callable[[Column], Column] = sha256) -> None:
    """Appends (doc_id, digest, file, row) of the documents in files that the store has not read yet."""
    types = spark.read.parquet(path).schema
    folder, name = file_or_folder(spark, path)
    reader = spark.readStream.schema(f"`{id_col}` {types[id_col].dataType.simpleString()}, `{text_col}` string")
    if name:
        reader = reader.option("pathGlobFilter", name)
    rows = _documents(reader, folder, id_col, text_col).select("doc_id", digest(normalised(F.col("text"))).alias("digest"), "file", "row")
    (rows.writeStream.format("parquet").option("checkpointLocation", f"{store}/arrived").trigger(availableNow=True)
     .start(f"{store}/rows").awaitTermination())


def remember(spark: SparkSession, store: str) -> None:
    """Folds arrived rows into the state: digest -> largest (doc_id, file, row), number of rows."""
    rows = spark.readStream.schema(ROWS).parquet(f"{store}/rows")
    state = rows.groupBy("digest").agg(F.max(F.struct("doc_id", "file", "row")).alias("kept"), F.count("*").alias("n"))
    with _settings(spark, STATE):
        (state.writeStream.format("noop").outputMode("update").option("checkpointLocation", f"{store}/state")
         .trigger(availableNow=True).start().awaitTermination())


def repeated(spark: SparkSession, store: str) -> DataFrame:
    """``digest, kept, n`` of the digests that the state holds for more than one row."""
    state = spark.read.format("statestore").load(f"{store}/state")
    kept, n = state.schema["value"].dataType.names
    return state.select("key.digest", F.col(f"value.{kept}").alias("kept"), F.col(f"value.{n}").alias("n")).filter("n > 1")


def verdicts(spark: SparkSession, path: str, store: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every arrived document."""
    rows = spark.read.schema(ROWS).parquet(f"{store}/rows")
    groups = materialize(repeated(spark, store))
    hits = materialize(rows.join(broadcast_if_small(groups.select("digest")), "digest", "left_semi").select("digest", "file", "row"))
    texts = (_documents(spark.read, path, id_col, text_col).join(broadcast_if_small(hits), ["file", "row"])
             .select("digest", "doc_id", "file", "row", normalised(F.col("text")).alias("norm")))
    # full bytes: digests of several texts (not expected of SHA-256) become several groups
    mixed = materialize(texts.groupBy("digest", "norm").count().groupBy("digest").count().filter("count > 1").select("digest"))
    own = F.struct("doc_id", "file", "row")
    judged = rows.join(broadcast_if_small(groups), "digest", "left")
    if mixed.limit(1).count():
        split = texts.join(broadcast_if_small(mixed), "digest", "left_semi")
        true = split.groupBy("digest", "norm").agg(F.max(own).alias("true_kept"), F.count("*").alias("true_n"))
        judged = judged.join(split.join(true, ["digest", "norm"]).select("file", "row", "true_kept", "true_n"), ["file", "row"], "left")
        judged = judged.withColumn("kept", F.coalesce("true_kept", "kept")).withColumn("n", F.coalesce("true_n", "n"))
    kept = F.coalesce("kept", own)
    return judged.select(
        "doc_id", kept["doc_id"].alias("keep_id"), F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        ((F.col("file") == kept["file"]) & (F.col("row") == kept["row"])).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def exact_duplicates(spark: SparkSession, path: str, store: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                     digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """All three steps over the parquet file or folder ``path``.  Without a ``store`` (a folder that
    the cluster shares, kept between calls) a new one under the session's checkpoint folder serves this run."""
    if store is None:
        store = f"{ensure_checkpoint_dir(spark)}/copies-{uuid.uuid4().hex}"
        remove_at_exit(spark, store)
    arrive(spark, path, store, id_col, text_col, digest)
    remember(spark, store)
    return verdicts(spark, path, store, id_col, text_col)


ORACLE = f"""
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') AS norm FROM documents)
WINDOW g AS (PARTITION BY norm)
"""
