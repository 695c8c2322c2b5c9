"""Shared pieces of the training-data operators."""

from __future__ import annotations

import atexit
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchspark.session import ensure_checkpoint_dir, materialize

__all__ = ["BITS", "components", "counter_rows", "is_marked", "marked_keys", "materialize", "parts_for", "record_batch", "remove_at_exit",
           "small_batches", "sum_counters", "uniform", "written"]


def record_batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, schema.field(n).type)
         for n, c in ((f.name, columns[f.name]) for f in schema)], schema=schema)


def parts_for(total: int, per_part: int, least: int = 1) -> int:
    """Number of groups that keeps each at about ``per_part`` units; grows with the input."""
    return max(least, math.ceil((total or 0) / per_part))


def uniform(*cols: str) -> Column:
    """A number in [0, 1) from the hash of the columns: a bounded sample of a
    table of known size is a filter on it, without a sort or a shuffle."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(1 << 53))


#: Bytes of one Arrow batch between Spark and its Python workers where memory is short (Spark's own limit is 64 MB).
BATCH_BYTES = 4 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark) -> None:
    """Lowers the session's limit of an Arrow batch, which an executor holds several times (Spark's and the worker's copy,
    each for every task); a lower limit stays.  It changes memory only, never rows."""
    now = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_BATCH_CONF))
    if now > BATCH_BYTES or now <= 0:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))


#: Bits of a table that marks keys, whatever their number: a wrong hit is possible, a miss is not.
BITS = 1 << 26


def marked_keys(keys: DataFrame):
    """Broadcast bits of the long keys in the only column of a frame (``BITS / 8`` bytes)."""
    slot = F.col(keys.columns[0]).bitwiseAND(F.lit(BITS - 1)) + 1
    parts = keys.groupBy(F.bitmap_bucket_number(slot).alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")).collect()
    out = np.zeros(BITS // 8, np.uint8)
    for p in parts:
        out[(p.b - 1) * 4096:p.b * 4096] = np.frombuffer(p.bits, np.uint8)
    return keys.sparkSession.sparkContext.broadcast(out.tobytes())


def is_marked(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Which keys (uint64) have their bit set in the bytes of ``marked_keys``."""
    slot = key & np.uint64(BITS - 1)
    return (bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


COUNTER_CHUNK = 1 << 14
COUNTERS = "chunk long, counts binary"


def counter_rows(counts: np.ndarray) -> pa.RecordBatch:
    """Non-empty chunks of an int64 counter array as (chunk, counts) rows."""
    parts = counts.reshape(-1, COUNTER_CHUNK)
    used = np.flatnonzero(parts.any(1))
    return pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(
        [parts[i].tobytes() for i in used], pa.binary())], names=["chunk", "counts"])


def sum_counters(rows: DataFrame, size: int) -> np.ndarray:
    """Total of the counter arrays that tasks gave as ``counter_rows``: chunks
    are added on executors, one array of ``size`` counters reaches the driver."""
    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTER_CHUNK, np.int64)
        for batch in batches:
            for x in batch.column("counts").to_pylist():
                total += np.frombuffer(x, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([total.tobytes()])],
                                         names=["chunk", "counts"])
    out = np.zeros(size, np.int64)
    for r in rows.groupBy("chunk").applyInArrow(add, COUNTERS).collect():
        out[r.chunk * COUNTER_CHUNK:(r.chunk + 1) * COUNTER_CHUNK] = np.frombuffer(r.counts, np.int64)
    return out


def written(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Cuts the lineage by a compressed table in the shared checkpoint folder (for
    wide rows, where ``checkpoint`` would store them uncompressed).  The folder of
    this run is removed when the driver ends."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    remove_at_exit(spark, path)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_at_exit(spark, path: str) -> None:
    """A folder of this run in the shared checkpoint folder goes when the driver ends."""
    if not _WRITTEN:
        atexit.register(_remove_written)
    _WRITTEN.append((spark, path))


_WRITTEN: list[tuple] = []


def _remove_written() -> None:
    for spark, path in _WRITTEN:
        try:
            jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)
        except Exception:  # noqa: BLE001 - the session may be gone already
            return


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an edge table: one row (node, label) per node
    that has an edge, ``label`` the smallest node of its component.

    Every round lowers each node's label to the smallest label among its
    neighbours (a map-side combined minimum, so a hub costs one row per task)
    and then to its label's own label, which halves the remaining distances.
    Rounds are cut by reliable checkpoints; only a changed-row count reaches
    the driver.
    """
    both = materialize(edges.select(F.col(a).alias("node"), F.col(b).alias("other"))
                       .union(edges.select(F.col(b), F.col(a))).distinct())
    labels = both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("label"))
    labels = materialize(labels)
    while True:
        near = (both.join(labels.select(F.col("node").alias("other"), F.col("label").alias("l")), "other")
                .groupBy("node").agg(F.min("l").alias("l")))
        lower = (labels.join(near, "node")
                 .select("node", F.least("label", "l").alias("label"), F.col("label").alias("old")))
        jump = lower.select(F.col("node").alias("label"), F.col("label").alias("far"))
        new = materialize(lower.join(jump, "label", "left")
                          .select("node", F.least("label", F.coalesce("far", "label")).alias("label"), "old"))
        changed = new.filter("label < old").limit(1).count()
        labels = new.select("node", "label")
        if not changed:
            return labels
