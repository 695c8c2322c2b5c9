"""Stupid-backoff language-model scores (operator 1).

``whole_scores`` (the query) is of order 3 and has no vocabulary: a word after u v
scores ``c(u v w) / c(u v)``, the second word of a document ``c(v w) / c(v)``, the
first ``c(w) / N``; the document's score is the sum of their logarithms.  All
counts are of the scored corpus, so every gram has a count above 0 and nothing
backs off.  The sum telescopes to

    sum log c(trigrams) - sum log c(pairs that neither begin nor end the text) - log N

(shorter texts: the logarithm of their only gram's count, less ``log N``).

* Grams are keyed by a 63-bit hash and a type bit; at 30 GB less than one pair of
  different grams is expected to share a key.
* Grams that a sample shows to be frequent (at most ``HOT_GRAMS``) are counted exactly
  in one array over the whole table and scored where they are read: the keys that
  a large part of all documents holds are never shuffled.  The sample decides
  only which way a gram goes, not its count.
* All other grams are partitioned by ranges of the key, with their documents and
  counts.  A bucket holds every place of its grams, so whoever counts them has a
  partial score for each document; buckets are counted one after another, and their
  scores added over a part of several, one packed row per slice and part; a slice's
  rows are then added.  The number of buckets follows the word count.
* Texts of one word are joined to exact word counts.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case.  Defined results: null
texts and texts without words have 0 words, sum 0 and mean 0; repeated
doc_ids, and null ones, are one document (their sums are added); an empty table gives an
empty result; texts of any length are scored whole; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchspark.llm.common import (COUNTER_CHUNK, COUNTERS, counter_rows, parts_for, record_batch, small_batches, sum_counters,
                                   uniform, written)
from matchspark.llm.words import Words, batch_words, grams, mix

# Which grams are counted without a shuffle: at most so many, seen so often in a sample of about so many documents.
HOT_GRAMS = 1 << 18
HOT_DOCS = 4000
HOT_SEEN = 4
#: Grams that are counted at once, about, and buckets of a part, whose sums are added; both numbers follow the word count.
GRAM_BUCKET = 600_000
TASK_BUCKETS = 8
#: Partial sums that a task adds up before it gives them.
HELD_SUMS = 1_000_000
WORD_MARKS = 1 << 20
GRAM_SLICE = 1 << 19
#: Grams that a task collects over its slices before it deals them to the buckets: rows per bucket, and what each costs, stay few.
GROUP_GRAMS = 300_000
GROUP_DOCS = 1 << 16
#: Bytes of packed rows given at once.
GIVEN_BYTES = 1 << 19
ONE_WORD = r"^[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+$"
#: Stands for a null doc_id inside the job.
NO_ID = -(1 << 63)


def _planes(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()


def _unplanes(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _events(w: Words):
    """Every pair and trigram of a slice: its document, key (type in the last bit,
    1 for pairs) and, for pairs, its weight in the score plus 1."""
    doc, size = w.doc_of_word().astype(np.int32), np.diff(w.first)
    at3, at2 = np.flatnonzero(doc[2:] == doc[:-2]), np.flatnonzero(doc[1:] == doc[:-1])
    place, of = at2 - w.first[doc[at2]], size[doc[at2]]
    extra = np.where(of == 2, 2, (place == 0) | (place == of - 2)).astype(np.uint8)
    key = np.concatenate((grams(w.hash, 3)[at3] << np.uint64(1), (grams(w.hash, 2)[at2] << np.uint64(1)) | np.uint64(1)))
    return np.concatenate((doc[at3], doc[at2])), key, np.concatenate((np.zeros(len(at3), np.uint8), extra))


def _weight(key: np.ndarray, n: np.ndarray, extra: np.ndarray) -> np.ndarray:
    return np.where((key & np.uint64(1)) == 0, n, extra.astype(np.int64) - n)


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of the key, so that differences inside a bucket are small."""
    return ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _hot_grams(texts: DataFrame) -> np.ndarray:
    """Sorted keys of grams that are frequent in a sample of the documents."""
    def run(batches):
        schema = pa.schema([("key", pa.int64()), ("n", pa.int64())])
        for batch in batches:
            for _, _, w in batch_words(batch.column(0), lower=True, limit=GRAM_SLICE):
                d, key, _ = _events(w)
                order = np.lexsort((d, key))
                key, d = key[order], d[order]
                key = key[np.concatenate(([True], (key[1:] != key[:-1]) | (d[1:] != d[:-1])))[:len(key)]]
                key, n = np.unique(key, return_counts=True)
                yield record_batch(schema, key=key.view(np.int64), n=n)
    share = min(1.0, HOT_DOCS / max(1, texts.count()))
    seen = (texts.filter(uniform("doc_id") < share).select("text").mapInArrow(run, "key long, n long")
            .groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= HOT_SEEN))
    top = seen.orderBy(F.desc("n"), "key").limit(HOT_GRAMS).toArrow()
    return np.sort(top.column("key").to_numpy().astype(np.int64).view(np.uint64))


GRAMS = "part long, bucket long, slice long, docs binary, keys binary, doc binary, n binary, extra binary, words binary, own binary"
SUMS = "slice long, docs binary, words binary, sums binary"


def whole_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, log_score, mean_log_score`` of every document, order 3, all words."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"), F.col(text_col).alias("text"))
    hot_keys = spark.sparkContext.broadcast(_hot_grams(texts))
    size = HOT_GRAMS + COUNTER_CHUNK  # the last counter is the number of words

    def places(key: np.ndarray):
        hot = hot_keys.value
        if not len(hot):
            return np.zeros(len(key), np.int64), np.zeros(len(key), bool)
        at = np.minimum(np.searchsorted(hot, key), len(hot) - 1)
        return at, hot[at] == key

    def count_hot(batches):
        table = np.zeros(size, np.int64)
        for batch in batches:
            for _, _, w in batch_words(batch.column(0), lower=True, limit=GRAM_SLICE):
                at, hot = places(_events(w)[1])
                table += np.bincount(at[hot], minlength=size)
                table[-1] += len(w)
        yield counter_rows(table)
    counted = sum_counters(texts.select("text").mapInArrow(count_hot, COUNTERS), size)
    total = int(counted[-1])
    hot_log = spark.sparkContext.broadcast(np.log(np.maximum(counted[:HOT_GRAMS], 1)))
    buckets = parts_for(2 * total, GRAM_BUCKET)
    schema = pa.schema([(c.split()[0], pa.int64() if c.endswith("long") else pa.binary()) for c in GRAMS.split(", ")])

    def explode(batches):
        """Packed grams for each bucket, and one row of what each document scores here, for groups of slices."""
        held, docs, size = [], 0, 0

        def deal():
            ids, n_words, own, key, d, n, extra = (np.concatenate(x) for x in zip(*held))
            held.clear()
            number = int.from_bytes(hashlib.blake2b(ids.tobytes(), digest_size=8).digest(), "little", signed=True)
            out, given = {f.name: [] for f in schema}, 0

            def put(**row):
                for name in out:
                    out[name].append(row.get(name))
            put(part=number % buckets // TASK_BUCKETS, bucket=number % buckets, slice=number, docs=ids.tobytes(), words=n_words.tobytes(), own=own.tobytes())
            order = np.argsort(key, kind="stable")
            key = key[order]
            d, n, extra = d[order], n[order], extra[order]
            bucket = _bucket(key, buckets)
            cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))[:len(key)])
            bucket = bucket[cuts]
            del order
            for own_bucket, a, b in zip(bucket.tolist(), cuts, np.append(cuts[1:], len(key))):
                put(part=own_bucket // TASK_BUCKETS, bucket=own_bucket, slice=number,
                    keys=_planes(np.diff(key[a:b], prepend=np.uint64(0))), doc=_planes(d[a:b]), n=_planes(n[a:b]), extra=_planes(extra[a:b]))
                given += 20 * int(b - a)
                if given > GIVEN_BYTES:
                    yield record_batch(schema, **out)
                    out, given = {f.name: [] for f in schema}, 0
            yield record_batch(schema, **out)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, hi, w in batch_words(batch.column(1), lower=True, limit=GRAM_SLICE):
                d, key, extra = _events(w)
                at, hot = places(key)
                n_words = np.diff(w.first)
                own = np.where(n_words > 0, -np.log(max(1, total)), 0.0)
                own += np.bincount(d[hot], _weight(key[hot], 1, extra[hot]) * hot_log.value[at[hot]], hi - lo)
                d, key, extra = d[~hot], key[~hot], extra[~hot]
                order = np.argsort(key, kind="stable")  # documents of a key are in order already
                d, key, extra = d[order], key[order], extra[order]
                del at, hot, order
                new = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (d[1:] != d[:-1])))[:len(key)])
                n = np.diff(np.append(new, len(key)))
                extra = np.add.reduceat(extra, new, dtype=np.int64) if len(new) else extra
                held.append((ids[lo:hi], n_words.astype(np.int64), own, key[new], (d[new] + docs).astype(np.uint32),
                             n.astype(np.uint32), extra.astype(np.uint32)))
                docs, size = docs + hi - lo, size + len(new)
                if size >= GROUP_GRAMS or docs >= GROUP_DOCS:
                    yield from deal()
                    docs, size = 0, 0
        if held:
            yield from deal()

    def count_bucket(packed: list[tuple]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Slice, places and sums of the documents that hold a bucket's grams; every place of these is in ``packed``."""
        keys = [np.cumsum(_unplanes(k, np.uint64), dtype=np.uint64) for _, k, _, _, _ in packed]
        sizes = [len(k) for k in keys]
        keys, counts = np.concatenate(keys), np.concatenate([_unplanes(n, np.uint32) for _, _, _, n, _ in packed])
        order = np.argsort(keys, kind="stable")
        new = keys[order]
        new = np.concatenate(([True], new[1:] != new[:-1]))
        value = np.log(np.add.reduceat(counts[order], np.flatnonzero(new), dtype=np.int64))
        of = np.empty(len(order), np.uint32)
        of[order] = np.cumsum(new, dtype=np.uint32) - np.uint32(1)
        del order, new
        at = 0
        for (number, _, doc, _, extra), size in zip(packed, sizes):
            here = slice(at, at + size)
            weight = _weight(keys[here], counts[here].astype(np.int64), _unplanes(extra, np.uint32))
            used, local = np.unique(_unplanes(doc, np.uint32), return_inverse=True)
            yield number, used, np.bincount(local, value[of[here]] * weight, len(used))
            at += size

    def _sums(rows: list[tuple]) -> pa.RecordBatch:
        """One batch for many rows: a batch of its own costs more than a row's sums."""
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)],
                                          names=["slice", "docs", "words", "sums"])

    def score(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of a part's buckets, whose rows come one bucket after another, added by document as soon as a bucket is
        counted: what is shuffled grows with the parts, not with the buckets, and one worker does both."""
        held: dict[int, list] = {}
        packed, now, size, counted_buckets = [], None, 0, set()

        def add_up():
            total = 0
            for number, parts in held.items():
                places, sums = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
                used, local = np.unique(places, return_inverse=True)
                held[number] = [(used, np.bincount(local, sums, len(used)))]
                total += len(used)
            return total

        def give():
            out, given = [], 0
            for number, [(used, sums)] in held.items():
                out.append((number, _planes(used), None, _planes(sums)))
                given += 12 * len(used)
                if given > GIVEN_BYTES:
                    yield _sums(out)
                    out, given = [], 0
            if out:
                yield _sums(out)
            held.clear()

        def count():
            nonlocal size
            for number, used, sums in count_bucket(packed) if packed else ():
                held.setdefault(number, []).append((used, sums))
                size += len(used)
            packed.clear()
            if size > HELD_SUMS:
                size = add_up()
                if size > HELD_SUMS // 2:
                    yield from give()
                    size = 0
        for batch in batches:
            own = []
            for _, bucket, number, ids, k, doc, n, extra, n_words, sums in zip(*batch.columns):
                if bucket.as_py() != now:
                    yield from count()
                    now = bucket.as_py()
                    if now in counted_buckets:
                        raise ValueError("the rows of a part are not in the order of their buckets")
                    counted_buckets.add(now)
                if k.is_valid:
                    packed.append((number.as_py(), k.as_py(), doc.as_py(), n.as_py(), extra.as_py()))
                else:
                    own.append((number.as_py(), ids.as_py(), n_words.as_py(), sums.as_py()))
            if own:
                yield _sums(own)
        yield from count()
        add_up()
        yield from give()

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Words and sums of the documents of one slice over its buckets.  The slice's own
        row has the ids, a bucket's row places in them (equal slices have equal ids)."""
        ids, n_words, places, sums = None, 0, [], []
        for batch in batches:
            for i, n, x in zip(*(batch.column(c).to_pylist() for c in ("docs", "words", "sums"))):
                if n is None:
                    places.append(_unplanes(i, np.uint32))
                    sums.append(_unplanes(x, np.float64))
                else:
                    ids, n_words = np.frombuffer(i, np.int64), n_words + np.frombuffer(n, np.int64)
                    places.append(np.arange(len(ids)))
                    sums.append(np.frombuffer(x, np.float64))
        part = np.bincount(np.concatenate(places), np.concatenate(sums), len(ids))
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n_words), pa.array(part)], names=["doc_id", "n_words", "part"])
    # twice as many tasks as parts: few tasks get several; the rows are in the order of the groups already
    parts = (texts.mapInArrow(explode, GRAMS).repartition(2 * parts_for(buckets, TASK_BUCKETS), "part")
             .sortWithinPartitions("part", "bucket").groupBy("part").applyInArrow(score, SUMS)
             .groupBy("slice").applyInArrow(add, "doc_id long, n_words long, part double"))
    return (parts.unionByName(_single_words(texts)).groupBy(F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"))
            .agg(F.sum("n_words").alias("n_words"), F.sum("part").alias("log_score"))
            .withColumn("mean_log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")).otherwise(0.0)))


def _single_words(texts: DataFrame) -> DataFrame:
    """What the only word of a text of one word scores, less ``- log N``.

    Only words whose hash is marked (by a word of such a text, in an array of fixed size) are counted."""
    def mark(batches):
        table = np.zeros(WORD_MARKS, np.int64)
        for batch in single(batches):
            table[batch.column(1).to_numpy().view(np.uint64) % np.uint64(WORD_MARKS)] = 1
        yield counter_rows(table)

    def count(batches):
        schema = pa.schema([("word", pa.int64()), ("n", pa.int64())])
        for batch in batches:
            for _, _, w in batch_words(batch.column(0), lower=True, limit=GRAM_SLICE):
                word, n = np.unique(w.hash[marked.value[w.hash % np.uint64(WORD_MARKS)]], return_counts=True)
                yield record_batch(schema, word=word.view(np.int64), n=n)

    def single(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("word", pa.int64())])
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, hi, w in batch_words(batch.column(1), lower=True, limit=GRAM_SLICE):
                one = np.flatnonzero(np.diff(w.first) == 1)
                yield record_batch(schema, doc_id=ids[lo + one], word=w.hash[w.first[one]].view(np.int64))
    short = texts.filter(F.col("text").rlike(ONE_WORD))
    singles = short.mapInArrow(single, "doc_id long, word long")
    marked = texts.sparkSession.sparkContext.broadcast(
        sum_counters(short.mapInArrow(mark, COUNTERS), WORD_MARKS) > 0)
    counts = written(texts.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")))
    return singles.join(counts, "word").select("doc_id", F.lit(0).cast("long").alias("n_words"), F.log("n").alias("part"))
