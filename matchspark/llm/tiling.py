"""Benchmark decontamination by greedy string tiling (operator 8).

Seeds are the ``min_match``-word sequences of the benchmark; documents that
share a seed with an item are tiled against it: the longest common word
sequences are marked first, never overlapping earlier marks, down to
``min_match`` words.  Window equality is tested with running Karp-Rabin
fingerprints.  As tiles may lie in any order, a reordered passage reaches
the same coverage as a verbatim one.  Coverage is the share of an item's
words that are marked.

The benchmark is read in blocks of bounded size, each broadcast to one pass
over the documents, so that its size has no limit; documents are never
shuffled, only their findings are.

Words are runs of letters and digits (and non-ASCII characters), A-Z in lower
case.  Defined results: null or empty texts have coverage 0; items of fewer
than ``min_match`` words match nothing; an empty benchmark leaves every
document clean; repeated doc_ids are reported once, with the findings of all
their rows; equal items are each reported; other input columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchspark.llm.common import parts_for, record_batch
from matchspark.llm.words import _MULT, NON_ALNUM, Words, batch_words, grams

MIN_MATCH = 5
COVERAGE = 0.5
#: Benchmark bytes in one broadcast block, about (items are not cut).
BLOCK_BYTES = 8 << 20
FILTER_BITS = 22
FOUND = ("doc_id long, item_id long, item_words long, covered long, "
         "tiles array<struct<doc_word:long,item_word:long,words:long>>")


class _Fingerprints:
    """Karp-Rabin fingerprints of any window of a word sequence."""

    def __init__(self, h: np.ndarray, powers: np.ndarray):
        # prefix[i] = sum of h[k] * m**k; a window's sum is shifted to a common power
        self.powers = powers
        self.prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * powers[:len(h)], dtype=np.uint64)))

    def windows(self, at: np.ndarray, size: int) -> np.ndarray:
        return (self.prefix[at + size] - self.prefix[at]) * self.powers[len(self.powers) - 1 - at]


def _runs_of(mask: np.ndarray) -> np.ndarray:
    """For each position, how many set positions follow in a row (itself included)."""
    stop = np.concatenate((np.flatnonzero(~mask), [len(mask)]))
    at = np.arange(len(mask))
    return stop[np.searchsorted(stop, at)] - at


def tiles(doc: np.ndarray, item: np.ndarray, doc_seeds: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (doc word, item word, length) of two word-hash sequences;
    ``doc_seeds`` are the document positions where a common seed starts."""
    n = max(len(doc), len(item))
    powers = np.full(n + 1, _MULT, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    free_doc = np.zeros(len(doc), bool)
    for j in range(min_match):
        free_doc[doc_seeds + j] = True
    free_item = np.ones(len(item), bool)
    a, b = _Fingerprints(doc, powers), _Fingerprints(item, powers)
    out = []
    size = min(int(_runs_of(free_doc).max(initial=0)), len(item))
    while size >= min_match:
        x = np.flatnonzero(_runs_of(free_doc) >= size)
        y = np.flatnonzero(_runs_of(free_item) >= size)
        if not len(x) or not len(y):
            size -= 1
            continue
        hx, hy = a.windows(x, size), b.windows(y, size)
        common = np.isin(hx, hy)
        places: dict[int, list[int]] = {}
        for h, j in zip(hy.tolist(), y.tolist()):
            places.setdefault(h, []).append(j)
        for i, h in zip(x[common].tolist(), hx[common].tolist()):
            if not free_doc[i:i + size].all():
                continue
            for j in places[h]:
                if free_item[j:j + size].all() and np.array_equal(doc[i:i + size], item[j:j + size]):
                    free_doc[i:i + size] = False
                    free_item[j:j + size] = False
                    out.append((i, j, size))
                    break
        size -= 1
    return out


class _Block:
    """Some benchmark items: word hashes and a seed table."""

    def __init__(self, rows: list[tuple[int, str]], min_match: int):
        w = next(iter(batch_words(pa.array([t for _, t in rows], pa.large_string()), NON_ALNUM, True, 1 << 62)))[2]
        self.ids = [i for i, _ in rows]
        self.items = [w.hash[w.first[k]:w.first[k + 1]] for k in range(len(rows))]
        seeds = [grams(x, min_match) for x in self.items]
        owner = np.repeat(np.arange(len(rows)), [len(x) for x in seeds])
        seeds = np.concatenate([*seeds, np.empty(0, np.uint64)])
        # one row per (seed, item)
        order = np.lexsort((owner, seeds))
        seeds, owner = seeds[order], owner[order]
        new = np.ones(len(seeds), bool)
        new[1:] = (seeds[1:] != seeds[:-1]) | (owner[1:] != owner[:-1])
        self.seeds, self.owner = seeds[new], owner[new]

    def hits(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, item) of every window hash that is a seed of the item."""
        if not hasattr(self, "filter"):
            self.filter = np.zeros(1 << FILTER_BITS, bool)
            self.filter[self.seeds >> np.uint64(64 - FILTER_BITS)] = True
        at = np.flatnonzero(self.filter[h >> np.uint64(64 - FILTER_BITS)])
        lo, hi = np.searchsorted(self.seeds, h[at], "left"), np.searchsorted(self.seeds, h[at], "right")
        n = hi - lo
        pos = np.repeat(at, n)
        within = np.arange(len(pos)) - np.repeat(np.cumsum(n) - n, n)
        return pos, self.owner[np.repeat(lo, n) + within]


def _findings(w: Words, block: _Block, min_match: int):
    """(document, item, covered words, tiles) for every pair with a common seed."""
    h = grams(w.hash, min_match)
    if not len(h):
        return
    pos, item = block.hits(h)
    doc = np.searchsorted(w.first, pos, "right") - 1
    inside = pos + min_match <= w.first[doc + 1]
    pos, item, doc = pos[inside], item[inside], doc[inside]
    order = np.lexsort((pos, item, doc))
    pos, item, doc = pos[order], item[order], doc[order]
    new = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])))) if len(pos) else []
    for a, b in zip(new, [*new[1:], len(pos)]):
        d, i = int(doc[a]), int(item[a])
        first = int(w.first[d])
        found = tiles(w.hash[first:w.first[d + 1]], block.items[i], pos[a:b] - first, min_match)
        if found:
            yield d, i, sum(t[2] for t in found), found


def overlaps(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, id_col: str = "doc_id",
             text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document and benchmark item that share at least one tile:
    ``doc_id, item_id, item_words, covered, tiles``; and one row with a null
    item per document row, so that every document is present."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"),
                             F.coalesce(item_text, F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = parts_for(size, BLOCK_BYTES)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("item_words", pa.int64()),
                        ("covered", pa.int64()), ("tiles", pa.list_(pa.struct(
                            [("doc_word", pa.int64()), ("item_word", pa.int64()), ("words", pa.int64())])))])
    out = texts.select("doc_id", F.lit(None).cast("long").alias("item_id"), F.lit(0).cast("long").alias("item_words"),
                       F.lit(0).cast("long").alias("covered"),
                       F.lit(None).cast("array<struct<doc_word:long,item_word:long,words:long>>").alias("tiles"))
    for k in range(n_blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == k).collect()
        if not rows:
            continue
        shared = spark.sparkContext.broadcast(_Block([(r.item_id, r.text) for r in rows], min_match))

        def run(batches, shared=shared):
            block = shared.value
            for batch in batches:
                ids = batch.column(0).to_pylist()
                for lo, _, w in batch_words(batch.column(1), NON_ALNUM, True):
                    found = [(ids[lo + d], block.ids[i], len(block.items[i]), n,
                              [dict(zip(("doc_word", "item_word", "words"), t)) for t in ts])
                             for d, i, n, ts in _findings(w, block, min_match)]
                    yield record_batch(schema, **dict(zip(schema.names, zip(*found) if found else [[]] * 5)))
        out = out.unionByName(texts.mapInArrow(run, FOUND))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH,
                  coverage: float = COVERAGE) -> DataFrame:
    """One row per doc_id: ``doc_id, contaminated, coverage`` (of the best item),
    ``item_ids`` (sorted, those covered enough) and ``n_tiles`` of these."""
    share = F.when(F.col("item_words") > 0, F.col("covered") / F.col("item_words")).otherwise(0.0)
    hit = F.col("share") >= coverage
    return (overlaps(docs, benchmark, min_match).withColumn("share", share)
            .groupBy("doc_id").agg(
                F.max("share").alias("coverage"),
                F.array_sort(F.collect_set(F.when(hit & F.col("item_id").isNotNull(), F.col("item_id")))).alias("item_ids"),
                F.coalesce(F.sum(F.when(hit, F.size("tiles"))), F.lit(0)).alias("n_tiles"))
            .select("doc_id", (F.size("item_ids") > 0).alias("contaminated"), "coverage", "item_ids", "n_tiles"))
