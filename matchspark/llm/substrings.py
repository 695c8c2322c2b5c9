"""Substring dedup with compressed FM-indexes (operator 10).

Every word that lies in a window of ``window`` consecutive words whose word
sequence also starts earlier (smaller doc_id, or same document and earlier
start) is removed.

1. Anchors: each window picks the smallest hash of its ``GRAM``-word sequences
   (winnowing), so equal windows pick equal anchors wherever they are.  A run
   of windows with one anchor is a segment (document, first word, windows).
2. The places of anchors are counted over all documents (map-side combined);
   segments whose anchor has one place hold no repeated window and end here.
3. The words of the other segments are dealt by anchor to shards of about equal
   size, one task each.  Anchors with more than ``ANCHOR_WORDS`` words of different segments do
   not go to a shard: their segments are cut into single windows, and the first place of
   every window is a map-side combined minimum by the hash of the whole window.  Equal
   segments (by a 128-bit hash of their words) are indexed once, with their first place: rows of a
   passage that many documents share are combined before the shuffle.
4. Each shard builds an FM-index of its segments: Burrows-Wheeler transform
   over word codes, kept as a wavelet tree of packed bits with sampled ranks, and the least
   place of every group of suffixes with one window; the suffix array is dropped.
   All segments are streamed through backward search at once; the group in which a
   window matches gives the earliest occurrence of that window in the corpus, as every
   occurrence is in this shard.
5. For each place of a segment, windows with an earlier occurrence give the
   intervals to remove; they are merged per document.

Defined results: null texts have no words; documents of fewer words than a
window keep all, and so do rows without a doc_id, which take nothing from others either; rows that
repeat a doc_id with another text are documents of their own, ordered by a hash of the text; rows equal
in doc_id and text are one document and get one result each; an empty table gives an empty result;
other input columns are ignored; texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchspark.llm.common import is_marked, marked_keys, materialize, parts_for, record_batch, written
from matchspark.llm.words import SPACES, Words, batch_words, grams, mix, slices
from matchspark.session import broadcast_if_small

WINDOW, GRAM = 20, 4
#: Words of one FM-index, about; longer segments are cut at this many windows.
SHARD_WORDS = 1_000_000
SEGMENT_WINDOWS = 64
#: Words of one anchor in a shard.
ANCHOR_WORDS = 250_000
RANK_STEP = 64
#: Segments streamed through an index at once.
LANES = 1 << 16


def _sliding_min(g: np.ndarray, size: int) -> np.ndarray:
    """Minimum of every ``size`` neighbours, by doubling."""
    width, out = 1, g
    while 2 * width <= size:
        out = np.minimum(out[:-width], out[width:])
        width *= 2
    rest = size - width
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def anchor_segments(w: Words, window: int, gram: int):
    """Runs of windows with equal anchors: (anchor, document, first word in the
    document, windows, places of the anchor), for all documents of a slice at once."""
    empty = np.empty(0, np.int64)
    if len(w) < window:
        return empty, empty, empty, empty, empty
    g = grams(w.hash, gram)
    least = _sliding_min(g, window - gram + 1)
    doc = w.doc_of_word()
    at = np.flatnonzero(doc[:len(least)] == doc[window - 1:])
    if not len(at):
        return empty, empty, empty, empty, empty
    least, d = least[at], doc[at]
    new = np.concatenate(([True], (least[1:] != least[:-1]) | (d[1:] != d[:-1])))
    cut = np.flatnonzero(new)
    size = np.diff(np.append(cut, len(at)))
    # long runs (one word over and over) are cut
    more = -(-size // SEGMENT_WINDOWS)
    k = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more)
    first = np.repeat(cut, more) + k * SEGMENT_WINDOWS
    size = np.minimum(SEGMENT_WINDOWS, np.repeat(cut + size, more) - first)
    anchor, begin = least[first], at[first]
    # places of the anchor in its segment: with two or more, the segment may repeat a window itself
    width = window - gram + 1
    places = np.zeros(len(first), np.int32)
    for k in range(width):
        places += g[begin + k] == anchor
    live = np.arange(len(first))
    for k in range(1, SEGMENT_WINDOWS):
        live = live[size[live] > k]
        if not len(live):
            break
        places[live] += g[begin[live] + k + width - 1] == anchor[live]
    return anchor.view(np.int64), d[first], begin - w.first[d[first]], size, places


# --- the index -----------------------------------------------------------------

class BitRank:
    """Packed bits with ones counted before every block of 64."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros((n // RANK_STEP + 1) * RANK_STEP, bool)
        padded[:n] = bits
        self.blocks = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.blocks), dtype=np.int32)))[:-1].astype(np.int32)

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Set bits among the first ``at``."""
        block = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.blocks[block] & mask)


class WaveletTree:
    """Rank over a sequence of codes, one bit level at a time (matrix layout)."""

    def __init__(self, codes: np.ndarray, bits: int):
        self.levels = []
        every = np.arange(1 << bits)
        # where the occurrences of each code begin on the last level
        self.start = np.zeros(1 << bits, np.int64)
        for b in range(bits - 1, -1, -1):
            bit = (codes >> b & 1).astype(bool)
            rank, zeros = BitRank(bit), int((~bit).sum())
            self.levels.append((b, rank, zeros))
            ones = rank.ones(self.start)
            self.start = np.where(every >> b & 1, zeros + ones, self.start - ones)
            codes = np.concatenate((codes[~bit], codes[bit]))

    def rank(self, code: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of each code before positions lo and hi."""
        at = np.concatenate((lo, hi))
        code = np.concatenate((code, code))
        for b, bits, zeros in self.levels:
            ones = bits.ones(at)
            at = np.where(code >> b & 1, zeros + ones, at - ones)
        at -= self.start[code]
        return at[:len(lo)], at[len(lo):]


class FMIndex:
    """Compressed index of word codes in which 0 ends a segment: the wavelet tree of the
    Burrows-Wheeler transform, the first position of every code, and for every group of
    suffixes that agree in their first ``depth`` words its range and least place.

    Suffixes are sorted by exactly ``depth`` words: doubling up to a power of two, then
    two overlapping halves.  The suffix array itself is not kept."""

    def __init__(self, codes: np.ndarray, depth: int, place: np.ndarray):
        n, size = len(codes), int(codes.max()) + 1
        rank, width = codes.astype(np.int64), 1

        def combine(rank, step):
            pair = rank * (n + size + 1)
            pair[:n - step] += rank[step:] + 1
            order = np.argsort(pair)
            pair = pair[order]
            new = np.concatenate(([0], np.cumsum(pair[1:] != pair[:-1])))
            rank[order] = new
            return rank, order
        while 2 * width <= depth:
            rank, order = combine(rank, width)
            width *= 2
        rank, order = combine(rank, depth - width)
        self.group = rank[order].astype(np.int32)
        self.first = np.append(np.flatnonzero(np.diff(self.group, prepend=-1)), n).astype(np.int32)
        self.least = np.minimum.reduceat(place[order], self.first[:-1])
        self.tree = WaveletTree(codes[order - 1], max(1, int(size - 1).bit_length()))
        self.before = np.concatenate(([0], np.cumsum(np.bincount(codes, minlength=size))))

    def extend(self, code: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: intervals of the matches with one more word in front."""
        a, b = self.tree.rank(code, lo, hi)
        return self.before[code] + a, self.before[code] + b

    def widen(self, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Groups of ``depth`` words in which matches lie, and their intervals."""
        group = self.group[lo]
        return group, self.first[group].astype(np.int64), self.first[group + 1].astype(np.int64)


def joined_codes(codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of consecutive segments with a 0 after each, and where each segment begins."""
    at = np.cumsum(lengths + 1) - lengths - 1
    out = np.zeros(int(lengths.sum()) + len(lengths), np.int64)
    out[np.arange(len(codes)) + np.repeat(np.arange(len(lengths)), lengths)] = codes
    return out, at


def earliest(codes: np.ndarray, lengths: np.ndarray, places: list[np.ndarray], starts: np.ndarray, window: int) -> np.ndarray:
    """For every window of every segment (in order), the position in the joined codes of its first
    occurrence among all segments.  ``places`` (major key first) and ``starts`` are the first place of each segment."""
    text, at = joined_codes(codes, lengths)
    owner = np.repeat(np.arange(len(lengths)), lengths + 1)
    start = starts[owner] + np.arange(len(owner)) - at[owner]
    by_place = np.lexsort((start, *(p[owner] for p in reversed(places))))
    place = np.empty(len(owner), np.int64)
    place[by_place] = np.arange(len(owner))
    index = FMIndex(text, window, place)
    n_windows = lengths - window + 1
    slot = np.cumsum(n_windows) - n_windows
    out = np.empty(n_windows.sum(), np.int64)
    # all segments are streamed backwards together, longest first
    lane = np.argsort(-lengths, kind="stable")
    for block in range(0, len(lane), LANES):
        x = lane[block:block + LANES]
        lo, hi = np.zeros(len(x), np.int64), np.full(len(x), len(owner))
        for step in range(1, int(lengths[x[0]]) + 1):
            x = x[:np.searchsorted(-lengths[x], -step, "right")]
            lo, hi = index.extend(text[at[x] + lengths[x] - step], lo[:len(x)], hi[:len(x)])
            if step >= window:
                group, lo, hi = index.widen(lo)
                out[slot[x] + lengths[x] - step] = index.least[group]
    return by_place[out]


# --- the job -------------------------------------------------------------------

SEGMENT = "anchor long, doc_id long, key long, start int, windows int, content binary, words binary"
RUNS = "content binary, runs array<struct<j:int,n:int,doc:long,key:long,start:long>>"
RUN_TYPE = pa.list_(pa.struct([("j", pa.int32()), ("n", pa.int32()), ("doc", pa.int64()), ("key", pa.int64()), ("start", pa.int64())]))
#: Two odd multipliers for the hash of a word sequence, with their inverses modulo 2^64.
_MULTS = [(np.uint64(m), np.uint64(pow(m, -1, 1 << 64))) for m in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def sequence_hashes(h: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """128-bit hashes (two columns) of the word sequences begin..end-1, from running sums."""
    out = []
    for k, (mult, inverse) in enumerate(_MULTS):
        powers = np.ones((2, len(h) + 1), np.uint64)
        powers[0, 1:], powers[1, 1:] = mult, inverse
        powers = np.cumprod(powers, axis=1, dtype=np.uint64)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(h + np.uint64(k)) * powers[1, :-1], dtype=np.uint64)))
        out.append(mix((sums[end] - sums[begin]) * powers[0, end] + (end - begin).astype(np.uint64)))
    return np.stack(out, axis=1)


def _binary(data: np.ndarray, offsets: np.ndarray, null: np.ndarray | None = None) -> pa.Array:
    valid = None if null is None else pa.py_buffer(np.packbits(~null, bitorder="little").tobytes())
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [
        valid, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())


def _digests(hashes: np.ndarray) -> pa.Array:
    return _binary(hashes.view(np.uint8).ravel(), np.arange(len(hashes) + 1) * 16)


def _rows_of(batches: Iterator[pa.RecordBatch], names: list[str]) -> dict[str, pa.Array]:
    table = pa.Table.from_batches(list(batches))
    return {n: (c.combine_chunks() if (c := table[n]).num_chunks != 1 else c.chunk(0)) for n in names}


def _first_rows(hashes: np.ndarray, *order: np.ndarray) -> np.ndarray:
    """Row of each different hash that comes first by ``order`` (major key first)."""
    rows = np.lexsort((*reversed(order), hashes[:, 1], hashes[:, 0]))
    h = hashes[rows]
    return rows[np.concatenate(([True], (h[1:] != h[:-1]).any(axis=1)))[:len(rows)]]


def _hashes(content: pa.Array) -> np.ndarray:
    """Rows of 16 bytes as pairs of numbers."""
    offset = np.frombuffer(content.buffers()[1], np.int32)[content.offset]
    return np.frombuffer(content.buffers()[2], np.uint8)[offset:offset + 16 * len(content)].copy().view(np.uint64).reshape(-1, 2)


def _anchors(texts: DataFrame, window: int, gram: int, marked=None) -> DataFrame:
    """One row per segment; with ``marked`` only of anchors whose bit is set."""
    def run(batches):
        bits = None if marked is None else np.frombuffer(marked.value, np.uint8)
        schema = pa.schema([("anchor", pa.int64()), ("key", pa.int64()), ("start", pa.int32()), ("windows", pa.int32()), ("places", pa.int32())])
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, _, w in batch_words(batch.column(1)):
                anchor, doc, start, size, places = found = anchor_segments(w, window, gram)
                if bits is not None:
                    keep = is_marked(bits, anchor.view(np.uint64))
                    anchor, doc, start, size, places = (x[keep] for x in found)
                yield record_batch(schema, anchor=anchor, key=keys[lo + doc] if len(doc) else doc,
                                   start=start.astype(np.int32), windows=size.astype(np.int32), places=places.astype(np.int32))
    return texts.select("key", "text").mapInArrow(run, "anchor long, key long, start int, windows int, places int")


def _segments(texts: DataFrame, window: int) -> DataFrame:
    """Rows (doc_id, key, text, spans) -> one row per segment; its words (the bytes from the first to the
    last one) only where the task's slice has not given the same segment before."""
    schema = pa.schema([("anchor", pa.int64()), ("doc_id", pa.int64()), ("key", pa.int64()), ("start", pa.int32()), ("windows", pa.int32()),
                        ("content", pa.binary()), ("words", pa.binary())])

    def run(batches):
        for batch in batches:
            ids, keys = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
            for lo, hi, w in batch_words(batch.column(2)):
                spans = batch.column(3).slice(lo, hi - lo)
                each = np.diff(spans.offsets.to_numpy())
                flat = spans.flatten()
                anchor, start, windows = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))
                row = np.repeat(np.arange(hi - lo), each)
                begin = w.first[row] + start
                end = np.minimum(begin + windows + window - 1, w.first[row + 1])
                hashes = sequence_hashes(w.hash, begin, end)
                doc, key = ids[lo + row], keys[lo + row]
                # the row with the words has the first place of its segment in this slice
                bare = np.zeros(len(row), bool)
                bare[_first_rows(hashes, doc, key, start)] = True
                size = np.where(bare, w.end[end - 1] - w.start[begin], 0)
                offsets = np.concatenate(([0], np.cumsum(size)))
                data = w.buf[np.arange(offsets[-1]) + np.repeat(w.start[begin] - offsets[:-1], size)]
                yield record_batch(schema, anchor=anchor, doc_id=doc, key=key, start=start.astype(np.int32), windows=windows.astype(np.int32),
                                   content=_digests(hashes), words=_binary(data, offsets, ~bare))
    return texts.mapInArrow(run, SEGMENT)


def _index_shard(window: int):
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _rows_of(batches, ["content", "doc_id", "key", "start", "words"])
        hashes = _hashes(rows["content"])
        doc, part, start = (rows[n].to_numpy(zero_copy_only=False).astype(np.int64) for n in ("doc_id", "key", "start"))
        one = _first_rows(hashes, doc, part, start)
        hashes, doc, part, start = hashes[one], doc[one], part[one], start[one]
        words = rows["words"].take(pa.array(one))
        del rows
        offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
        w = Words(np.frombuffer(words.buffers()[2], np.uint8), offsets, SPACES, False)
        codes = np.unique(w.hash, return_inverse=True)[1] + 1
        lengths = np.diff(w.first)
        del w, words
        first = earliest(codes, lengths, [doc, part], start, window)
        owner = np.repeat(np.arange(len(lengths)), lengths + 1)
        at = np.cumsum(lengths + 1) - lengths - 1
        d = owner[first]                                  # segment of the first occurrence
        s = start[d] + first - at[d]
        n_windows = lengths - window + 1
        mine = np.repeat(np.arange(len(lengths)), n_windows)
        j = np.arange(len(mine)) - (np.cumsum(n_windows) - n_windows)[mine]
        cut = np.flatnonzero(np.concatenate(([True], (mine[1:] != mine[:-1]) | (doc[d][1:] != doc[d][:-1]) | (part[d][1:] != part[d][:-1])
                                             | (s[1:] != s[:-1] + 1))))
        size = np.diff(np.append(cut, len(mine)))
        values = pa.StructArray.from_arrays(
            [pa.array(j[cut], pa.int32()), pa.array(size, pa.int32()), pa.array(doc[d[cut]]), pa.array(part[d[cut]]), pa.array(s[cut])],
            fields=list(RUN_TYPE.value_type))
        bounds = np.searchsorted(mine[cut], np.arange(len(lengths) + 1)).astype(np.int32)
        runs = pa.ListArray.from_arrays(pa.array(bounds), values)
        content = _digests(hashes)
        for k in range(0, len(content), 10_000):
            yield pa.RecordBatch.from_arrays([content.slice(k, 10_000), runs.slice(k, 10_000)], names=["content", "runs"])
    return run


def _window_runs(bare: DataFrame, window: int) -> DataFrame:
    """(content, j, doc, other, first): the first place of window j of every segment, without a shard."""
    schema = pa.schema([("window", pa.binary()), ("content", pa.binary()), ("j", pa.int32()), ("doc", pa.int64()), ("other", pa.int64()),
                        ("start", pa.int64())])

    def split(batches):
        for batch in batches:
            doc, key, start = (batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("doc_id", "key", "start"))
            words = batch.column("words")
            offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
            w = Words(np.frombuffer(words.buffers()[2], np.uint8), offsets, SPACES, False)
            each = np.diff(w.first) - window + 1
            row = np.repeat(np.arange(len(each)), each)
            j = np.arange(len(row)) - (np.cumsum(each) - each)[row]
            begin = w.first[row] + j
            yield record_batch(schema, window=_digests(sequence_hashes(w.hash, begin, begin + window)),
                               content=batch.column("content").take(pa.array(row)), j=j.astype(np.int32), doc=doc[row], other=key[row],
                               start=start[row] + j)
    cut = written(bare.select("content", "doc_id", "key", "start", "words").mapInArrow(
        split, "window binary, content binary, j int, doc long, other long, start long"))
    first = cut.groupBy("window").agg(F.min(F.struct("doc", "other", "start")).alias("p"))
    return (cut.select("window", "content", "j").distinct().join(first, "window")
            .select("content", "j", F.col("p.doc").alias("doc"), F.col("p.other").alias("other"), F.col("p.start").alias("first")))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, key, text``: rows of one id and text have one key, the same in every scan."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text")


def repeated_spans(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``key, start, words``: word intervals made of windows that also start earlier."""
    gram = min(GRAM, window)
    texts = _keyed(docs, id_col, text_col).filter("doc_id is not null")
    shared = materialize(_anchors(texts, window, gram).groupBy("anchor").agg(F.sum("places").alias("n"))
                         .filter("n > 1").select("anchor"))
    # most anchors have one place and end here, before a shuffle; the join below is exact
    anchors = _anchors(texts, window, gram, marked_keys(shared))
    # a set: rows equal in id and text give each segment twice
    spans = (anchors.join(shared, "anchor", "left_semi").groupBy("key")
             .agg(F.collect_set(F.struct("anchor", "start", "windows")).alias("spans")))
    segments = written(_segments(texts.join(spans, "key").select("doc_id", "key", "text", "spans"), window), "zstd")
    bare = segments.filter("words is not null")
    size = F.sum(F.col("windows") + window - 1)
    total = bare.agg(size).first()[0]
    hot = materialize(bare.groupBy("anchor").agg(size.alias("n")).filter(F.col("n") > ANCHOR_WORDS).select("anchor"))
    any_hot = bool(hot.limit(1).count())
    cold = bare.join(broadcast_if_small(hot), "anchor", "left_anti") if any_hot else bare
    shards = parts_for(total, SHARD_WORDS)
    shard = F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard")
    runs = (cold.select(shard, "content", "doc_id", "key", "start", "words").repartition(shards, "shard")
            .groupBy("shard").applyInArrow(_index_shard(window), RUNS))
    earlier = lambda doc, key, start, own: (
        (F.col(doc) < F.col("doc_id")) | ((F.col(doc) == F.col("doc_id")) & (
            (F.col(key) < F.col("key")) | ((F.col(key) == F.col("key")) & (F.col(start) < own)))))
    found = (segments.select("doc_id", "key", "start", "content").join(runs, "content")
             .select("doc_id", "key", "start", F.explode("runs").alias("r"))
             .filter(earlier("r.doc", "r.key", "r.start", F.col("start") + F.col("r.j"))))
    out = found.select("key", (F.col("start") + F.col("r.j")).alias("start"),
                       (F.col("r.n") + (window - 1)).alias("words"))
    if any_hot:
        warm = segments.join(broadcast_if_small(hot), "anchor", "left_semi")
        single = (warm.select("doc_id", "key", F.col("start").alias("at"), "content")
                  .join(_window_runs(warm.filter("words is not null"), window), "content")
                  .filter(earlier("doc", "other", "first", F.col("at") + F.col("j"))))
        out = out.unionByName(single.select("key", (F.col("at") + F.col("j")).alias("start"), F.lit(window).alias("words")))
    return out


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document row: ``doc_id, n_words, n_removed, kept`` (the kept words joined by one blank)."""
    spans = (repeated_spans(docs, window, id_col, text_col).groupBy("key")
             .agg(F.collect_set(F.struct("start", "words")).alias("spans")))
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    def run(batches):
        for batch in batches:
            for lo, hi, _, _ in slices(batch.column(1)):
                part = batch.slice(lo, hi - lo)
                n, gone, kept = [], [], []
                for text, spans in zip(part.column(1).to_pylist(), part.column(2)):
                    words = (text or "").encode().split()
                    n.append(len(words))
                    if spans.is_valid:
                        flat = spans.values
                        start, size = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
                        edge = np.bincount(start, minlength=len(words) + 1) - np.bincount(start + size, minlength=len(words) + 1)
                        free = np.cumsum(edge)[:-1] == 0
                        words = [w for w, f in zip(words, free.tolist()) if f]
                    gone.append(n[-1] - len(words))
                    kept.append(b" ".join(words).decode())
                yield record_batch(schema, doc_id=part.column(0), n_words=n, n_removed=gone, kept=kept)
    return _keyed(docs, id_col, text_col).join(spans, "key", "left").select("doc_id", "text", "spans").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept string")
