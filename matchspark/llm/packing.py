"""Best-fit packing by length-histogram planning (operator 5).

Documents become token pieces of at most ``max_len`` ids; the plan is made
over the histogram of piece lengths (at most ``max_len`` rows, whatever the
corpus size) and pieces then take planned slots by joining on their rank
within their length.

Defined results: a null text counts as empty and becomes the one piece
``[end_id]``; repeated rows are packed once each; an empty table gives an
empty result; further input columns are ignored; a text of any length is
tokenised whole; which of several pieces of equal length takes which slot
is arbitrary but fixed.
"""

from __future__ import annotations

import os
import re
from bisect import bisect_left, insort
from collections import defaultdict, deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchspark.llm.common import materialize, parts_for, record_batch
from matchspark.llm.words import mix, slices

PIECES = "doc_id long, row long, piece int, start long, length long, ids binary"
#: Chunks tokenised as a whole, and half as many again words of them, whose ids are kept per Python worker (a table starts
#: anew beyond it); the table of plain pieces has four to eight places for each.
KEPT = 400_000
#: A chunk longer than this is tokenised without being kept.
CHUNK_CHARS = 64
#: Plain words that one call of the tokenizer takes.
JOINED = 2000
#: A chunk that is a word of ASCII and Latin-1 letters and a tail of ASCII signs (no apostrophe).
PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\\[-`{-~]*)").fullmatch
#: Bytes and ids of a plain piece that its table can hold.
PIECE_BYTES, PIECE_IDS = 16, 8
#: Bytes of text tokenised together (a longer text by itself).
SLICE = 1 << 20
#: Pieces that one window over (length, bucket) ranks, about.
RANKED = 500_000
#: A plan of more rows than this is joined without a broadcast.
PLAN_ROWS = 200_000


class _ChunkIds(dict):
    """Little-endian ids of white-space-free chunks, filled by need.

    The tokenizer never merges across white space, so the ids of a text are
    the ids of its chunks in order.  It splits letters from signs and lowers
    case first, so a plain chunk is its lower-cased word and its tail; the new
    words of a batch are tokenised as one text and cut after every token that
    ends a word.  ``kept`` bounds the tables, about 180 bytes an entry."""

    kept = KEPT

    def __init__(self, path: str):
        from tokenizers import Tokenizer   # needed where texts are tokenised, not where a query is registered
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.words: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        for at in range(0, len(words), JOINED):
            part = words[at:at + JOINED]
            ids = self._encode([" ".join(part)])[0]
            cuts = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(cuts) != len(part):
                raise ValueError("the tokenizer does not mark word ends")
            data = ids.tobytes()
            self.words.update(zip(part, [data[a:b] for a, b in zip([0, *cuts], cuts)]))

    def fill(self, chunks: set[str]) -> dict[str, bytes]:
        """Ids of every given chunk (long ones are returned, not kept)."""
        if len(self) > self.kept:
            self.clear()
        if len(self.words) > self.kept * 3 // 2:
            self.words.clear()
        plain, other = [], []
        for c in chunks.difference(self):
            m = PLAIN(c) if len(c) <= CHUNK_CHARS else None
            if m:
                plain.append((c, m[1].lower(), m[2]))
            else:
                other.append(c)
        known = self.words
        self._learn(list({w for _, w, _ in plain if w not in known}))
        tails = list({t for _, _, t in plain if t and t not in known})
        known.update(zip(tails, [x.tobytes() for x in self._encode(tails)]))
        for c, word, tail in plain:
            self[c] = known[word] + known[tail] if tail else known[word]
        long = {}
        for at in range(0, len(other), 20_000):
            part = other[at:at + 20_000]
            for c, ids in zip(part, self._encode(part)):
                (long if len(c) > CHUNK_CHARS else self)[c] = ids.tobytes()
        return long


#: Classes of bytes: white space between chunks, letters, digits, signs, all else (whose chunk is tokenised as a whole).
GAP, LETTER, DIGIT, SIGN, ODD = range(5)
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


class _PieceIds:
    """Ids of the texts of an Arrow slice, by array operations over its bytes.

    The tokenizer lowers case and splits chunks into runs of letters, single digits and
    runs of signs, each tokenised by itself.  Where a chunk has only ASCII (no apostrophe, no
    first sign of a special token) and Latin-1 letters, these pieces follow from the classes of
    its bytes; a piece's bytes are its exact key in a table of fixed size, in which a new
    piece takes the place of an old one.  Other chunks and long pieces go through ``_ChunkIds``."""

    def __init__(self, chunks: _ChunkIds):
        self.chunks, self.kept = chunks, 0
        kind = np.full(256, ODD, np.uint8)
        kind[0x21:0x7F] = SIGN
        kind[[0x20, 9, 10, 13]] = GAP
        kind[[*range(65, 91), *range(97, 123)]] = LETTER
        kind[0x30:0x3A] = DIGIT
        kind[[ord("'"), *(t.content.encode()[0] for t in chunks.tokenizer.get_added_tokens_decoder().values())]] = ODD
        self.kind = kind
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32

    def keep(self, kept: int) -> None:
        """A table of four to eight places for each of ``kept`` entries (33 bytes a place)."""
        if kept == self.kept:
            return
        bits = (4 * kept).bit_length()
        self.kept, self.shift = kept, np.uint64(64 - bits)
        self.key = np.zeros((1 << bits, 2), np.uint64)
        self.size = np.zeros(1 << bits, np.uint8)
        self.ids = np.zeros((1 << bits, PIECE_IDS), "<u2" if len(self.chunks.ends) <= 1 << 16 else "<u4")

    def _bytes(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class and lower case of every byte (both bytes of a Latin-1 letter are a letter's)."""
        kind, low = self.kind[raw], np.zeros(len(raw) + PIECE_BYTES, np.uint8)
        low[:len(raw)] = self.lower[raw]
        at = np.flatnonzero(raw == 0xC3) + 1
        v = raw[at]
        letter = (v != 0x97) & (v != 0xB7)
        kind[at[letter]] = kind[at[letter] - 1] = LETTER
        low[at[letter & (v < 0x9F)]] += 32
        return kind, low

    def _odd_chunks(self, kind: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First byte and end of every chunk with an odd byte; its bytes become a gap."""
        odd = np.flatnonzero(kind == ODD)
        if not len(odd):
            return odd, odd
        cuts = np.union1d(np.flatnonzero(kind == GAP), offs)   # a gap's byte, or a text's end, that is the next one's first byte
        first = cuts[np.searchsorted(cuts, odd, "right") - 1]
        first = np.unique(first + (kind[first] == GAP))
        end = cuts[np.searchsorted(cuts, first, "right")]
        step = np.zeros(len(kind) + 1, np.int8)
        step[first] += 1
        step[end] -= 1
        kind[np.cumsum(step[:-1], dtype=np.int8).astype(bool)] = GAP
        return first, end

    def _learn(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for distinct pieces."""
        words = np.ascontiguousarray(key).view(f"S{PIECE_BYTES}").ravel().tolist()
        ids, sizes = [], []
        for at in range(0, len(words), JOINED):
            part = words[at:at + JOINED]
            found = self.chunks._encode([b" ".join(part).decode()])[0]
            ends = np.flatnonzero(self.chunks.ends[found])
            if len(ends) != len(part):
                raise ValueError("the tokenizer does not mark word ends")
            ids.append(found)
            sizes.append(np.diff(ends, prepend=-1))
        return np.concatenate(ids), np.concatenate(sizes)

    def _plain(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict[int, np.ndarray]]:
        """Ids of pieces in rows, their number, and the ids of those that need more than a row (number 0)."""
        place = (mix(key[:, 0] + mix(key[:, 1])) >> self.shift).astype(np.int64)
        rows, size = self.ids[place], self.size[place].astype(np.int64)
        miss = np.flatnonzero((self.key[place] != key).any(1))
        if not len(miss):
            return rows, size, {}
        order = miss[np.lexsort((key[miss, 1], key[miss, 0]))]
        new = np.concatenate(([True], (key[order[1:]] != key[order[:-1]]).any(1)))
        first, of = order[new], np.cumsum(new) - 1
        ids, n = self._learn(key[first])
        start = np.cumsum(n) - n
        short = n <= PIECE_IDS
        some = np.repeat(short, n)
        learnt = np.zeros((len(n), PIECE_IDS), rows.dtype)
        learnt[np.repeat(np.arange(len(n)), n)[some], (np.arange(len(ids)) - np.repeat(start, n))[some]] = ids[some]
        rows[order], size[order] = learnt[of], np.where(short, n, 0)[of]
        put = first[short]
        # of several new pieces with one place, the last one stays, with its key
        place, last = np.unique(place[put][::-1], return_index=True)
        last = len(put) - 1 - last
        self.key[place], self.ids[place], self.size[place] = key[put[last]], learnt[short][last], n[short][last]
        return rows, size, {int(i): ids[start[k]:start[k] + n[k]] for i, k in zip(order, of) if not short[k]}

    def encode(self, buf: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[bytes, np.ndarray]:
        """Little-endian ids of consecutive texts, each with ``end_id`` behind it, and the number of ids to each text's end."""
        offs = (offsets - offsets[0]).astype(np.int64)
        raw = buf[int(offsets[0]):int(offsets[-1])]
        kind, low = self._bytes(raw)
        first, end = self._odd_chunks(kind, offs)
        change = np.ones(len(raw) + 1, bool)
        change[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        change[offs] = True
        cuts = np.flatnonzero(change)
        real = np.flatnonzero(kind[cuts[:-1]] != GAP)
        start, size = cuts[real], cuts[real + 1] - cuts[real]
        eight = np.ndarray(len(raw) + PIECE_BYTES - 7, "<u8", low, strides=(1,))
        key = np.empty((len(start), 2), np.uint64)
        key[:, 0] = eight[start] & _MASK[np.minimum(size, 8)]
        key[:, 1] = eight[start + 8] & _MASK[np.clip(size - 8, 0, 8)]
        fits = size <= PIECE_BYTES
        long = start[~fits]
        others = [raw[a:b].tobytes().decode() for a, b in zip([*first, *long], [*end, *(long + size[~fits])])]
        start = start[fits]
        rows, size, wide = self._plain(key[fits])
        ids = rows[np.arange(PIECE_IDS) < size[:, None]].astype("<u4")
        far = self.chunks.fill(set(others)) if others else {}
        known = self.chunks
        others = [np.frombuffer(known[c] if c in known else far[c], "<u4") for c in others] + list(wide.values())
        # what stands between the plain pieces, in order: of one place, the ends of texts come first
        at = np.concatenate((offs[1:], first, long, start[list(wide)]))
        n = np.array([1] * (len(offs) - 1) + [len(x) for x in others], np.int64)
        order = np.lexsort((np.arange(len(at)) >= len(offs) - 1, at))
        ends = [np.array([end_id], "<u4")] * (len(offs) - 1)
        extra = [*ends, *others]
        before = np.concatenate(([0], np.cumsum(size)))[np.searchsorted(start, at[order])]
        values = np.concatenate([extra[i] for i in order])
        out = np.insert(ids, np.repeat(before, n[order]), values)
        upto = before + np.cumsum(n[order])
        return out.tobytes(), upto[order < len(offs) - 1]


_TABLES: dict[str, _ChunkIds] = {}
_PIECES: dict[str, _PieceIds] = {}


def _chunk_ids(path: str, kept: int = KEPT) -> _ChunkIds:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _TABLES:
        _TABLES[path] = _ChunkIds(path)
    _TABLES[path].kept = kept
    return _TABLES[path]


def _piece_ids(path: str, kept: int = KEPT) -> _PieceIds:
    chunks = _chunk_ids(path, kept)
    if path not in _PIECES or _PIECES[path].chunks is not chunks:
        _PIECES[path] = _PieceIds(chunks)
    _PIECES[path].keep(kept)
    return _PIECES[path]


def _split(text: str) -> list[str]:
    """Chunks between blanks, tabs and line ends (white space to the tokenizer too)."""
    if "\n" in text or "\t" in text or "\r" in text:
        text = text.replace("\n", " ").replace("\t", " ").replace("\r", " ")
    return [c for c in text.split(" ") if c]


def token_pieces(docs: DataFrame, tokenizer_path: str, max_len: int = 4096, end_id: int = 1,
                 id_col: str = "doc_id", text_col: str = "text", kept: int = KEPT) -> DataFrame:
    """Pieces of every document: ``doc_id, row, piece, start, length, ids``
    (little-endian unsigned 32-bit ids).  ``row`` tells repeated doc_ids apart.
    ``kept`` bounds what a Python worker remembers: it changes memory and time, never the ids."""
    def run(batches):
        table = _piece_ids(tokenizer_path, kept)
        schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("piece", pa.int32()),
                            ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])
        for batch in batches:
            for lo, hi, buf, offsets in slices(batch.column(2), SLICE):
                part = batch.slice(lo, hi - lo)
                data, upto = table.encode(buf, offsets, end_id)
                ends = (4 * upto).tolist()
                out = {f.name: [] for f in schema}
                for doc, row, a, b in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), [0, *ends], ends):
                    ids = data[a:b]
                    for k, at in enumerate(range(0, len(ids), 4 * max_len)):
                        cut = ids[at:at + 4 * max_len]
                        for name, v in zip(out, (doc, row, k, at // 4, len(cut) // 4, cut)):
                            out[name].append(v)
                yield record_batch(schema, **out)

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                      F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, PIECES)


def best_fit_plan(histogram: dict[int, int], size: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: rows (length, first rank, last rank + 1,
    first sequence, offset).  Ranks of one row go to consecutive sequences.

    Open sequences are kept as runs of equal fill, by free space; a length
    fills whole runs, so the work follows the number of different lengths."""
    free: dict[int, deque] = {}
    spaces: list[int] = []          # sorted free spaces that have runs
    plan, next_seq = [], 0

    def add(space: int, first: int, n: int) -> None:
        if space <= 0:
            return
        if space not in free:
            free[space] = deque()
            insort(spaces, space)
        free[space].append((first, n))

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            at = bisect_left(spaces, length)
            if at < len(spaces):
                space = spaces[at]
                first, n = free[space].popleft()
                take = min(n, left)
                if take < n:
                    free[space].appendleft((first + take, n - take))
                elif not free[space]:
                    del free[space]
                    del spaces[at]
                plan.append((length, rank, rank + take, first, size - space))
                add(space - length, first, take)
                rank, left = rank + take, left - take
            else:
                # new sequences hold as many of this length as fit
                per = size // length
                full, rest = divmod(left, per)
                for k in range(per if full else 0):
                    plan.append((length, rank, rank + full, next_seq, k * length))
                    rank += full
                if full:
                    add(size - per * length, next_seq, full)
                    next_seq += full
                for k in range(rest):
                    plan.append((length, rank, rank + 1, next_seq, k * length))
                    rank += 1
                if rest:
                    add(size - rest * length, next_seq, 1)
                    next_seq += 1
                left = 0
    return plan


def place(pieces: DataFrame, max_len: int = 4096) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces that have a ``length``
    column (and ``doc_id, row, piece`` as a total order)."""
    spark = pieces.sparkSession
    total = pieces.count()
    buckets = parts_for(total, RANKED)
    bucket = F.pmod(F.xxhash64("doc_id", "row", "piece"), F.lit(buckets))
    counts = materialize(pieces.groupBy("length", bucket.alias("bucket")).agg(F.count("*").alias("n")))
    # at most max_len rows reach the driver
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = best_fit_plan(histogram, max_len)
    by_length = defaultdict(list)
    for length, *run in plan:
        by_length[length].append(tuple(run))
    runs = spark.createDataFrame(
        list(by_length.items()),
        "length long, runs array<struct<from_rank:long,to_rank:long,first_seq:long,offset:long>>")
    # one row per length and a few runs in it: its size is known here
    runs = F.broadcast(runs) if len(plan) <= PLAN_ROWS else runs
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "row", "piece")
    ranked = (pieces.withColumn("bucket", bucket)
              .withColumn("r", F.row_number().over(inside) - 1)
              .join(offsets, ["length", "bucket"])
              .withColumn("rank", F.col("r") + F.col("before")).drop("r", "before", "bucket"))
    run = F.element_at(F.filter("runs", lambda s: (s["from_rank"] <= F.col("rank")) & (F.col("rank") < s["to_rank"])), 1)
    return (ranked.join(runs, "length").withColumn("run", run)
            .withColumn("sequence_id", F.col("run.first_seq") + F.col("rank") - F.col("run.from_rank"))
            .withColumn("offset", F.col("run.offset")).drop("runs", "run", "rank"))


def pack(docs: DataFrame, tokenizer_path: str, max_len: int = 4096, end_id: int = 1) -> DataFrame:
    """Packed pieces with their ids: every piece has a place in a sequence of at
    most ``max_len`` tokens, gapless from offset 0."""
    return place(materialize(token_pieces(docs, tokenizer_path, max_len, end_id)), max_len)
