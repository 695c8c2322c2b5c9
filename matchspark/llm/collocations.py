"""Phrase collocations by best-first branch and bound (operator 12).

Texts are lower-cased (A-Z), cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and these into
words ``[^\\x20\\x09]+``.  Phrases of 2 to 4 words with a count ``a`` of at least ``least``
are candidates; the score is the smallest ``floor(2000000 * a / (l + r))`` over their
cuts.  Phrases grow one word at a time, as nodes of a prefix tree:

* A phrase that starts with p counts at most ``f(p)``, and the cut after its first
  word has ``r >= a``, so no phrase below p scores more than ``2 f(p) / (f(w1) + f(p))``.
  That bound needs prefix counts alone.
* Words and pairs are counted whole.  Every wave then takes the best of the frontier: for
  each language a level ``t`` that some thousands of pairs reach, and all nodes whose
  bound reaches it.  Only their children are counted, and the children that could
  hold a phrase scoring ``t`` or more to 80 percent (the neighbours on its left).
* After a wave every phrase scoring ``t`` or more is known, and whether it survives;
  all others score less.  A language with ``top`` survivors at ``t`` is settled,
  ties included; the others go on with a lower level, at last with 0.

A phrase is dropped by a longer one only if it is dropped by one with a single word
more (counts never grow with the phrase), so neighbours of one word suffice.

Counts are exact, for phrases named by 64-bit hashes of their words and language.  Each
task counts its own grams in sorted arrays before they are shuffled by the words; which
grams are counted is read from bitmaps of fixed size (``common.BITS``): a wrong hit costs a
row, no result.  Products are decimals of 38 digits.

Defined results: a null text has no words, a null language is ``und``; repeated rows
count each time; a language whose candidates are fewer than ``top`` gives them all; an
empty table gives an empty result; texts of any length are read whole; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchspark.llm.common import is_marked, marked_keys, materialize, parts_for, record_batch, written
from matchspark.llm.words import _LOWER, Words, grams, mix, separator_table, slices
from matchspark.session import size_estimate

LEAST, TOP, SHARE = 30, 2000, 80
ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
#: The most grams that a task holds; words of a shuffled part.
HELD = 3_000_000
PART_WORDS = 4_000_000
#: Bytes of input (as the optimizer estimates it) for each part of the words' counts.
PART_BYTES = 16 << 20
#: Pairs of a language that the first wave takes, as a multiple of ``top``, and its growth.
FIRST, GROWTH = 3, 4
#: A language's rows are ranked in so many parts before the parts' best are ranked together.
PARTS = 64

_TABLE = separator_table(ENDS)
_END = np.zeros(256, bool)
_END[list(ENDS)] = True


# --- counting inside a task --------------------------------------------------------

def _lang_hash(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, np.ndarray, np.ndarray, list[str]]]:
    """(words, hash of word and language, number of the piece, language of each text) of bounded slices."""
    for batch in batches:
        langs = batch.column(0)
        for lo, hi, buf, offsets in slices(batch.column(1)):
            w = Words(buf, offsets, _TABLE, True)
            of = langs.slice(lo, hi - lo).to_pylist()
            salt = np.array([_lang_hash(x) for x in of], np.uint64)
            doc = w.doc_of_word()
            ends = np.concatenate(([0], np.cumsum(_END[w.buf])))[w.start]
            new = (ends[1:] != ends[:-1]) | (doc[1:] != doc[:-1])
            piece = np.concatenate(([0], np.cumsum(new))) if len(w) else np.empty(0, np.int64)
            yield w, mix(w.hash ^ salt[doc]), piece, of


def _texts(w: Words, at: np.ndarray) -> pa.Array:
    """Lower-cased words as strings."""
    size = w.end[at] - w.start[at]
    offsets = np.concatenate(([0], np.cumsum(size)))
    place = np.arange(offsets[-1]) + np.repeat(w.start[at] - offsets[:-1], size)
    data = _LOWER[w.buf[place]]
    return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())


def _distinct(key: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Place of one of each key (by rising key) and the sum of its counts."""
    order = np.argsort(key, kind="stable")
    k = key[order]
    first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1]))[:len(k)])
    if not len(first):
        return first, first
    return order[first], np.diff(np.append(first, len(k))) if n is None else np.add.reduceat(n[order], first)


class Tally:
    """Grams of m words and their counts, compacted as they come."""

    def __init__(self, m: int):
        self.m, self.parts, self.held = m, [], 0
        self.schema = pa.schema([(f"w{i + 1}", pa.int64()) for i in range(m)] + [("n", pa.int64())])

    def add(self, h: np.ndarray, at: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(at):
            key = grams(h, self.m)[at]
            one, n = _distinct(key)
            self.parts.append((key[one], [h[at[one] + i] for i in range(self.m)], n))
            self.held += len(one)
        if self.held > HELD:
            self._compact()
            if self.held > HELD // 2:
                yield from self.rows()

    def _compact(self) -> None:
        if len(self.parts) > 1:
            key, n = (np.concatenate([p[i] for p in self.parts]) for i in (0, 2))
            words = [np.concatenate([p[1][i] for p in self.parts]) for i in range(self.m)]
            one, n = _distinct(key, n)
            self.parts = [(key[one], [w[one] for w in words], n)]
            self.held = len(one)

    def rows(self) -> Iterator[pa.RecordBatch]:
        self._compact()
        for _, words, n in self.parts:
            for a in range(0, len(n), 1 << 18):
                here = slice(a, a + (1 << 18))
                yield record_batch(self.schema, n=n[here], **{f"w{i + 1}": w[here].view(np.int64) for i, w in enumerate(words)})
        self.parts, self.held = [], 0


def count_words(texts: DataFrame, parts: int) -> DataFrame:
    """``w, lang, word, n`` of every word, and one row without a word for each language: all its words."""
    schema = pa.schema([("w", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])

    def run(batches):
        total: dict[str, int] = {}
        seen, key, count, rows = np.empty(0, np.uint64), [], [], []

        def flush():
            if key:
                one, n = _distinct(np.concatenate(key), np.concatenate(count))
                k = np.concatenate(key)[one]
                names = pa.Table.from_batches(rows).sort_by("u")   # by the unsigned hash, as ``k`` is
                yield record_batch(schema, w=k.view(np.int64), lang=names["lang"].combine_chunks(),
                                   word=names["word"].combine_chunks(), n=n)
        for w, h, _, of in _slices(batches):
            for lang, size in zip(of, np.diff(w.first).tolist()):
                total[lang] = total.get(lang, 0) + size
            one, n = _distinct(h)
            key.append(h[one])
            count.append(n)
            fresh = one[~np.isin(h[one], seen, assume_unique=True)]
            seen = np.union1d(seen, h[fresh])
            lang = pa.array(of, pa.string()).take(pa.array(w.doc_of_word()[fresh]))
            rows.append(pa.RecordBatch.from_arrays([pa.array(h[fresh], pa.uint64()), lang, _texts(w, fresh)], names=["u", "lang", "word"]))
            if len(seen) > HELD // 4 or sum(map(len, key)) > HELD:
                yield from flush()
                seen, key, count, rows = np.empty(0, np.uint64), [], [], []
        yield from flush()
        if total:
            yield record_batch(schema, w=[0] * len(total), lang=list(total), word=[None] * len(total), n=list(total.values()))
    return (texts.mapInArrow(run, "w long, lang string, word string, n long")
            .repartition(parts, "w").groupBy("w", "lang", "word").agg(F.sum("n").alias("n")))


def bitmap(frame: DataFrame, words: list[str]):
    """Broadcast bits of the grams in a frame."""
    m = len(words)

    def keys(batches):
        for batch in batches:
            h = np.stack([batch.column(i).to_numpy().view(np.uint64) for i in range(m)], axis=1).ravel()
            yield pa.RecordBatch.from_arrays([pa.array((grams(h, m)[::m] if m > 1 else h).view(np.int64))], names=["key"])
    return marked_keys(frame.select(*words).mapInArrow(keys, "key long"))


def count_grams(texts: DataFrame, m: int, parts: int, every: list, some: list = ()) -> DataFrame:
    """``w1 .. wm, n`` of the grams whose parts are set in every bitmap of ``every`` and in one
    of ``some``: (bitmap, words of the part, first word of the part)."""
    def run(batches):
        tally = Tally(m)
        bits = {id(b): np.frombuffer(b.value, np.uint8) for b, _, _ in [*every, *some]}
        for _, h, piece, _ in _slices(batches):
            if len(h) < m:
                continue
            at = np.flatnonzero(piece[m - 1:] == piece[:len(piece) - m + 1])
            made = {}

            def hit(test, where):
                b, size, first = test
                if size not in made:
                    made[size] = grams(h, size) if size > 1 else h
                return is_marked(bits[id(b)], made[size][where + first])
            for test in every:
                at = at[hit(test, at)]
            if some:
                keep = np.zeros(len(at), bool)
                for test in some:
                    keep |= hit(test, at)
                at = at[keep]
            yield from tally.add(h, at)
        yield from tally.rows()
    words = [f"w{i + 1}" for i in range(m)]
    return (texts.mapInArrow(run, ", ".join(f"{c} long" for c in [*words, "n"]))
            .repartition(parts, *words).groupBy(*words).agg(F.sum("n").alias("n")))


# --- scores ------------------------------------------------------------------------

def _score(a: Column, l: Column, r: Column) -> Column:  # noqa: E741
    big = lambda c: c.cast("decimal(20,0)")
    return F.call_function("div", big(a) * F.lit(2_000_000), big(l) + big(r)).cast("long")


def _lowest(cuts: list[Column]) -> Column:
    """The cut (score, k, l, r) of the lowest score, the smallest k of ties."""
    return F.least(*cuts) if len(cuts) > 1 else cuts[0]


def _cut(a: Column, k: int, l: str, r: str) -> Column:  # noqa: E741
    return F.struct(_score(a, F.col(l), F.col(r)).alias("score"), F.lit(k).alias("k"), F.col(l).alias("l"), F.col(r).alias("r"))


def _names(frame: DataFrame, source: list[str], to: list[str], n: str, extra: dict[str, str] | None = None) -> DataFrame:
    """Columns of a count frame under the names by which it is joined."""
    extra = extra or {}
    return frame.select(*(F.col(s).alias(t) for s, t in zip(source, to)), F.col("n").alias(n), *(F.col(s).alias(t) for s, t in extra.items()))


def _level(frame: DataFrame, k: int) -> DataFrame:
    """``lang, t``: the largest score that k rows of the language reach (0 if there are fewer rows)."""
    counts = frame.groupBy("lang", "score").agg(F.count("*").alias("rows"))   # at most 10^6 scores a language
    above = F.sum("rows").over(Window.partitionBy("lang").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0))
    reached = counts.withColumn("above", above).groupBy("lang").agg(F.max(F.when(F.col("above") >= k, F.col("score"))).alias("t"))
    return reached.select("lang", F.coalesce("t", F.lit(0).cast("long")).alias("t"))


def _undropped(short: DataFrame, words: list[str], longer: DataFrame, share: int) -> DataFrame:
    """Phrases no phrase of one word more holds to ``share`` percent."""
    m = len(words)
    ends = [[f"w{i + 1}" for i in range(m)], [f"w{i + 2}" for i in range(m)]]
    most = (longer.select(*(F.col(c).alias(w) for c, w in zip(ends[0], words)), "n")
            .union(longer.select(*(F.col(c).alias(w) for c, w in zip(ends[1], words)), "n"))
            .groupBy(*words).agg(F.max("n").alias("longest")))
    wide = lambda c, x: F.col(c).cast("decimal(20,0)") * F.lit(x)
    return short.join(most, words, "left").filter(F.col("longest").isNull() | (wide("longest", 100) < wide("n", share))).drop("longest")


RESULT = ["lang", "w1", "w2", "w3", "w4", "n", "l", "r", "score"]


def _shape(frame: DataFrame) -> DataFrame:
    fill = [c for c in ("w3", "w4") if c not in frame.columns]
    return frame.select("*", *(F.lit(None).cast("long").alias(c) for c in fill),
                        F.col("best.l").alias("l"), F.col("best.r").alias("r"), F.col("best.score").alias("score")).select(*RESULT)


def _wave(texts: DataFrame, words: DataFrame, pairs: DataFrame, known, parts: int, least: int, share: int) -> DataFrame:
    """All surviving phrases of a score of ``t`` or more (column of ``pairs``)."""
    one, two, three = ["w1"], ["w1", "w2"], ["w1", "w2", "w3"]
    open2, best2 = pairs.filter("bound >= t"), pairs.filter("score >= t")
    e2, c2 = bitmap(open2, two), bitmap(best2, two)
    threes = count_grams(texts, 3, parts, [(known, 2, 0), (known, 2, 1)], [(e2, 2, 0), (c2, 2, 1)]).filter(F.col("n") >= least)
    single = lambda w, n: _names(words, ["w"], [w], n)
    a = F.col("n")
    threes = materialize(
        threes.join(_names(pairs, two, two, "f12", {"l": "f1", "lang": "lang", "t": "t"}), two)
        .join(_names(pairs, two, ["w2", "w3"], "f23"), ["w2", "w3"]).join(single("w3", "f3"), "w3")
        .withColumn("best", _lowest([_cut(a, 1, "f1", "f23"), _cut(a, 2, "f12", "f3")]))
        .select(*three, "n", "lang", "t", "f1", "f12", "best", _score(a, F.col("f1"), a).alias("bound")))
    open3, best3 = threes.filter("bound >= t"), threes.filter("best.score >= t")
    e3, c3 = bitmap(open3, three), bitmap(best3, three)
    fours = count_grams(texts, 4, parts, [(known, 2, 0), (known, 2, 1), (known, 2, 2)], [(e3, 3, 0), (c3, 3, 1)])
    fours = materialize(fours.filter(F.col("n") >= least))
    # fours that may score t by the cuts already counted; their last three words may be new
    able = (fours.join(_names(open3, three, three, "f123", {"lang": "lang", "t": "t", "f1": "f1", "f12": "f12"}), three)
            .join(_names(pairs, two, ["w3", "w4"], "f34"), ["w3", "w4"]).join(single("w4", "f4"), "w4")
            .withColumn("cut2", _cut(a, 2, "f12", "f34")).withColumn("cut3", _cut(a, 3, "f123", "f4"))
            .filter((F.col("cut2.score") >= F.col("t")) & (F.col("cut3.score") >= F.col("t"))))
    able = materialize(able.select("w1", "w2", "w3", "w4", "n", "lang", "t", "f1", "cut2", "cut3"))
    last = ["w2", "w3", "w4"]
    counted = threes.select(*three, "n")
    new = able.select(*(F.col(c).alias(t) for c, t in zip(last, three))).distinct().join(counted, three, "left_anti")
    if new.limit(1).count():
        wanted = materialize(new)
        counted = counted.unionByName(count_grams(texts, 3, parts, [(bitmap(wanted, three), 3, 0)]).join(wanted, three, "left_semi"))
    fours_best = (able.join(_names(counted, three, last, "f234"), last)
                  .withColumn("best", _lowest([_cut(a, 1, "f1", "f234"), F.col("cut2"), F.col("cut3")])).filter("best.score >= t"))
    twos = best2.withColumn("best", _cut(a, 1, "l", "r")).drop("l", "r", "score")
    return (_shape(_undropped(twos, two, threes, share)).unionByName(_shape(_undropped(best3, three, fours, share)))
            .unionByName(_shape(fours_best)))


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", top: int = TOP, least: int = LEAST,
                 share: int = SHARE, first: int = FIRST) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best ``top`` surviving phrases of each language."""
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counted = written(count_words(texts, parts_for(size_estimate(docs), PART_BYTES)).filter((F.col("n") >= least) | F.col("word").isNull()))
    totals = counted.filter("word is null").select("lang", F.col("n").alias("total"))
    words = counted.filter("word is not null")
    parts = parts_for(totals.agg(F.sum("total")).first()[0], PART_WORDS)
    common = bitmap(words, ["w"])
    pairs = count_grams(texts, 2, parts, [(common, 1, 0), (common, 1, 1)]).filter(F.col("n") >= least)
    a = F.col("n")
    pairs = materialize(
        pairs.join(words.select(F.col("w").alias("w1"), F.col("n").alias("l"), "lang"), "w1")
        .join(words.select(F.col("w").alias("w2"), F.col("n").alias("r")), "w2")
        .select("lang", "w1", "w2", "n", "l", "r", _score(a, F.col("l"), F.col("r")).alias("score"), _score(a, F.col("l"), a).alias("bound")))
    known = bitmap(pairs, ["w1", "w2"])
    frontier, found, take = pairs, [], first * top
    while True:
        level = materialize(_level(frontier, take))
        here = materialize(_wave(texts, words, frontier.join(level, "lang"), known, parts, least, share))
        settled = level.join(here.groupBy("lang").agg(F.count("*").alias("rows")), "lang", "left").filter(
            (F.col("t") == 0) | (F.col("rows") >= top)).select("lang")
        settled = materialize(settled)
        found.append(here.join(settled, "lang", "left_semi"))
        frontier = frontier.join(settled, "lang", "left_anti")
        if not frontier.limit(1).count():
            break
        take *= GROWTH
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return _ranked(out, words, totals, top)


def _ranked(found: DataFrame, words: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of each language; ties at the last score are ordered in parts first."""
    best = found.join(_level(found, top), "lang").filter("score >= t")
    for i in range(1, 5):
        best = best.join(words.select(F.col("w").alias(f"w{i}"), F.col("word").alias(f"x{i}")), f"w{i}", "left")
    best = best.select("lang", F.concat_ws(" ", "x1", "x2", "x3", "x4").alias("phrase"), F.col("n").alias("a"), "l", "r", "score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    best = best.withColumn("part", part).withColumn("at", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    best = best.filter(F.col("at") <= top).withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top)
    return best.join(totals.withColumnRenamed("total", "n"), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS id, lang, p FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
    FROM documents)),
split AS (SELECT id, lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
tokens AS (SELECT id, lang, unnest(w) AS w, unnest(range(len(w))) AS i FROM split),
placed AS (
  SELECT lang, w AS w1, lead(w, 1) OVER p AS w2, lead(w, 2) OVER p AS w3, lead(w, 3) OVER p AS w4
  FROM tokens WINDOW p AS (PARTITION BY id ORDER BY i)),
grams AS (
  SELECT lang, 1 AS m, w1 AS phrase, count(*) AS f FROM placed GROUP BY ALL
  UNION ALL SELECT lang, 2, w1 || ' ' || w2, count(*) FROM placed WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM placed WHERE w3 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, count(*) FROM placed WHERE w4 IS NOT NULL GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE m = 1 GROUP BY lang),
cand AS (SELECT *, string_split(phrase, ' ') AS w FROM grams WHERE m >= 2 AND f >= 30),
cuts AS (
  SELECT c.lang, c.m, c.phrase, c.f AS a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * c.f) // (x.f + y.f) AS score
  FROM cand c JOIN (VALUES (1), (2), (3)) ks(k) ON k < c.m
  JOIN grams x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ')
  JOIN grams y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:c.m], ' ')),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (
  SELECT * FROM scored s WHERE NOT EXISTS (
    SELECT 1 FROM cand c WHERE c.lang = s.lang AND c.m > s.m AND 100 * c.f >= 80 * s.a
    AND contains(' ' || c.phrase || ' ', ' ' || s.phrase || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM kept JOIN totals USING (lang)
QUALIFY rank <= 2000
"""
