"""MinHash near-duplicate detection with tensored banding (operator 3).

Two collections of ``collections`` partial keys are computed, each from
``rows`` minhashes; every pair (i-th key of the first, j-th of the second)
is one table of the LSH index.  ``collections**2`` tables thus need only
``2 * collections * rows`` minhashes.  With 8 collections of 3 rows, a pair
at Jaccard 0.85 shares at least one of the 64 tables with probability
0.999 (0.99997 at 0.9).

Steps, all joins and map-side combined aggregates:

1. per document: distinct shingles -> digest of the set, partial keys and a
   parity bitmap; equal sets collapse to one node, whatever the doc_ids of their rows;
2. table keys of the remaining sets; buckets with two members or more;
3. every member is compared with the most central member of its buckets
   (the one that meets most others), so a group of n near copies costs n
   comparisons and not n * n; components of the verified links;
4. buckets that still span several components are finished by an exact
   prefix-filter join over their members (any two sets with Jaccard >= t
   share one of the first ``n - ceil(t * n) + 1`` shingles in one global
   order, rare shingles first), so no bucket or candidate cap is needed.

Candidates pass an exact filter first (the set bits of the exclusive-or of
two parity bitmaps never exceed the size of the symmetric difference) and
are then verified on their full shingle sets.

Defined results: a null text, or one without words, has no shingles and is
linked with nothing; fewer words than a shingle make one whole-sequence
shingle; equal texts share a component; rows that repeat a doc_id, with the same or
another text, give one row each and each its own text's component (nodes are sets, not ids);
a null doc_id is linked like any other and never names a component, unless all its
members' ids are null; an empty table gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchspark.llm.common import COUNTERS, components, counter_rows, materialize, record_batch, sum_counters
from matchspark.llm.words import batch_words, grams, mix

COLLECTIONS, ROWS = 8, 3
PARITY_WORDS = 16
SKETCH = 1 << 18
_U = np.uint64


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct shingle hashes of one document's word hashes."""
    if not len(words):
        return np.empty(0, np.uint64)
    return np.unique(grams(words, min(n, len(words))))


def _multipliers(n: int) -> np.ndarray:
    return np.random.default_rng(7).integers(1, 2**63, n, dtype=np.uint64) * _U(2) + _U(1)


def partial_keys(shingles: np.ndarray, mult: np.ndarray, rows: int) -> np.ndarray:
    """One key per collection member: its ``rows`` minhashes, mixed."""
    least = np.full(len(mult), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 2048):
        part = shingles[at:at + 2048, None] * mult[None, :]
        least = np.minimum(least, (part ^ (part >> _U(29))).min(0))
    out = np.zeros(len(mult) // rows, np.uint64)
    for r in range(rows):
        out = mix(out + least[r::rows])
    return out


def parity_bitmap(shingles: np.ndarray) -> np.ndarray:
    """1024 bits: the parity of the number of shingles that fall on each."""
    bits = np.bincount((shingles >> _U(54)).astype(np.int64), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(bits.astype(bool)).view(np.int64)


PROFILE = ("doc_id long, key long, n_shingles long, digest binary, a array<long>, b array<long>, "
           + ", ".join(f"p{i} long" for i in range(PARITY_WORDS)))


def profiles(docs: DataFrame, shingle: int, collections: int, rows: int) -> DataFrame:
    """Set size, set digest, both key collections and the parity bitmap of every document (doc_id, key, text)."""
    def run(batches):
        mult = _multipliers(2 * collections * rows)
        schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()),
                            ("a", pa.list_(pa.int64())), ("b", pa.list_(pa.int64()))]
                           + [(f"p{i}", pa.int64()) for i in range(PARITY_WORDS)])
        for batch in batches:
            ids, text_keys = batch.column(0), batch.column(1)
            for lo, hi, w in batch_words(batch.column(2), lower=True):
                n, digest, a, b, parity = [], [], [], [], []
                for i in range(hi - lo):
                    s = shingle_set(w.hash[w.first[i]:w.first[i + 1]], shingle)
                    n.append(len(s))
                    digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    keys = partial_keys(s, mult, rows).view(np.int64)
                    a.append(keys[:collections])
                    b.append(keys[collections:])
                    parity.append(parity_bitmap(s))
                parity = np.array(parity, np.int64).reshape(-1, PARITY_WORDS)
                yield record_batch(schema, doc_id=ids.slice(lo, hi - lo), key=text_keys.slice(lo, hi - lo), n_shingles=n,
                                   digest=digest, a=a, b=b,
                                   **{f"p{i}": parity[:, i] for i in range(PARITY_WORDS)})
    return docs.mapInArrow(run, PROFILE)


def shingle_sets(picked: DataFrame, shingle: int) -> DataFrame:
    """``doc_id, shingles`` of rows (node, digest, text): sorted distinct 64-bit shingle hashes as bytes, under
    the node's number, where the text does have that digest."""
    def run(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("shingles", pa.binary())])
        for batch in batches:
            nodes, wanted = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi, w in batch_words(batch.column(2), lower=True):
                out = [(nodes[lo + i], s) for i in range(hi - lo)
                       if hashlib.blake2b(s := shingle_set(w.hash[w.first[i]:w.first[i + 1]], shingle).tobytes(),
                                          digest_size=16).digest() == wanted[lo + i]]
                yield record_batch(schema, doc_id=[n for n, _ in out], shingles=[s for _, s in out])
    return picked.select("rep", "digest", "text").mapInArrow(run, "doc_id long, shingles binary")


def _plausible(x: str, y: str, percent: int):
    """Exact upper bound on the similarity of two profiles from sizes and parity bitmaps.

    ``100 * inter >= p * union`` and ``diff = nx + ny - 2 * inter`` give
    ``diff * (100 + p) <= (100 - p) * (nx + ny)``."""
    differing = sum((F.bit_count(F.col(f"{x}p{i}").bitwiseXOR(F.col(f"{y}p{i}"))) for i in range(1, PARITY_WORDS)),
                    F.bit_count(F.col(f"{x}p0").bitwiseXOR(F.col(f"{y}p0"))))
    total = F.col(f"{x}n_shingles") + F.col(f"{y}n_shingles")
    apart = F.abs(F.col(f"{x}n_shingles") - F.col(f"{y}n_shingles"))
    return F.greatest(differing.cast("long"), apart) * (100 + percent) <= (100 - percent) * total


def _named(frame: DataFrame, prefix: str, columns: list[str]) -> DataFrame:
    return frame.select(*(F.col(c).alias(prefix + c) for c in columns))


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b), those with ``100 * intersection >= percent * union`` on full sets."""
    both = (pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb")), "b")
            .join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa")), "a"))

    def run(batches):
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        for batch in batches:
            a, b, sa, sb = (batch.column(i).to_pylist() for i in range(4))
            keep = []
            for k, (x, y) in enumerate(zip(sa, sb)):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                merged = np.sort(np.concatenate((x, y)), kind="stable")
                inter = int((merged[1:] == merged[:-1]).sum())
                if 100 * inter >= percent * (len(x) + len(y) - inter):
                    keep.append(k)
            yield record_batch(schema, a=[a[k] for k in keep], b=[b[k] for k in keep])
    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _frequency_sketch(sets: DataFrame) -> bytes:
    """Shingle counts over ``SKETCH`` counters (1 MB, whatever the input): any
    counts give a valid global order, good ones put rare shingles first."""
    def run(batches):
        counts = np.zeros(SKETCH, np.int64)
        for batch in batches:
            for s in batch.column(0).to_pylist():
                counts += np.bincount((np.frombuffer(s, np.uint64) & _U(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
        yield counter_rows(counts)
    total = sum_counters(sets.select("shingles").mapInArrow(run, COUNTERS), SKETCH)
    return np.minimum(total, 2**31 - 1).astype(np.int32).tobytes()


def _prefixes(sets: DataFrame, sketch: bytes, percent: int) -> DataFrame:
    """``doc_id, token``: the shingles of every set that a similar set must share one of."""
    shared = sets.sparkSession.sparkContext.broadcast(sketch)

    def run(batches):
        counts = np.frombuffer(shared.value, np.int32)
        for batch in batches:
            ids, tokens = [], []
            for doc, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                s = np.frombuffer(s, np.uint64)
                n = len(s) - -(-percent * len(s) // 100) + 1
                rarest = s[np.lexsort((s, counts[(s & _U(SKETCH - 1)).astype(np.int64)]))[:n]]
                ids.append(np.full(len(rarest), doc, np.int64))
                tokens.append(rarest.view(np.int64))
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.array(np.concatenate(tokens))],
                                                 names=["doc_id", "token"])
    return sets.select("doc_id", "shingles").mapInArrow(run, "doc_id long, token long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    percent: int = 85, collections: int = COLLECTIONS, rows: int = ROWS) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # names a row by its id and text, in every scan alike
    texts = texts.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text")
    parity = [f"p{i}" for i in range(PARITY_WORDS)]
    profile = materialize(profiles(texts, shingle, collections, rows))

    # 1. equal sets collapse to one node, numbered where it is stored; its text is that of one of its rows
    first = materialize(profile.filter("n_shingles > 0").groupBy("digest").agg(
        F.min("doc_id").alias("least"), F.min("key").alias("key"), F.first("n_shingles").alias("n_shingles"), F.first("a").alias("a"),
        F.first("b").alias("b"), *(F.first(c).alias(c) for c in parity)).withColumn("rep", F.monotonically_increasing_id()))

    # 2. tensored table keys; buckets of two or more, each with its size
    tables = (first.select("rep", F.posexplode("a").alias("i", "x"), "b")
              .select("rep", "i", "x", F.posexplode("b").alias("j", "y"))
              .select("rep", F.xxhash64("i", "j", "x", "y").alias("key")))
    dealt = tables.repartition("key")
    sizes = dealt.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    buckets = materialize(dealt.join(sizes, "key"))

    # 3. a star around the most central member of each bucket
    central = buckets.groupBy("rep").agg(F.sum("size").alias("meets"))
    near = buckets.join(central, "rep")
    leaders = near.groupBy("key").agg(F.max_by("rep", F.struct("meets", -F.col("rep"))).alias("leader"))
    stars = buckets.join(leaders, "key").filter("rep <> leader").select(
        F.col("rep").alias("a"), F.col("leader").alias("b")).distinct()
    slim = first.select("rep", "n_shingles", *parity)
    cols = ["n_shingles", *parity]
    pairs = (stars.join(slim.select(F.col("rep").alias("a"), *(F.col(c).alias("x" + c) for c in cols)), "a")
             .join(slim.select(F.col("rep").alias("b"), *(F.col(c).alias("y" + c) for c in cols)), "b")
             .filter(_plausible("x", "y", percent)).select("a", "b"))
    members = first.select("rep", "digest", "key").join(central.select("rep"), "rep", "left_semi")
    sets = shingle_sets(texts.select("key", "text").join(members, "key"), shingle)
    if profile.groupBy("key").count().filter("count > 1").limit(1).count():   # rows equal in id and text
        sets = sets.dropDuplicates(["doc_id"])
    sets = materialize(sets)
    links = materialize(verify(materialize(pairs), sets, percent))
    label = components(links)

    # 4. buckets over several components: exact prefix join of their members
    placed = (buckets.join(label, F.col("rep") == F.col("node"), "left")
              .select("key", "rep", F.coalesce("label", "rep").alias("comp")))
    mixed = (placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
             .filter("lo < hi").select("key"))
    open_docs = materialize(placed.join(mixed, "key", "left_semi").select("rep", "comp").distinct())
    open_sets = materialize(sets.join(open_docs.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi"))
    sketch = _frequency_sketch(open_sets)
    tokens = (_prefixes(open_sets, sketch, percent)
              .join(open_docs.join(slim, "rep"), F.col("doc_id") == F.col("rep")).drop("rep"))
    side = ["doc_id", "comp", *cols]
    x, y = _named(tokens, "x", ["token", *side]), _named(tokens, "y", ["token", *side])
    rest = (x.join(y, (F.col("xtoken") == F.col("ytoken")) & (F.col("xdoc_id") < F.col("ydoc_id"))
                   & (F.col("xcomp") != F.col("ycomp")) & _plausible("x", "y", percent))
            .select(F.col("xdoc_id").alias("a"), F.col("ydoc_id").alias("b")).distinct())
    more = verify(materialize(rest), open_sets, percent)
    comp_of = open_docs.select(F.col("rep").alias("r"), "comp")
    bridges = materialize(more.join(comp_of.select(F.col("r").alias("a"), F.col("comp").alias("ca")), "a")
                          .join(comp_of.select(F.col("r").alias("b"), F.col("comp").alias("cb")), "b")
                          .select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct())
    merged = components(bridges)
    final = (label.join(merged.select(F.col("node").alias("label"), F.col("label").alias("to")), "label", "full")
             .select(F.coalesce("node", "label").alias("rep"), F.coalesce("to", "label").alias("component_id")))

    nodes = first.select("digest", "least", "rep").join(final, "rep", "left").withColumn("label", F.coalesce("component_id", "rep"))
    smallest = nodes.groupBy("label").agg(F.min("least").alias("smallest"))
    named = nodes.join(smallest, "label").select("digest", "smallest")
    return profile.select("doc_id", "n_shingles", "digest").join(named, "digest", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("smallest")).otherwise(F.col("doc_id")).alias("component_id"))
