import random
from collections.abc import Iterator

import numpy as np
import pytest
from llm_fixtures import docs, empty, rows, words

from matchspark.llm import substrings


def plain(source, window):
    seen, out = set(), {}
    for d, t in sorted(source):
        w, gone = words(t), set()
        for k in range(len(w) - window + 1):
            g = tuple(w[k:k + window])
            if g in seen:
                gone |= set(range(k, k + window))
            seen.add(g)
        out[d] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


@pytest.mark.parametrize("window,shard", [(20, 1_000_000), (20, 200), (6, 1_000_000)])
def test_equals_brute_force(spark, window, shard, monkeypatch):
    monkeypatch.setattr(substrings, "SHARD_WORDS", shard)
    source = [(r[0], r[1]) for r in rows()]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.remove_repeats(docs(spark), window).collect()}
    assert got == plain(source, window)


def test_null_ids_keep_all(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(None, text), (1 << 60, text), ((1 << 60) + 1, text)], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in substrings.remove_repeats(df).collect()}
    assert got == {None: 0, 1 << 60: 0, (1 << 60) + 1: 40}


def test_empty_table(spark):
    assert substrings.remove_repeats(empty(spark)).count() == 0


def test_index_finds_the_earliest_occurrence():
    r = random.Random(3)
    segments = [np.array([r.randint(1, 3) for _ in range(r.randint(8, 40))]) for _ in range(30)]
    docs_, starts = np.array([r.randint(0, 9) for _ in segments]), np.arange(30) * 100
    lengths = np.array([len(s) for s in segments])
    found = substrings.earliest(np.concatenate(segments), lengths, [docs_], starts, 8)
    _, at = substrings.joined_codes(np.concatenate(segments), lengths)
    of = np.searchsorted(at, found, "right") - 1
    doc, start = docs_[of], starts[of] + found - at[of]
    first, want = {}, []
    for s, d, a in sorted(zip(segments, docs_.tolist(), starts.tolist()), key=lambda x: (x[1], x[2])):
        for k in range(len(s) - 7):
            first.setdefault(tuple(s[k:k + 8]), (d, a + k))
    for s in segments:
        want += [first[tuple(s[k:k + 8])] for k in range(len(s) - 7)]
    assert list(zip(doc.tolist(), start.tolist())) == want


def test_rank_of_the_wavelet_tree():
    codes = np.random.default_rng(1).integers(0, 13, 500)
    tree = substrings.WaveletTree(codes, 4)
    c, lo, hi = np.arange(13), np.arange(13) * 7, np.arange(13) * 7 + 300
    a, b = tree.rank(c, lo, hi)
    assert a.tolist() == [int((codes[:x] == k).sum()) for k, x in zip(c, lo)]
    assert b.tolist() == [int((codes[:x] == k).sum()) for k, x in zip(c, hi)]


def test_hot_anchor_does_not_fill_a_shard(spark, monkeypatch):
    """A frequent four-word sequence of low hash, each time with other words around it."""
    import pyarrow as pa

    from matchspark.llm.words import batch_words, grams
    r = random.Random(2)
    sequences = [" ".join(f"s{r.randint(0, 10**6)}" for _ in range(4)) for _ in range(3000)]
    hashes = [int(grams(next(iter(batch_words(pa.array([s]))))[2].hash, 4)[0]) for s in sequences]
    common = sequences[hashes.index(min(hashes))]
    own = lambda i, k: " ".join(f"d{i}x{k}y{j}" for j in range(30))
    source = [(i, f"{own(i, 0)} {common} {own(i, 1)}") for i in range(60)]
    source += [(100 + i, f"{own(100 + i, 0)} {own(5, 0)} {common} {own(5, 1)}") for i in range(3)]
    real = substrings._index_shard

    def bounded(window):
        inner = real(window)

        def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            batches = list(batches)
            assert sum(len(x.split()) for b in batches for x in b.column("words").to_pylist()) <= 1000
            yield from inner(key, iter(batches))
        return run
    monkeypatch.setattr(substrings, "_index_shard", bounded)
    monkeypatch.setattr(substrings, "SHARD_WORDS", 400)
    monkeypatch.setattr(substrings, "ANCHOR_WORDS", 400, raising=False)
    df = spark.createDataFrame(source, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.remove_repeats(df).collect()}
    assert got == plain(source, 20) and got[101][1] == 64


def test_windows_of_hot_anchors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(substrings, "ANCHOR_WORDS", 30, raising=False)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.remove_repeats(docs(spark), 20).collect()}
    assert got == plain([(r[0], r[1]) for r in rows()], 20)


def test_repeated_doc_ids_with_other_texts(spark):
    """Rows of one id are documents of their own; equal rows are one document; null ids stand aside."""
    r = random.Random(9)
    passage = [" ".join(f"p{k}x{j}" for j in range(30)) for k in range(4)]
    own = lambda: " ".join(f"o{r.randint(0, 10**6)}" for _ in range(25))
    source = [(i // 3, f"{own()} {passage[i % 4]} {own()}") for i in range(24)]
    source += [(5, f"{passage[0]} {passage[0]} tail"), (5, f"{own()}"), (5, "short"), (5, None)]
    source += [source[7], source[7], (100, source[8][1]), (None, source[9][1]), (None, source[9][1])]
    df = spark.createDataFrame(source, "doc_id long, text string").repartition(5)
    key = {(x.doc_id, x.text): x.key for x in substrings._keyed(df, "doc_id", "text").collect()}
    order = sorted({s for s in source if s[0] is not None}, key=lambda s: (s[0], key[s]))
    want = plain([(k, t) for k, (_, t) in enumerate(order)], 20)
    want = {s: want[k] for k, s in enumerate(order)}
    got = substrings.remove_repeats(df).collect()
    expected = [(s[0], *(want[s] if s[0] is not None else (len(words(s[1])), 0, s[1]))) for s in source]
    assert sorted((tuple(x) for x in got), key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("depth", [3, 8, 20, 16, 1])
def test_search_in_any_depth(depth):
    """Few codes and long repeats: every window finds its first place."""
    r = random.Random(depth)
    lengths = np.array([r.randint(depth, depth + 30) for _ in range(40)])
    codes = np.concatenate([np.array([r.randint(1, 2) if k % 3 else 1 for _ in range(n)]) for k, n in enumerate(lengths)])
    docs_, starts = np.array([r.randint(0, 5) for _ in lengths]), np.arange(40) * 100
    found = substrings.earliest(codes, lengths, [docs_], starts, depth)
    text, at = substrings.joined_codes(codes, lengths)
    first, spots = {}, [(docs_[k], starts[k] + j, at[k] + j) for k in range(40) for j in range(lengths[k] - depth + 1)]
    for d, s, p in sorted(spots):
        first.setdefault(text[p:p + depth].tobytes(), p)
    assert found.tolist() == [first[text[p:p + depth].tobytes()] for _, _, p in spots]
