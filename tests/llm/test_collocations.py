"""Collocations against a brute-force count of every phrase; several waves; awkward rows."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from matchspark.llm import collocations as co
from tests.llm import llm_fixtures as fx


def brute(rows, top, least, share=80):
    f, total = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        count = f.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(fx.LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for m in range(1, 5):
                count.update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, count in f.items():
        cand = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= share * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q, b in cand.items()):
                continue
            s, _, l, r = min((2000000 * a // (count[p[:k]] + count[p[k:]]), k, count[p[:k]], count[p[k:]]) for k in range(1, len(p)))  # noqa: E741
            kept.append((-s, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1):  # noqa: E741
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


def corpus(seed, n, vocabulary):
    """Prose with words of very unequal frequency, set phrases (some inside longer ones) and punctuation."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["Élan", "über", "日本"]
    weight = [1 / (i + 1) for i in range(len(words))]
    phrases = ["new york city", "York City hall", "a b c d e", "of the", "of the king", "tick tick tick tick", "über élan", "x y"]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(rnd.randint(1, 25)):
            parts.append(rnd.choice(phrases) if rnd.random() < .35 else rnd.choices(words, weight)[0])
            if rnd.random() < .15:
                parts[-1] += rnd.choice([".", ",", "\n", "\x0b", "?", "-", "\x01", " ; "])
        rows.append(((" " if rnd.random() < .8 else "\t").join(parts), rnd.choice(["en", "en", "en", "de", None, "und", ""])))
    return rows


def frame(spark, rows):
    schema = "text string, lang string, w string, word int, n string, score string, t int, piece int"
    return spark.createDataFrame([(t, x, "a", 1, "b", "c", 2, 3) for t, x in rows], schema).repartition(5)


@pytest.mark.parametrize("seed, top, first", [(1, 2000, 3), (2, 4, 1), (3, 12, 1)])
def test_against_brute_force(spark, seed, top, first):
    rows = corpus(seed, 900, 60) + [(None, "en"), ("", None), (" \t. ", "en"), ("word " * 9000, "fr"), ("lone", "it")]
    got = co.collocations(frame(spark, rows), top=top, least=8, first=first).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, top, 8)
    assert max(r.rank for r in got) <= top


def test_waves_go_on_until_every_language_is_settled(spark, monkeypatch):
    """One pair for each survivor asked for is not enough where many pairs are dropped by longer phrases."""
    levels, wave = [], co._wave
    monkeypatch.setattr(co, "_wave", lambda *a: levels.append(1) or wave(*a))
    rows = [(f"q{i} z{i} y{i} v{i}", "en") for i in range(12) for _ in range(10)]
    rows += [(f"q{i} other{i % 5}", "en") for i in range(12) for _ in range(10)] + [("s t", "de")] * 10
    got = co.collocations(frame(spark, rows), top=10, least=5, first=1).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 10, 5)
    assert len(levels) > 1


def test_tasks_flush_their_counts(spark, monkeypatch):
    monkeypatch.setattr(co, "HELD", 40)
    batches = corpus(5, 60, 30)
    batch = pa.RecordBatch.from_arrays([pa.array([x or "und" for _, x in batches]), pa.array([t for t, _ in batches])], names=["lang", "text"])
    tally, want = Counter(), Counter()
    counter = co.Tally(2)
    for _, h, piece, _ in co._slices([batch]):
        at = np.flatnonzero(piece[1:] == piece[:-1])
        for i in at.tolist():
            want[(int(h[i]), int(h[i + 1]))] += 1
        for a in range(0, len(at), 7):
            for out in counter.add(h, at[a:a + 7]):
                for r in out.to_pylist():
                    tally[(r["w1"] & (2**64 - 1), r["w2"] & (2**64 - 1))] += r["n"]
    for out in counter.rows():
        for r in out.to_pylist():
            tally[(r["w1"] & (2**64 - 1), r["w2"] & (2**64 - 1))] += r["n"]
    assert tally == want


def test_products_beyond_64_bits(spark):
    big = 3_000_000_000_000_000_000
    df = spark.createDataFrame([(big, big, big + 1), (30, 30, 30)], "a long, l long, r long")
    got = [r.s for r in df.select(co._score(F.col("a"), F.col("l"), F.col("r")).alias("s")).collect()]
    assert got == [2000000 * big // (2 * big + 1), 1000000]


def test_empty_table(spark):
    assert co.collocations(fx.empty(spark)).count() == 0
    assert co.collocations(fx.docs(spark), least=10**6).count() == 0
