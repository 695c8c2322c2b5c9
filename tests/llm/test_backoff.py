import math
import random
from collections import Counter

import pytest
from llm_fixtures import docs, empty, rows, words
from pyspark.sql import GroupedData

from matchspark.llm import backoff


def plain_whole(source):
    texts = [(d, words(t, lower=True)) for d, t in source]
    count = [Counter(tuple(t[i:i + n]) for _, t in texts for i in range(len(t) - n + 1)) for n in (1, 2, 3)]
    total, out = sum(count[0].values()), {}
    for d, t in texts:
        s = 0.0
        for i in range(len(t)):
            gram = tuple(t[max(0, i - 2):i + 1])
            s += math.log(count[len(gram) - 1][gram] / (count[len(gram) - 2][gram[:-1]] if i else total))
        n, old = out.get(d, (0, 0.0))
        out[d] = (n + len(t), old + s)
    return out


@pytest.mark.parametrize("hot,bucket,held", [(1 << 14, 10**6, 10**6), (1 << 14, 500, 10**6), (0, 500, 10**6), (0, 100, 20)])
def test_whole_scores_equal_brute_force(spark, monkeypatch, hot, bucket, held):
    monkeypatch.setattr(backoff, "HELD_SUMS", held)
    monkeypatch.setattr(backoff, "HOT_GRAMS", hot)
    monkeypatch.setattr(backoff, "GRAM_BUCKET", bucket)
    tail = rows()[0][2:]
    extra = [(900, "word", *tail), (900, "once Only rare", *tail), (901, "two words two", *tail)]
    got = {r.doc_id: r for r in backoff.whole_scores(docs(spark, extra)).collect()}
    want = plain_whole([(r[0], r[1]) for r in [*rows(), *extra]])
    assert got.keys() == want.keys()
    for d, (n, s) in want.items():
        assert got[d].n_words == n and got[d].log_score == pytest.approx(s, abs=1e-8)
        assert got[d].mean_log_score == (pytest.approx(s / n, abs=1e-8) if n else 0.0)


def test_whole_scores_of_empty_table_and_null_ids(spark):
    assert backoff.whole_scores(empty(spark)).count() == 0
    df = spark.createDataFrame([(None, "a b"), ((1 << 60) + 1, "a b c"), (2, None)], "doc_id long, text string")
    assert {r.doc_id: r.n_words for r in backoff.whole_scores(df).collect()} == {None: 2, (1 << 60) + 1: 3, 2: 0}


def test_slices_of_a_task_share_their_rows(spark, monkeypatch):
    """Rows for the buckets follow the grams, not slices x buckets."""
    rnd = random.Random(3)
    texts = [(i, " ".join(f"w{rnd.randrange(400)}" for _ in range(60))) for i in range(200)]
    monkeypatch.setattr(backoff, "HOT_GRAMS", 0)
    monkeypatch.setattr(backoff, "GRAM_SLICE", 300)        # a slice for each text
    monkeypatch.setattr(backoff, "GRAM_BUCKET", 2000)      # 12 buckets
    df = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    seen, real = [], GroupedData.applyInArrow

    def counted(self, fn, schema):
        if schema == backoff.SUMS:
            seen.append(self._df.count())
        return real(self, fn, schema)
    monkeypatch.setattr(GroupedData, "applyInArrow", counted)
    got = {r.doc_id: r.log_score for r in backoff.whole_scores(df).collect()}
    assert got == pytest.approx({d: s for d, (_, s) in plain_whole(texts).items()}, abs=1e-8)
    assert seen and seen[0] <= 13


def test_a_task_has_one_python_worker_and_small_batches(spark, monkeypatch):
    """What each worker and each batch takes of an executor adds up to its memory: sums leave the worker that counts added
    over its buckets, marks come from the worker that reads, and Arrow batches have a lower limit than Spark's."""
    rnd = random.Random(4)
    texts = [(i, " ".join(f"w{rnd.randrange(400)}" for _ in range(60))) for i in range(100)] + [(100, "single")]
    monkeypatch.setattr(backoff, "HOT_GRAMS", 0)
    monkeypatch.setattr(backoff, "GRAM_BUCKET", 1000)      # 13 buckets, two parts
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    df = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    workers, sums = [], []
    real_sum, real_apply = backoff.sum_counters, GroupedData.applyInArrow

    def summed(frame, size):
        workers.append(frame._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow"))
        return real_sum(frame, size)

    def applied(self, fn, schema):
        out = real_apply(self, fn, schema)
        if schema == backoff.SUMS:
            sums.append(out.filter("words is null").count())
        return out
    monkeypatch.setattr(backoff, "sum_counters", summed)
    monkeypatch.setattr(GroupedData, "applyInArrow", applied)
    got = {r.doc_id: r.log_score for r in backoff.whole_scores(df).collect()}
    assert got == pytest.approx({d: s for d, (_, s) in plain_whole(texts).items()}, abs=1e-8)
    assert workers == [1, 1] and sums == [2]
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 4 << 20
