"""Exact deduplication against brute force: one run, runs in steps, digests that collide."""

import hashlib

import pytest
from pyspark.sql import functions as F

from matchspark.llm import copies
from tests.llm import llm_fixtures as fx


def brute(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault((text or "").translate(fx.LOWER), []).append(i)
    out = []
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        out += [(i, keep, len(ids)) for i in ids]
    return sorted(out, key=repr)


def check(found, rows):
    got = found.collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in got), key=repr) == brute(rows)
    # one row of every group stays, and it is one with the largest id
    groups = {(text or "").translate(fx.LOWER) for _, text in rows}
    stay = [r for r in got if r.kept]
    assert len(stay) == len(groups)
    assert all(r.doc_id == r.keep_id for r in stay)


@pytest.fixture()
def awkward(spark):
    base = fx.rows()
    long = "Very LONG text " * 20_000
    extra = [(1000, base[7][1]), (1001, long), (1002, long.lower()), (1003, "ÉLAN"), (1004, "élan"), (1005, "ÉLaN"), (None, "Lone"),
             (None, "twice"), (None, "TWICE"), (1006, None), (1006, "repeated Id"), (1006, "REPEATED id"), (1007, "repeated id "),
             (7, "Same"), (7, "same"), (None, "same")]
    extra += [(2000 + k, "one Hot text") for k in range(400)]
    schema = fx.SCHEMA + ", digest string, file int, row string, kept int, n int, norm string"
    full = [(*r, "x", 1, "y", 2, 3, "z") for r in base] + [
        (i, t, "en", "s", None, "k", -1, 7, "z", "x", 1, "y", 2, 3, "z") for i, t in extra]
    return spark.createDataFrame(full, schema).repartition(3), [(r[0], r[1]) for r in full]


def test_whole_table(spark, awkward, tmp_path):
    df, rows = awkward
    df.write.parquet(f"{tmp_path}/docs")
    found = copies.exact_duplicates(spark, f"{tmp_path}/docs")
    check(found, rows)
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    want = {(i, (t or "").translate(fx.LOWER)) for i, t in rows}
    assert {(r.doc_id, r.text_sha256) for r in found.collect()} == {(i, hashlib.sha256(t.encode()).hexdigest()) for i, t in want}


def test_digests_that_collide_are_told_apart_by_their_bytes(spark, awkward, tmp_path):
    df, rows = awkward
    df.write.parquet(f"{tmp_path}/docs")
    weak = lambda text: F.unhex(F.concat(F.lit("0"), F.substring(F.sha2(text, 256), 1, 1)))
    check(copies.exact_duplicates(spark, f"{tmp_path}/docs", digest=weak), rows)


def test_new_files_alone_are_read_when_called_again(spark, awkward, tmp_path):
    df, rows = awkward
    path, store = f"{tmp_path}/docs", f"{tmp_path}/store"
    first, second = df.filter("doc_id % 2 = 0 or doc_id is null"), df.filter("doc_id % 2 = 1")
    first.write.parquet(path)
    check(copies.exact_duplicates(spark, path, store), [r for r in rows if r[0] is None or r[0] % 2 == 0])
    second.write.mode("append").parquet(path)
    check(copies.exact_duplicates(spark, path, store), rows)
    assert spark.read.parquet(f"{store}/rows").count() == len(rows)
    check(copies.exact_duplicates(spark, path, store), rows)   # nothing new


def test_single_file_and_empty_table(spark, tmp_path):
    import pandas as pd
    pd.DataFrame({"doc_id": [1, 2], "text": ["a", "A"]}).to_parquet(f"{tmp_path}/one.parquet")
    pd.DataFrame({"doc_id": [9], "text": ["other file of the folder"]}).to_parquet(f"{tmp_path}/two.parquet")
    check(copies.exact_duplicates(spark, f"{tmp_path}/one.parquet"), [(1, "a"), (2, "A")])
    fx.empty(spark).write.parquet(f"{tmp_path}/none")
    assert copies.exact_duplicates(spark, f"{tmp_path}/none").count() == 0
