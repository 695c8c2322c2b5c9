import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import docs, empty, rows
from tokenizers import Tokenizer

from matchspark.llm import packing
from matchspark.llm.words import slices

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [1]


def check(got, source, max_len):
    pieces = {(r.doc_id, r.piece): r for r in got}
    want = {(d, k // max_len): ids(t)[k:k + max_len] for d, t in source for k in range(0, len(ids(t)), max_len)}
    assert pieces.keys() == want.keys() and len(got) == len(want)
    for k, w in want.items():
        assert np.frombuffer(pieces[k].ids, "<u4").tolist() == w
        assert zlib.crc32(pieces[k].ids) == zlib.crc32(np.array(w, "<u4").tobytes())
    at = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
        assert at[r.sequence_id] <= max_len
    return len(at)


@pytest.mark.parametrize("max_len", [64, 4096])
def test_pieces_and_places(spark, max_len):
    got = packing.pack(docs(spark), PATH, max_len).collect()
    source = [(r[0], r[1]) for r in rows()]
    n = check(got, source, max_len)
    total = sum(len(ids(t)) for _, t in source)
    assert n <= 1.2 * total / max_len + 1


def test_empty_table_and_repeated_rows(spark):
    assert packing.pack(empty(spark), PATH).count() == 0
    twice = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string")
    got = packing.pack(twice, PATH).collect()
    assert len(got) == 3 and len({(r.sequence_id, r.offset) for r in got}) == 3


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aBcé' .,!?<|endoftx>0½ßŸ́\t\n  日", max_size=60))
def test_chunks_have_the_ids_of_the_whole(text):
    table = packing._chunk_ids(PATH)
    chunks = packing._split(text)
    long = table.fill(set(chunks))
    got = np.frombuffer(b"".join(table[c] if c in table else long[c] for c in chunks), "<u4").tolist()
    assert got == ids(text)[:-1]


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 40), max_size=12))
def test_plan_places_every_rank_once(histogram):
    used, ranks = {}, {}
    for length, a, b, first, offset in packing.best_fit_plan(histogram, 50):
        ranks.setdefault(length, []).extend(range(a, b))
        for k in range(b - a):
            used.setdefault(first + k, []).append((offset, length))
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in histogram.items()}
    for seq in used.values():
        at = 0
        for offset, length in sorted(seq):
            assert offset == at
            at += length
        assert at <= 50
    if histogram:
        assert len(used) <= 1.3 * sum(n * c for n, c in histogram.items()) / 50 + 1 or max(histogram) > 25


def test_the_tables_of_a_tokenising_worker_are_bounded_and_do_not_change_the_ids():
    from matchspark.llm import queries
    words = [f"{a}{b}ing" for a in ("wander", "ponder", "number") for b in "abcdefghijklmnopqrst"]
    path = queries.word_tokenizer()
    ids = {}
    for kept in (1000, 25):
        packing._TABLES.clear()
        table = packing._chunk_ids(path, kept)
        found = []
        for at in range(0, 60, 10):
            table.fill(set(words[at:at + 10]))
            found += [table[w] for w in words[at:at + 10]]
            assert len(table) <= kept + 10 and len(table.words) <= kept * 3 // 2 + 10
        ids[kept] = found
    packing._TABLES.clear()
    assert ids[1000] == ids[25]
    assert queries.STAGE_KEPT < packing.KEPT


@settings(max_examples=150, deadline=None)
@given(st.lists(st.none() | st.text(alphabet="aBcé' .,!?<|endoftx>0½ßŸÉ×÷́\t\n\r\x0b\x00  日", max_size=60)
                | st.sampled_from(["zqxj" * 4, "zqxj" * 9 + "!", "=" * 40, "a <|endoftext|>b", "ÀÉÎ=õü 2024"]), min_size=1, max_size=8),
       st.sampled_from([1, 30, 400_000]))
def test_slices_have_the_ids_of_every_text(texts, kept):
    col = pa.array(texts, pa.string())
    table = packing._piece_ids(PATH, kept)
    for limit in (40, packing.SLICE):
        got = []
        for _, _, buf, offsets in slices(col, limit):
            data, upto = table.encode(buf, offsets, 1)
            data = np.frombuffer(data, "<u4")
            got += [data[a:b].tolist() for a, b in zip([0, *upto], upto)]
        assert got == [ids(t) for t in texts]


def test_plain_words_take_no_python_object_each():
    """Plain text is looked up by arrays; only chunks with other characters go one by one."""
    packing._TABLES.clear()
    table = packing._piece_ids(PATH)
    text = " ".join(f"Word{a}{b}, {a}É." for a in "abcdefghij" for b in "klmnopqrst") + " don't 日本"
    data, upto = table.encode(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]), 1)
    assert np.frombuffer(data, "<u4").tolist() == ids(text) and upto.tolist() == [len(ids(text))]
    assert len(table.chunks) == 2
    packing._TABLES.clear()
