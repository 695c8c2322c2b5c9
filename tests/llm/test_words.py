import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import words

from matchspark.llm import words as W


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="abAB é\t\n\x0b\x0c\r\x1c 日", max_size=30)), max_size=6))
def test_splits_like_the_pattern(texts):
    for lo, hi, w in W.batch_words(pa.array(texts, pa.string()), lower=True, limit=16):
        for i in range(lo, hi):
            a, b = w.first[i - lo], w.first[i - lo + 1]
            assert [w.text(k, k + 1).decode() for k in range(a, b)] == words(texts[i])


def test_equal_words_equal_hashes_and_slices():
    texts = pa.array(["One two", "two ONE", None, "x" * 100 + " one"])
    got = [h for _, _, w in W.batch_words(texts, lower=True, limit=4) for h in w.hash.tolist()]
    assert got[0] == got[3] == got[5] and got[1] == got[2] and len(set(got)) == 3
    sliced = next(iter(W.batch_words(texts.slice(1, 1), lower=True)))[2]
    assert sliced.hash.tolist() == got[2:4]


def test_grams():
    h = np.arange(6, dtype=np.uint64)
    assert len(W.grams(h, 5)) == 2 and len(W.grams(h, 7)) == 0
    assert W.grams(h[1:], 2)[0] == W.grams(h, 2)[1]
