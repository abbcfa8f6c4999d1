import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from quizlake.llm import tokens as t
from tests.llm.helpers import alnum, spaced

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aZ09 .\t\né　\U0001F600_", max_size=40)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 30))
def test_words_match_the_patterns(texts, limit):
    for rule, make in ((spaced, t.spaced_words), (alnum, t.alnum_words)):
        got = [None] * len(texts)
        for lo, hi, data, off in t.chunks(pa.array(texts, pa.string()), limit):
            w = make(data, off)
            for i in range(hi - lo):
                pick = range(w.first[i], w.first[i] + w.count[i])
                got[lo + i] = [w.data[w.start[j]:w.end[j]].tobytes().decode() for j in pick]
        assert got == [rule(x) for x in texts]


def test_equal_words_have_equal_hashes_wherever_they_stand():
    texts = ["alpha beta alpha", "Beta", "", "gamma alpha"]
    (_, _, data, off), = t.chunks(pa.array(texts))
    w = t.spaced_words(data, off)
    h = w.hashes()
    names = [w.data[a:b].tobytes() for a, b in zip(w.start, w.end)]
    assert len(set(h.tolist())) == len(set(names)) == 3
    assert all(h[i] == h[j] for i in range(len(h)) for j in range(len(h)) if names[i] == names[j])


def test_shingles_of_short_texts():
    (_, _, data, off), = t.chunks(pa.array(["a b c d e f", "a b", "", "a b c d e"]))
    w = t.spaced_words(data, off)
    doc, h = t.shingle_hashes(w.hashes(), w, 5)
    assert doc.tolist() == [0, 0, 1, 3] and h[0] == h[3] and len(np.unique(h)) == 3
