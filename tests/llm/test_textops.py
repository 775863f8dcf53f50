import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import textops as X


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40)), max_size=8))
def test_words_are_those_of_the_definition(texts):
    import re

    column = pa.array(texts, pa.string())
    got = [[] for _ in texts]
    for lo, _, data, offsets in X.text_chunks(column, limit=30):
        low, start, end, row, h = X.words(data, offsets)
        assert len(h) == len(row)
        for a, b, r in zip(start, end, row):
            got[lo + r].append(low[a:b].tobytes())
    for words, text in zip(got, texts):
        low = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
        assert words == re.findall(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def test_slice_hash_does_not_depend_on_the_place():
    data = np.frombuffer(b"abcXabc", np.uint8)
    prefix = X.prefix_hash(data)
    a, b, c = X.slice_hash(prefix, np.array([0, 4, 1]), np.array([3, 7, 4]))
    assert a == b != c


def test_sliced_arrays_keep_their_rows():
    column = pa.array(["a", None, "bcd", "ef"]).slice(1, 3)
    data, offsets = X.text_buffers(column)
    assert [data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])] == [b"", b"bcd", b"ef"]
