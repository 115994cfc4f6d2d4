from __future__ import annotations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.edges import LONG, word_list
from touchline.llm import text as T


def spelled(texts):
    data, offsets = T.text_bytes(pa.array(texts, pa.string()))
    found = T.words(data, offsets)
    low = T.WORD_BYTES[data].tobytes()
    return [
        [low[found.start[i] : found.end[i]].decode() for i in range(found.first[d], found.first[d + 1])]
        for d in range(len(texts))
    ], found


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aZ9 é-日_\n", max_size=12)), max_size=6))
def test_words_are_those_of_the_pattern(texts):
    assert spelled(texts)[0] == [word_list(t) for t in texts]


def test_equal_words_have_equal_keys_wherever_they_stand():
    lists, found = spelled(["alpha beta", None, "beta ALPHA " + LONG, "x"])
    names = [w for own in lists for w in own]
    by_name, by_key = {}, {}
    for name, key in zip(names, found.key.tolist()):
        assert by_name.setdefault(name, key) == key
        assert by_key.setdefault(key, name) == name


def test_a_word_longer_than_a_chunk_is_one_word(monkeypatch):
    monkeypatch.setattr(T, "SLICE_BYTES", 50)
    lists, found = spelled(["a " * 40 + "b" * 400 + " c", "b" * 400])
    assert lists[0][-2:] == ["b" * 400, "c"]
    assert found.key[-1] == found.key[-3]


def test_slices_hold_all_rows_in_order():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 30, None, "b" * 5, "", "c" * 100]), pa.array(range(5))], ["text", "n"])
    parts = list(T.slices(batch, limit=32))
    assert [x for p in parts for x in p.column("n").to_pylist()] == list(range(5))
    assert all(p.num_rows == 1 or sum(len(t or "") for t in p.column("text").to_pylist()) <= 32 for p in parts)


def test_free_name():
    assert T.free_name("score", ["Score", "score_"], ["SCORE__"]) == "score___"


def test_window_keys_hang_on_order():
    key = np.array([1, 2, 1, 2, 1], np.uint64)
    pairs = T.window_keys(key, 2)
    assert pairs[0] == pairs[2] and pairs[1] == pairs[3] and pairs[0] != pairs[1]
    assert not len(T.window_keys(key, 6))
