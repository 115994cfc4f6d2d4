from __future__ import annotations

import math
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.edges import TEXTS, documents, no_documents
from touchline.llm import secret_scan as scan

FILL = "The river and the garden belong to the sunshine of a monkey, and the dragon said hello to my horse. "
KEY = "9f8e7d6c5b4a39281706f0e1"
PLANTED = [
    (100, f"set pwd = 'kX9#vQ2!mZ7w' now", ["kX9#vQ2!mZ7w"]),
    (101, "curl -H 'Authorization: Bearer qJ8zR4tYw1LpK0sV' https://x.example", ["qJ8zR4tYw1LpK0sV"]),
    (102, "clone https://bob:Zq81-vvX_09rt@git.example/repo", ["Zq81-vvX_09rt"]),
    (103, "passphrase: sunshine-monkey", []),
    (104, "pwd: qwertyuiop", []),
    (105, "pwd = 12345678", []),
    (106, "pwd=aaaaaaaaaaaaaaaaaaaaaaaa", []),
    (107, "pwd = 1987-05-23", []),
    (108, "client_secret => 'W8r-Tn.22x_Lq0Zb'", ["W8r-Tn.22x_Lq0Zb"]),
    (109, "a keyword here, and a passing token of love", []),
    (110, "pwd = " + "Qz7!xV2#pL9$" * 1, ["Qz7!xV2#pL9$"]),
    (111, "pwd = " + "z" * 3000, []),
    (112, "pwd = " + "z" * 1500 + "kX9#vQ2!mZ7wR8%tYq", ["z" * 1500 + "kX9#vQ2!mZ7wR8%tYq"]),
]


def brute_base(text):
    """The patterns as they are worded, case by case."""
    found = []
    for m in re.finditer(r"((?:(?ia:password|passwd|secret|token|api_?key)))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        found.append(("assign", *m.span(), len(m[2]) >= 12))
    found += [("access", *m.span(), len(m[0]) >= 18) for m in re.finditer("AKIA[A-Z0-9]+", text)]
    found += [("hex", *m.span(), len(m[0]) >= 16) for m in re.finditer("[0-9a-f]+", text)]
    kept = [f[:3] for f in found if f[3]]
    return sorted(kept, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(["password", "PassWD", "secret", "toKEN", "api_key", "apikey", " ", "=", ":", '"', "'", "AKIA", "AB12CDEF", "0123456789abcdef", "fe", "é", "ſecret", "abcdefghijkl", "/_.=-", "xyz"]), max_size=12))
def test_base_spans_are_those_of_the_patterns(pieces):
    text = "".join(pieces)
    assert scan.base_spans(text) == brute_base(text)


def test_dropped_matches_are_not_tried_again():
    text = 'password: token="abcdefghijklmnop" AKIAAKIA123 0123456789abcde'
    assert scan.base_spans(text) == brute_base(text) == []


def every_cut(value, words):
    """All ways to cut a value into segments."""
    known = {}
    for i, j, bits in scan.segments(value, words):
        known[i, j] = min(bits, known.get((i, j), math.inf))
    for i, j, unit in scan.repeats(value):
        for end in range(i + unit * (3 if unit == 1 else 2), j + 1, unit):
            bits = every_cut_plain(value[i : i + unit], words) + math.log2((end - i) // unit)
            known[i, end] = min(bits, known.get((i, end), math.inf))
    return cut(value, known)


def every_cut_plain(value, words):
    known = {}
    for i, j, bits in scan.segments(value, words):
        known[i, j] = min(bits, known.get((i, j), math.inf))
    return cut(value, known)


def cut(value, known):
    best = math.inf
    for borders in range(1 << max(0, len(value) - 1)):
        at, bits = 0, 0.0
        for end in range(1, len(value) + 1):
            if end == len(value) or borders >> (end - 1) & 1:
                tried = sum(map(scan._char_bits, value[at:end]))
                bits += min(tried, known.get((at, end), math.inf)) + scan.SEGMENT_BITS
                at = end
        best = min(best, bits)
    return best


@settings(max_examples=120, deadline=None)
@given(st.text(alphabet="abcqwe1234A@0x", min_size=1, max_size=9))
def test_cost_is_the_least_of_all_cuts(value):
    words = {"abc": 5.0, "wea": 3.0, "eab": 7.0, "cab": 2.0, "abcqw": 6.0}
    assert math.isclose(scan.guess_bits(value, words), every_cut(value, words))


def test_costs_of_known_shapes():
    words = {"sunshine": 12.0, "monkey": 13.0, "password": 8.0}
    cost = lambda v: scan.guess_bits(v, words)
    for cheap in ("sunshine", "Sunshine1", "p@ssw0rd", "qwertyuiop", "abcdefgh", "87654321", "zzzzzzzzzzzz", "monkeymonkeymonkey", "23.05.1987", "password1999"):
        assert cost(cheap) < scan.THRESHOLD, cheap
    for dear in ("kX9#vQ2!mZ7w", "qJ8zR4tYw1LpK0sV", "f3c9a17e0b52d864"):
        assert cost(dear) > scan.THRESHOLD, dear
    assert cost("sunshine") < cost("Sunshine") < cost("SuNshIne") and cost("monkey") < cost("m0nkey")


def test_letter_words_equal_a_plain_search():
    texts = [t for _, t in TEXTS] + ["abc", "ABCdef ghi1jkl", "", None, "x" * 16, "x" * 17, "é" + "abc" * 3, "tail"]
    got = Counter(scan.letter_words(*scan.text_bytes(pa.array(texts))).tolist())
    words = [w.lower() for t in texts for w in re.findall("[A-Za-z]+", t or "") if 3 <= len(w) <= 16]
    keys = {w: next(iter(scan.part_keys(w).values())) if len(w) == 3 else scan.part_keys(w)[w] for w in set(words)}
    assert got == Counter(keys[w] for w in words)


def test_planted_values_are_found_and_cheap_ones_left(spark):
    texts = [(i, FILL * 3) for i in range(60)] + [(i, t) for i, t, _ in PLANTED] + [(200, f'token = "{KEY}"'), (200, f'token = "{KEY}"')] + TEXTS
    docs = documents(spark, texts)
    got = scan.scan(docs.repartition(5), docs.columns).collect()
    assert len(got) == len(texts)
    assert list(got[0].asDict())[: len(docs.columns)] == docs.columns and "spans_" in got[0].asDict()
    wanted = {i: v for i, _, v in PLANTED}
    for r in got:
        text, spans = r["text"] or "", r["spans_"]
        assert [(s["kind"], s["start"], s["end"]) for s in spans if s["base"]] == brute_base(text)
        assert spans == sorted(spans, key=lambda s: (s["start"], scan.KINDS.index(s["kind"])))
        added = [text[s["start"] : s["end"]] for s in spans if not s["base"]]
        assert added == wanted.get(r["doc_id"], []), r["doc_id"]
        if r["doc_id"] == 200:
            assert spans[0]["kind"] == "assign" and spans[0]["bits"] > 60
    again = scan.scan(docs.repartition(2), ["doc_id", "text"]).collect()
    assert sorted((str(r["doc_id"]), r["text"] or "", r["spans"]) for r in again) == sorted((str(r["doc_id"]), r["text"] or "", r["spans_"]) for r in got)


def test_long_texts_take_linear_time():
    for text in ["token" * 60_000, "password" + " " * 300_000, "AKIA" * 60_000, "0" * 300_000 + "g", "0123456789abcdeg" * 20_000,
                 "pwd=" * 50_000, "secret_" * 40_000, "bearer " * 40_000, "://a:" * 50_000]:
        began = time.monotonic()
        scan.base_spans(text), scan.values(text)
        assert time.monotonic() - began < 10
    began = time.monotonic()
    for piece in ["as" * 256, "a" * 512, "abc" * 170, "qw1Z" * 128]:
        scan.guess_bits(piece, {p: 5.0 for p in scan.parts(piece)})
    assert time.monotonic() - began < 10


def test_empty_table(spark):
    assert scan.scan(no_documents(spark), ["doc_id"]).collect() == []
    assert np.array_equal(scan.letter_words(*scan.text_bytes(pa.array([], pa.string()))), [])
