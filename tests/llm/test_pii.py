from __future__ import annotations

import re
import time

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.edges import TEXTS, documents, no_documents
from touchline.llm import pii


def brute_base(text):
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(s):
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(s))]
        return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0

    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    cards = re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
    out += [("card", *m.span()) for m in cards if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    phones = re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
    return out + [("phone", *m.span()) for m in phones if 9 <= len(digits(m[0])) <= 15]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab@.0123456789 +-()%é", max_size=60))
def test_base_spans_are_those_of_the_patterns(text):
    assert pii.base_spans(text) == brute_base(text)


def test_base_spans_of_planted_cases():
    text = "x 4111 1111 1111 1111, 4111111111111112 me.you+tag@mail-1.example.co.uk 256.1.1.1 1.2.3.255 +49 (30) 1234-5678, 000.001.002.003"
    assert pii.base_spans(text) == brute_base(text)
    assert [k for k, _, _ in pii.base_spans(text)] == ["email", "ip", "ip", "card", "phone"]


def test_long_runs_take_linear_time():
    for text in ["a" * 300_000 + " x@y.de", "1" * 300_000 + " +", "token" * 60_000 + " = at dot", "1" + " " * 300_000 + "2", "1." * 150_000,
                 "a@" * 100_000 + "b.c", "+1 " * 100_000, "at (at) dot " * 20_000]:
        began = time.monotonic()
        pii.candidates(text)
        assert time.monotonic() - began < 10
    assert pii.base_spans("a@b@c.d@e.f") == brute_base("a@b@c.d@e.f")


def made_texts():
    texts = [(i, f"Line {i} of plain words. Write to user{i}@mail.example.com or call +1 (555) 010-{1000 + i} soon.") for i in range(60)]
    texts += [(100 + i, f"Here token = \"{i:04d}ab77cd9012ef34{i:04d}\" was set, see version {i}.2.{i} of page 12.") for i in range(40)]
    return texts + [(300 + d, t) for d, t in [(0, "write user (at) mail dot example dot com today"), (1, "nothing here 12")]]


def test_base_spans_stay_and_the_method_adds_some(spark):
    docs = documents(spark, made_texts() + TEXTS)
    model = pii.train(docs)
    got = pii.find(docs, model, name="found").collect()
    assert len(got) == docs.count()
    added = set()
    for r in got:
        text = r["text"] or ""
        assert [(s["kind"], s["start"], s["end"]) for s in r["found"] if s["base"]] == brute_base(text)
        added |= {text[s["start"] : s["end"]][:8] for s in r["found"] if not s["base"]}
        assert r["found"] == sorted(r["found"], key=lambda s: (pii.KINDS.index(s["kind"]), s["start"]))
    assert "token = " in added


def planted(rounds=40):
    """(text, what the method should add, what it should leave)."""
    out = []
    for i in range(rounds):
        card = f"4{i:03d}56{i % 10}8"
        whole = next(f"{card}{n:08d}" for n in range(10) if pii.luhn(f"{card}{n:08d}"))
        broken = whole[:-1] + str((int(whole[-1]) + 1) % 10)
        dotted = ".".join(whole[k : k + 4] for k in range(0, 16, 4))
        out += [
            (f"My credit card is {dotted} thanks {i}.", [dotted], []),
            (f"The row id {broken} stands in line {i}.", [], [broken]),
            (f"Long digits {whole}{broken} of a hash {i}", [], [whole, broken]),
            (f"Please call (555) {200 + i}-{1000 + 37 * i} or fax later", [f"(555) {200 + i}-{1000 + 37 * i}"], []),
            (f"It was on 2021-04-{10 + i % 18} 12{i % 10} that they met", [], [f"2021-04-{10 + i % 18}"]),
            (f"See page {1000000 + 7919 * i} of the issue", [], [str(1000000 + 7919 * i)]),
            (f"Contact user{i} (at) mail (dot) example (dot) com by mail", [f"user{i} (at) mail (dot) example (dot) com"], []),
            (f"Set api_key = 'a9f3k2{i:03d}Zq8x7' in the file", [f"api_key = 'a9f3k2{i:03d}Zq8x7"], []),
            (f"Base ones: a{i}@example.com, +1 (555) 010-{1000 + i}, 10.0.{i}.7", [], []),
        ]
    return out


def test_precision_and_recall_on_planted_spans(spark):
    cases = planted()
    docs = documents(spark, [(i, t) for i, (t, _, _) in enumerate(cases)])
    got = {r["doc_id"]: r for r in pii.find(docs, pii.train(docs)).collect()}
    found = wrong = wanted = 0
    for i, (text, add, leave) in enumerate(cases):
        added = [text[s["start"] : s["end"]] for s in got[i]["spans_"] if not s["base"]]
        wanted += len(add)
        found += sum(any(a in x or x in a for x in added) for a in add)
        wrong += sum(not any(a in x or x in a for a in add) for x in added)
        for s in got[i]["spans_"]:
            assert s["kind"] != "phone" or sum(c.isdigit() for c in text[s["start"] : s["end"]]) <= 15
    assert found >= 0.9 * wanted and wrong <= 0.05 * wanted, (found, wrong, wanted)


def test_a_gazetteer_is_a_parameter():
    own = pii.Gazetteer({k: ("zorp",) if k == "phone" else () for k in pii.KINDS}, ("blick",))
    votes = lambda text: [c.votes[1:3] for c in pii.candidates(text, own)]
    assert votes("zorp 555 123 4567") == [(1, 0)] and votes("call 555 123 4567") == [(0, 0)] and votes("blick 555 123 4567") == [(0, -1)]


def test_the_model_does_not_hang_on_partitions(spark):
    one = pii.train(documents(spark, made_texts()).repartition(1))
    two = pii.train(documents(spark, made_texts()).repartition(6))
    assert np.array_equal(one.weights, two.weights) and one.bias == two.bias


def test_reliabilities_follow_the_labelers_that_agree():
    patterns = {(1, 1, 0): 500, (-1, -1, 0): 500, (1, 1, -1): 20, (-1, -1, 1): 20, (0, 0, 1): 5}
    chances = pii.reliabilities(patterns)
    assert chances[(1, 1, -1)] > 0.9 and chances[(-1, -1, 1)] < 0.1
    assert pii.reliabilities({}) == {}


def test_masking(spark):
    docs = documents(spark, [(1, "a b@c.de x"), (2, None), (3, "")])
    model = pii.Model(np.zeros(1 << pii.FEATURE_BITS), -9.0)
    left = pii.masked(docs, model)
    assert left.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in left.collect()} == {1: "a [email] x", 2: None, 3: ""}
    assert pii.mask("0123456789", [(2, 5, "a"), (4, 7, "b"), (8, 9, "c")]) == "01[a]7[c]9"


def test_empty_table(spark):
    model = pii.train(no_documents(spark))
    assert pii.find(no_documents(spark), model, name="found").collect() == []
