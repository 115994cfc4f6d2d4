from __future__ import annotations

import pytest

from tests.llm.edges import LONG, PASSAGE, TEXTS, documents, no_documents, word_list
from touchline.llm import decontaminate

ITEMS = [
    (1, PASSAGE),
    (2, " ".join(word_list(LONG)[5000:5030]).upper()),
    (3, "One"),
    (4, "a SECOND line"),
    (5, ""),
    (6, None),
    (7, "second line mail a b example"),
    (8, "ab " * 13),
    (None, " ".join(f"passage{i}" for i in range(20, 40))),
    (7, "here and some more of them follow after that a second line mail"),
]


def benchmark(spark, items=ITEMS):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, words string")


def brute_force(texts, items):
    windows = []
    for item, text in items:
        w = word_list(text)
        n = min(len(w), 13)
        windows += [("" if item is None else str(item), w[i : i + n]) for i in range(len(w) - n + 1)] if n else []
    out = []
    for doc, text in texts:
        w = word_list(text)
        hit, found = set(), set()
        for item, window in windows:
            n = len(window)
            for i in range(len(w) - n + 1):
                if w[i] == window[0] and w[i : i + n] == window:
                    hit |= set(range(i, i + n))
                    found.add(item)
        out.append((doc, len(w), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def test_all_kinds_of_rows_and_items(spark):
    got = decontaminate.report(documents(spark), benchmark(spark)).select("id", "n_words", "n_hit", "items", "contaminated")
    want = brute_force(TEXTS, ITEMS)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


@pytest.mark.parametrize("limit", [0, 10**9])
def test_joins_with_and_without_broadcast_agree(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", limit)
    got = decontaminate.report(documents(spark), benchmark(spark)).select("id", "n_hit").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((d, h)) for d, _, h, _, _ in brute_force(TEXTS, ITEMS))


@pytest.mark.parametrize("size", [1, 2, 6, 7, 12, 13, 14, 27])
def test_an_occurrence_anywhere_is_found(spark, size):
    item = " ".join(f"w{i}" for i in range(size))
    texts = [(k, " ".join(f"x{i}" for i in range(k)) + " " + item + " end") for k in range(9)]
    got = decontaminate.report(documents(spark, texts), benchmark(spark, [(1, item)])).select("id", "n_hit").collect()
    assert sorted(map(tuple, got)) == [(k, size) for k in range(9)]


def test_documents_and_spans_go(spark):
    docs, items = documents(spark), benchmark(spark, ITEMS[:1])
    want = brute_force(TEXTS, ITEMS[:1])
    left = decontaminate.without_contaminated(docs, items)
    assert left.columns == docs.columns
    assert sorted(repr((r["doc_id"], r["text"])) for r in left.collect()) == sorted(
        repr(t) for t, w in zip(TEXTS, want) if not w[4]
    )
    cut = {(r["doc_id"], r["text"]) for r in decontaminate.without_spans(docs, items).collect()}
    assert {(4, "one ending"), (5, "other ending"), (6, "one ending"), (7, "same id, first text "), (1, None), (2, "")} <= cut
    assert sum(t in cut for t in TEXTS) == sum(w[2] == 0 for w in want)


def test_empty_tables(spark):
    assert decontaminate.report(no_documents(spark), benchmark(spark)).collect() == []
    none = decontaminate.report(documents(spark), benchmark(spark, [])).collect()
    assert len(none) == len(TEXTS) and not any(r["contaminated"] or r["n_hit"] or r["items"] for r in none)
    assert decontaminate.without_contaminated(documents(spark), benchmark(spark, [])).count() == len(TEXTS)
