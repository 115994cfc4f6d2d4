from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.edges import TEXTS, documents, no_documents, word_list
from touchline.llm import ranked
from touchline.llm.queries import QUERIES

ITEMS = "item_id bigint, text string, score double, doc_id bigint, number int, rank int, name string"


def brute(docs, items, best=10):
    """All items against all documents."""
    counted = [(i, Counter(word_list(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    holding, terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(w for _, c in counted for w in c)
    own = {}
    for i, t in items:
        own.setdefault(i, set()).update(word_list(t))
    out = []
    for item, wanted in own.items():
        found = []
        for doc, c in counted:
            m = 10 + (90 * sum(c.values()) * holding) // terms
            score = 0
            for w in wanted & set(c):
                weight = math.floor(1000 * math.log((2 * holding + 2) / (2 * df[w] + 1)))
                score += weight * ((1000000000 * c[w]) // (1000 * c[w] + 8 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, n + 1, f[3], -f[0]) for n, f in enumerate(sorted(found, key=lambda f: f[:3])[:best])]
    return sorted(out, key=str)


def plain(rows):
    return sorted((tuple(r) for r in rows), key=str)


def items_table(spark, items):
    return spark.createDataFrame([(i, t, 0.1, 5, 1, 2, "n") for i, t in items], ITEMS)


def made_documents():
    random.seed(11)
    common = [f"w{i}" for i in range(30)]
    rare = [f"rare{i}" for i in range(400)]
    docs = [(i, " ".join(random.choices(common, k=random.randint(1, 60)) + random.sample(rare, k=3))) for i in range(700)]
    docs += [(1000 + i, "Same text w1 w2 rare7 RARE8") for i in range(300)]  # one large group of copies
    random.shuffle(docs)
    items = [(i, " ".join(random.choices(common, k=6) + random.sample(rare, k=4) + ["unheard"])) for i in range(25)]
    items += [(30, "rare7 rare8 w1"), (31, None), (32, ""), (33, "nothing known"), (None, "w1 w2 rare5"), (34, "W1"), (34, "rare9"), (35, "w3 w3 w3")]
    return docs, items


@pytest.mark.parametrize("sizes", [{}, {"block_docs": 64}, {"block_docs": 1}, {"block_cells": 300}])
def test_search_equals_all_against_all(spark, sizes):
    docs, items = made_documents()
    docs = docs[:150] + TEXTS if sizes.get("block_docs") == 1 else docs + TEXTS
    index = ranked.build(documents(spark, docs).repartition(3), **sizes)
    assert plain(ranked.rank(index, items_table(spark, items)).collect()) == brute(docs, items)


def test_chunks_of_items_give_the_same(spark):
    docs, items = made_documents()
    docs = docs[:300]
    index = ranked.build(documents(spark, docs), block_docs=100)
    assert plain(ranked.rank(index, items_table(spark, items[:8]), chunk_terms=20, best=3).collect()) == brute(docs, items[:8], 3)


def test_query_on_the_given_tables(spark):
    path = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{path}/benchmark.parquet").select("item_id", "text").collect()]
    got = QUERIES["op12_ranked_search"](spark, path)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert plain(got.collect()) == brute(docs, items)


def test_empty_tables(spark):
    items = items_table(spark, [(1, "plain words")])
    assert ranked.rank(ranked.build(no_documents(spark)), items).collect() == []
    index = ranked.build(documents(spark))
    assert ranked.rank(index, items_table(spark, [])).collect() == []
    assert ranked.rank(index, items_table(spark, [(1, None)])).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 90), st.integers(1, 1_000_000)), min_size=1, max_size=120, unique_by=lambda c: c[:2]))
def test_treap_holds_every_cell_once_under_falling_maxima(cells):
    row, column, value = (np.array(a, np.int64) for a in zip(*cells))
    height, sizes, mask, delta, place = ranked.treap_levels(row, column, value)
    tree = ranked.treap(height, sizes, mask, delta.astype(np.int64), place)
    assert sorted(zip(tree.row.tolist(), tree.column.tolist(), tree.value.tolist())) == sorted(cells)
    for node in range(len(tree.mask)):
        for k in range(ranked.BITS[tree.mask[node]]):
            assert tree.value[tree.first[node] + k] <= tree.value[node]
    assert (delta >= 0).all()


def test_packed_arrays_come_back():
    for kind in (np.uint8, np.uint32, np.int64, np.uint64, np.bool_):
        for n in (0, 1, 1000):
            values = (np.arange(n) * 7919 % 251).astype(kind)
            assert np.array_equal(ranked.unpack(ranked.pack(values), kind), values)


def test_term_counts_equal_words():
    texts = [t for _, t in TEXTS] + ["", "é", "x", None]
    data, offsets = ranked.text_bytes(ranked.pa.array(texts))
    assert ranked.term_counts(data, offsets).tolist() == [len(word_list(t)) for t in texts]


def test_waiting_ranges_are_not_copied_at_every_step(monkeypatch):
    docs, items = made_documents()
    docs, items = docs[:400], [(i, t) for i, t in items if i is not None and i < 30]
    batch = lambda rows, name: ranked.pa.RecordBatch.from_pydict({name: [r[0] for r in rows], "text": [r[1] for r in rows]})
    lengths, doc, key, tf = ranked.doc_terms(batch(docs, "doc_id"))
    corpus = (len(docs), int(lengths.sum()))
    ids = np.array([d[0] for d in docs])
    block = ranked.block_of(ranked.block_row(ids, np.zeros(len(docs), bool), lengths, doc, key, tf, corpus))
    keys, df = np.unique(key, return_counts=True)
    _, item, wanted, _ = ranked.doc_terms(batch(items, "item_id"))
    known = np.isin(wanted, keys)
    item, wanted = item[known], wanted[known]
    queries = ranked.Queries(item, wanted, ranked.weight(df[np.searchsorted(keys, wanted)], len(docs)))
    monkeypatch.setattr(ranked, "STEP", 2)
    monkeypatch.setattr(ranked, "STEP_PAIRS", 100)
    monkeypatch.setattr(ranked, "GROUP_TERMS", 40, raising=False)
    copied, made, largest = [0], [0], [0]
    pick, halved = ranked.Ranges.pick, ranked.halved

    def counted_pick(self, chosen):
        copied[0] += len(self.pair_range)
        largest[0] = max(largest[0], len(self.pair_range))
        return pick(self, chosen)

    def counted_halved(cells, ranges):
        out = halved(cells, ranges)
        made[0] += len(out.pair_range)
        return out

    monkeypatch.setattr(ranked.Ranges, "pick", counted_pick)
    monkeypatch.setattr(ranked, "halved", counted_halved)
    found = ranked.search(block, queries, ranked.NO_ANSWERS, len(items))
    places = ranked.place_in_group(found.item) + 1
    got = [(items[i][0], int(n), int(d), int(s)) for i, n, d, s in zip(found.item, places, found.doc, found.score)]
    assert plain(got) == brute(docs, items)
    assert copied[0] < 6 * made[0]
    assert largest[0] < 400  # twice what one step halves, and some


def test_groups_of_items_keep_items_together():
    item = np.array([0, 0, 0, 2, 2, 5, 6, 6, 6, 6, 6, 9])
    borders = list(ranked.item_groups(item, 4))
    assert borders == [(0, 3), (3, 6), (6, 11), (11, 12)]
    assert list(ranked.item_groups(item[:0], 4)) == []
    assert list(ranked.item_groups(item, 100)) == [(0, 12)]
