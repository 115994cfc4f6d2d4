from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.edges import TEXTS, documents, no_documents, word_list
from touchline.llm import near_dups
from touchline.llm.text import words


def shingles(text):
    w = word_list(text)
    n = min(5, len(w))
    return Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else Counter()


def rarity_of(texts):
    """Rarity by word: documents in the same slot of the table count together."""
    slot = {}
    holding = Counter()
    for _, t in texts:
        own = set(word_list(t))
        for w in own - slot.keys():
            data = np.frombuffer(w.encode(), np.uint8)
            slot[w] = int(near_dups._slot(words(data, np.array([0, len(data)])).key)[0])
        holding.update({slot[w] for w in own})
    return {w: float(np.float32(1 + math.log((1 + len(texts)) / (1 + holding[s])))) for w, s in slot.items()}


def brute_force(texts, similarity=0.8):
    """Classes by comparing all pairs of texts."""
    rare = rarity_of(texts)
    weigh = lambda t: {s: n * round(sum(rare[w] for w in s) / len(s), 3) for s, n in shingles(t).items()}
    distinct = sorted({t or "" for _, t in texts})
    sets, parent = [weigh(t) for t in distinct], list(range(len(distinct)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    close = []
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b:
                both = sum(min(a[s], b[s]) for s in a.keys() & b.keys())
                value = both / (sum(a.values()) + sum(b.values()) - both)
                if abs(value - similarity) < 1e-5:
                    close.append((i, j))
                if value >= similarity:
                    parent[top(i)] = top(j)
    assert not close, "the fixture must not hang on rounding"
    label = {t: top(i) for i, t in enumerate(distinct)}
    smallest = {}
    for d, t in texts:
        if d is not None:
            k = label[t or ""]
            smallest[k] = min(smallest.get(k, d), d)
    return sorted(repr((d, smallest.get(label[t or ""]))) for d, t in texts)


def rows(df):
    return sorted(repr((r["doc_id"], r["class_id"])) for r in near_dups.classes(df).collect())


def made_texts(seed, bases=12, copies=9, size=120):
    random.seed(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    passage = random.choices(vocabulary, k=60)
    texts = []
    for b in range(bases):
        base = random.choices(vocabulary, k=size)
        if b % 3 == 0:
            base[:60] = passage
        for c in range(copies):
            own = base[:]
            for _ in range(c // 2):
                own[random.randrange(len(own))] = random.choice(vocabulary)
            texts.append((len(texts) * 7 % 1009, " ".join(own)))
    return texts


def test_all_kinds_of_rows(spark):
    assert rows(documents(spark)) == brute_force(TEXTS)


@pytest.mark.parametrize("block", [1024, 4])
def test_groups_of_copies_and_shared_passages(spark, monkeypatch, block):
    monkeypatch.setattr(near_dups, "BLOCK", block)
    texts = made_texts(3)
    assert rows(documents(spark, texts).repartition(3)) == brute_force(texts)


def test_samples_agree_as_often_as_the_similarity():
    random.seed(1)
    table = np.full(1 << near_dups.RARITY_BITS, 1.5, np.float32)
    base = [f"a{i}" for i in range(2000)]
    for shared in (400, 1000, 1800):
        other = base[:shared] + [f"b{i}" for i in range(2000 - shared)]
        data = [np.frombuffer(" ".join(t).encode(), np.uint8) for t in (base, other)]
        found = near_dups.weighted_shingles(words(np.concatenate(data), np.array([0, len(data[0]), len(data[0]) + len(data[1])])), table)
        a, b = near_dups.samples(found, 2)
        sets = [set(zip(*[t[i:] for i in range(5)])) for t in (base, other)]
        want = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
        assert abs((a == b).mean() - want) < 0.2


def test_components_of_long_chains(spark):
    edges = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(60) if i % 20 != 19] + [("a", "z"), ("z", "m")]
    got = {r["node"]: r["label"] for r in near_dups.components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert all(got[f"n{i:03d}"] == f"n{i // 20 * 20:03d}" for i in range(60))
    assert got["a"] == got["z"] == got["m"] == "a"


def test_one_document_of_each_class_stays(spark):
    docs = documents(spark)
    left = near_dups.without_copies(docs)
    assert left.columns == docs.columns
    got = sorted(repr((r["doc_id"], r["text"])) for r in left.collect())
    classes = brute_force(TEXTS)
    keep = {eval(c)[1] for c in classes}
    assert sorted(eval(g)[0] for g in got if eval(g)[0] is not None) == sorted(k for k in keep if k is not None)
    assert len(got) == len(set(got)) and not any(eval(g)[0] is None for g in got)


def test_without_ids_one_row_per_text_stays(spark):
    docs = documents(spark, [(None, "a b c"), (None, "a b c"), (None, "x"), (4, "y"), (4, "y"), (4, "z")])
    got = sorted((r["doc_id"] or 0, r["text"]) for r in near_dups.without_copies(docs).collect())
    assert got == [(0, "a b c"), (0, "x"), (4, "y")] or got == [(0, "a b c"), (0, "x"), (4, "y"), (4, "z")]


def test_empty_table(spark):
    assert near_dups.classes(no_documents(spark)).collect() == []
    assert near_dups.without_copies(no_documents(spark)).collect() == []


def test_all_pairs_at_once_equal_pairs_one_by_one():
    texts = [t for _, t in made_texts(5, bases=3, copies=4, size=60)] + ["x y " * 40, "x y " * 30, "", "one", None]
    random.seed(2)
    table = np.random.default_rng(1).uniform(1, 9, 1 << near_dups.RARITY_BITS).astype(np.float32)

    def found(rows):
        data = [np.frombuffer((t or "").encode(), np.uint8) for t in rows]
        return near_dups.weighted_shingles(words(np.concatenate(data), np.cumsum([0] + [len(d) for d in data])), table)

    n = len(texts)
    square = near_dups._all_similarities(found(texts), n)
    left, right = [texts[i // n] for i in range(n * n)], [texts[i % n] for i in range(n * n)]
    single = near_dups.similarities(found(left), found(right), n * n).reshape(n, n)
    off = ~np.eye(n, dtype=bool)
    assert np.allclose(square[off], single[off])


def test_units_alone_find_the_classes(spark):
    """The exact comparison of units, asked for all pairs, joins what brute force joins."""
    texts = made_texts(9, bases=5, copies=8)
    docs = documents(spark, texts)
    table = spark.sparkContext.broadcast(near_dups.rarity(docs))
    found = near_dups.written(near_dups.nodes(docs, table), "nodes")
    rows = near_dups.units(near_dups.members(found), None).join(found.select("node", "total"), "node")
    named = docs.select(near_dups.text_name().alias("node"), "text").distinct()
    labels = near_dups.components(near_dups.verified_units(rows, named, table, 0.8))
    label = {r["node"]: r["label"] for r in labels.collect()}
    of = {r["text"]: label.get(r["node"], r["node"]) for r in named.collect()}
    want = [eval(c) for c in brute_force(texts)]
    smallest = {}
    for d, t in texts:
        smallest[of[t]] = min(smallest.get(of[t], d), d)
    assert sorted(repr((d, smallest[of[t]])) for d, t in texts) == sorted(map(repr, want))


def joined(n, edges):
    """The smallest member of each one's component."""
    label = list(range(n))
    for a, b in edges:
        old, new = max(label[a], label[b]), min(label[a], label[b])
        label = [new if x == old else x for x in label]
    return label


def test_a_forest_joins_what_the_pairs_join():
    graphs = [(6, [(0, 1), (1, 2), (2, 3), (3, 4), (4, 5)])]
    rng = random.Random(4)
    for n, links in [(40, 1), (200, 1), (500, 8), (500, 15)]:
        graphs.append((n, [(i, rng.randrange(n)) for i in range(n) for _ in range(links)]))
    graphs.append((90, [(i, i + 1) for i in rng.sample(range(89), 89) if i % 30 != 29]))
    for n, pairs in graphs:
        linked = np.zeros((n, n), bool)
        for a, b in pairs:
            linked[a, b] = linked[b, a] = a != b
        edges = near_dups._forest(linked)
        want = joined(n, pairs)
        assert joined(n, edges) == want and len(edges) == n - len(set(want))
        assert all(linked[a, b] for a, b in edges)


@pytest.mark.parametrize("block", [512, 7])
def test_units_join_chains_and_sparse_groups(spark, monkeypatch, block):
    monkeypatch.setattr(near_dups, "BLOCK", block)
    random.seed(6)
    texts = []
    for length in (40, 6, 2):  # in a chain only neighbours are alike
        own = [f"w{random.randrange(10**6)}" for _ in range(100 + 8 * length)]
        texts += [" ".join(own[8 * i : 8 * i + 100]) for i in range(length)]
    docs = documents(spark, list(enumerate(texts)))
    table = spark.sparkContext.broadcast(near_dups.rarity(docs))
    found = near_dups.written(near_dups.nodes(docs, table), "nodes")
    bucket = found.selectExpr("1L AS band", f"{len(texts)}L AS size", "node")
    rows = near_dups.units(bucket, None).join(found.select("node", "total"), "node")
    named = docs.select(near_dups.text_name().alias("node"), "text")
    links = near_dups.verified_units(rows, named, table, 0.8)
    label = {r["node"]: r["label"] for r in near_dups.components(links).collect()}
    of = {r["text"]: label[r["node"]] for r in named.collect()}
    groups = [{of[t] for t in texts[a:b]} for a, b in ((0, 40), (40, 46), (46, 48))]
    assert [len(g) for g in groups] == [1, 1, 1] and len(set.union(*groups)) == 3
