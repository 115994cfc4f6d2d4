from __future__ import annotations

import hashlib
import random

import pytest

from tests.llm.edges import TEXTS, documents, no_documents
from touchline.llm import substrings


def brute_force(texts):
    """By a plain loop; texts under one id are read side by side, equal rows are one document."""
    data = [(substrings.LAST_ID if d is None else d, (t or "").encode()) for d, t in texts]
    first = {}
    for doc, text in set(data):
        for i in range(len(text) - 99):
            w, place = text[i : i + 100], (doc, i)
            first[w] = min(first.get(w, place), place)
    out = []
    for (doc, _), (order, text) in zip(texts, data):
        gone = bytearray(len(text))
        for i in range(len(text) - 99):
            if first[text[i : i + 100]] < (order, i):
                gone[i : i + 100] = b"\1" * 100
        kept = bytes(b for b, x in zip(text, gone) if not x)
        runs = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((doc, len(text), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(map(repr, out))


def rows(df):
    return sorted(map(repr, map(tuple, substrings.without_repeats(df, digests=True).collect())))


def made_texts(seed):
    random.seed(seed)
    passages = ["".join(random.choice("abcd é\n") for _ in range(random.choice([90, 120, 400]))) for _ in range(6)]
    texts = []
    for i in range(120):
        parts = [random.choice([*passages, "ab" * random.randint(1, 150), "x" * random.randint(1, 300)]) for _ in range(3)]
        cut = random.randint(0, 80)
        texts.append((i * 3 % 121, ("".join(random.choice("efgh") for _ in range(40))).join(parts)[cut:]))
    return texts


def test_all_kinds_of_rows(spark):
    apart = [t for t in TEXTS if t[0] not in (7,)]
    assert rows(documents(spark, apart)) == brute_force(apart)
    assert len(rows(documents(spark))) == len(TEXTS)


def test_the_largest_id_is_no_missing_one(spark):
    passage = TEXTS[4][1]
    docs = documents(spark, [(substrings.LAST_ID, "a" + passage), (None, "b" + passage), (substrings.LAST_ID, "alone")])
    got = sorted((r["doc_id"] is None, r["n_bytes"]) for r in substrings.without_repeats(docs).collect())
    n = len(passage) + 1
    assert got == [(False, 5), (False, n), (True, n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_texts_with_shared_passages(spark, seed):
    texts = made_texts(seed)
    assert rows(documents(spark, texts).repartition(4)) == brute_force(texts)


def test_hot_anchors_many_shards_and_long_texts(spark, monkeypatch):
    texts = made_texts(3)
    texts.append((500, "".join(t for _, t in texts)[:20_000]))
    want = brute_force(texts)
    monkeypatch.setattr(substrings, "HOT", 2)
    assert rows(documents(spark, texts).repartition(3)) == want
    monkeypatch.setattr(substrings, "HOT", 20_000)
    monkeypatch.setattr(substrings, "SHARD_BYTES", 700)
    monkeypatch.setattr(substrings, "MERGE_BYTES", 3000)
    monkeypatch.setattr(substrings, "STRETCH", 1000)
    monkeypatch.setattr(substrings, "FLUSH_ROWS", 10)
    assert rows(documents(spark, texts).repartition(3)) == want


def test_merged_transforms_give_the_repeated_strings():
    random.seed(5)
    found = [(i, i << 32, bytes(random.choice(b"ab") for _ in range(random.randint(100, 130)))) for i in range(30)]
    found += [(40 + i, 0, found[i][2][:110] + b"zz") for i in range(10)]
    seen, want = set(), set()
    for doc, place, data in found:
        for i in range(len(data) - 99):
            if data[i : i + 100] in seen:
                want.add((doc, (place >> 32) + i))
            seen.add(data[i : i + 100])
    got = {(d, i) for d, _, a, b in substrings.repeated_windows(found) for i in range(a, b + 1)}
    assert got == want and len(want) > 50


def test_empty_table(spark):
    assert rows(no_documents(spark)) == []


def test_kept_bytes(spark):
    texts = [(1, "q" * 150), (2, "é" * 40 + "tail")]
    got = {r["doc_id"]: bytes(r["kept"]) for r in substrings.without_repeats(documents(spark, texts)).collect()}
    # only the first window of the run of q starts nowhere earlier
    assert got == {1: b"q", 2: texts[1][1].encode()}


def test_repeated_rows_are_one_document(spark, monkeypatch):
    own = "".join(random.Random(8).choices("abcdefgh ", k=700))
    texts = [(3, own), (3, own), (3, own), (None, own[::-1]), (None, own[::-1]), (5, "x" * 40 + own[100:400]), (6, own[:300]), (6, own[:300])]
    got = {r["doc_id"]: bytes(r["kept"]).decode() for r in substrings.without_repeats(documents(spark, texts)).collect()}
    assert got == {3: own, None: own[::-1], 5: "x" * 40, 6: ""}
    # two tasks, one, and rows of hot anchors
    assert rows(documents(spark, texts).repartition(5)) == brute_force(texts)
    assert rows(documents(spark, texts).coalesce(1)) == brute_force(texts)
    monkeypatch.setattr(substrings, "HOT", 1)
    assert rows(documents(spark, texts).repartition(2)) == brute_force(texts)
    monkeypatch.setattr(substrings, "HOT", 20_000)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        assert rows(documents(spark, texts * 3).repartition(3)) == brute_force(texts * 3)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_many_different_texts_under_one_id(spark):
    rng = random.Random(9)
    shared = "".join(rng.choices("abcdefgh ", k=250))
    # 2,000 texts: two of them have the same 18 bits of hash in all likelihood
    texts = [(None, "".join(rng.choices("ijkl", k=130)) + (shared if i % 50 == 0 else "")) for i in range(2000)]
    texts += [(None, "m" * (i % 7) + shared + "".join(rng.choices("ijkl", k=130))) for i in range(60)]
    keys = [r["version"] for r in substrings.keyed(documents(spark, texts)).select("version").distinct().collect()]
    assert len(keys) == len(set(texts))
    assert rows(documents(spark, texts).repartition(4)) == brute_force(texts)
