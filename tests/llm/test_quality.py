from __future__ import annotations

import random
from zlib import crc32

import numpy as np
from pyspark.sql import functions as F

from tests.llm.edges import TEXTS, documents, no_documents
from touchline.llm import quality


def labels(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, quality int, toxic int, text string")


def made(spark, n=400):
    random.seed(4)
    letters = lambda: "".join(random.choice("aeinrst") for _ in range(random.randint(2, 8)))
    texts, marks = [], []
    for i in range(n):
        bad = i % 3 == 0
        words = [letters() for _ in range(random.randint(1, 80))]
        texts.append((i, " ".join(w + "$$$" if bad else w for w in words)))
        marks.append((i, 0 if bad else 1, 0))
    return texts, marks


def test_held_out_rows_are_told_apart(spark):
    texts, marks = made(spark)
    model = quality.train(documents(spark, texts), labels(spark, marks), max_rows=250)
    assert 0 < model.rows <= 250
    got = {r["doc_id"]: r["made"] for r in quality.score(documents(spark, texts), model, name="made").collect()}
    held = [(i, q) for i, q, _ in marks if crc32(str(i).encode()) % 4 == 2]
    assert np.mean([(got[i] >= 0.7) == (q == 1) for i, q in held]) > 0.97


def test_the_sample_holds_no_held_out_rows_and_does_not_hang_on_partitions(spark):
    texts, marks = made(spark, 120)
    marks = marks + [(3, None, 1), (None, 1, 1), (7, 1, 0), (10_000, 1, 0)]
    one = quality.train(documents(spark, texts).repartition(1), labels(spark, marks))
    two = quality.train(documents(spark, texts).repartition(7), labels(spark, marks).repartition(5))
    assert np.array_equal(one.weights, two.weights)
    assert one.rows == sum(crc32(str(i).encode()) % 4 != 2 for i in range(120))
    flipped = [(i, 1 - q if crc32(str(i).encode()) % 4 == 2 and q is not None and i is not None else q, t) for i, q, t in marks if i is not None]
    assert np.array_equal(quality.train(documents(spark, texts), labels(spark, flipped)).weights, one.weights)


def test_scores_follow_a_plain_loop(spark):
    texts, marks = made(spark, 60)
    model = quality.train(documents(spark, texts), labels(spark, marks))
    got = quality.score(documents(spark, TEXTS), model, name="made").collect()
    assert len(got) == len(TEXTS)
    for r in got:
        data = np.frombuffer((r["text"] or "").encode(), np.uint8)
        own = quality._grams(data, np.array([0, len(data)]), model.bits)
        bucket, value = quality._sparse(own, 0)
        want = 1 / (1 + np.exp(-(float(np.dot(model.weights[bucket].astype(float), value)) + model.weights[-1])))
        assert abs(r["made"] - want) < 1e-5 and 0 <= r["made"] <= 1


def test_empty_tables(spark):
    model = quality.train(no_documents(spark), labels(spark, []))
    assert model.rows == 0 and not model.weights.any()
    assert quality.score(no_documents(spark), model, name="made").collect() == []
    assert quality.score(documents(spark), model, name="made").where(F.col("made") != 0.5).count() == 0
    clashing = quality.score(documents(spark), model).collect()  # the table has a column called score
    assert {r["score"] for r in clashing} == {0.5} and {r["score_"] for r in clashing} == {0.5}
