"""Quality classifier: hashed word n-gram logistic regression, trained with follow-the-regularised-leader updates.

A text is cut into runs of letters and digits and runs of other signs. Features are hashed n-grams
of these runs and of their shapes (all capitals, capitalised, small, digits, repeated, or the signs
themselves). A feature's value is its share of the text's n-grams, scaled, so long and short texts
compare; the score is the logistic function of a sparse dot product.

Training is online: follow-the-regularised-leader with per-coordinate rates and L1, which keeps most
weights at 0. It uses a bounded sample of labelled rows (``max_rows``, those with the smallest hash
of their id). The sample is dealt into a fixed number of shards by that hash; each shard is trained
on its own in every epoch, starting from the mean of all shards' weights. So a model hangs on the
rows only, not on their partitions, and a lost task can be run again. What passes the driver is one
weight per bucket and shard.

NULL and empty texts hold no n-grams and score by the bias alone. Rows without label are not learned
from; a model that has learned from no row scores 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.text import ODD, free_name, mix, run_keys, slices, text_bytes
from touchline.session import written

BITS = 18
SCALE = 8.0
# Texts taken at a time; their features need some fifty times as much memory.
PART_BYTES = 1 << 19

SPACE_CLASS, WORD_CLASS, SIGN_CLASS = 0, 1, 2


def _classes() -> np.ndarray:
    table = np.full(256, SIGN_CLASS, np.uint8)
    for byte in range(256):
        char = chr(byte)
        if byte <= 0x20 or byte == 0x7F:
            table[byte] = SPACE_CLASS
        elif byte >= 0x80 or char.isascii() and char.isalnum():
            table[byte] = WORD_CLASS
    return table


CLASSES = _classes()
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
IS_CAPITAL = np.array([65 <= b <= 90 for b in range(256)])
IS_SMALL = np.array([97 <= b <= 122 for b in range(256)])
IS_DIGIT = np.array([48 <= b <= 57 for b in range(256)])


class Features(NamedTuple):
    """N-grams of many texts: feature buckets, and the border of each text's own."""

    bucket: np.ndarray
    border: np.ndarray


def _grams(data: np.ndarray, offsets: np.ndarray, bits: int) -> Features:
    kind = CLASSES[data]
    texts = len(offsets) - 1
    if not len(data):
        return Features(np.zeros(0, np.int64), np.zeros(texts + 1, np.int64))
    change = np.empty(len(kind), bool)
    change[0] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:])
    change[offsets[:-1][offsets[:-1] < len(kind)]] = True
    start = np.flatnonzero(change)
    end = np.append(start[1:], len(kind))
    seen = kind[start] != SPACE_CLASS
    start, end = start[seen], end[seen]
    if not len(start):
        return Features(np.zeros(0, np.int64), np.zeros(texts + 1, np.int64))
    first = np.searchsorted(start, offsets)
    of = np.repeat(np.arange(texts), np.diff(first))
    key = run_keys(LOWER[data], start, end)
    count = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags[data])])[np.stack([start, end])], axis=0)[0]
    size, capitals, small, digits = end - start, count(IS_CAPITAL), count(IS_SMALL), count(IS_DIGIT)
    shape = np.select(
        [kind[start] == SIGN_CLASS, digits == size, (capitals > 1) & (small == 0), IS_CAPITAL[data[start]]],
        [0, 1, 2, 3],
        4,
    ).astype(np.uint64)
    long_word = (size > 24).astype(np.uint64)
    shape = np.where(shape == 0, key, shape * np.uint64(2) + long_word + np.uint64(1))
    # a word that stood here one or two runs ago
    again = np.zeros(len(key), bool)
    for back in (1, 2):
        again[back:] |= (key[back:] == key[:-back]) & (of[back:] == of[:-back])
    shape = np.where(again & (kind[start] == WORD_CLASS), np.uint64(99), shape)
    found, owner = [mix(key ^ np.uint64(11)), mix((shape + np.uint64(12)) * np.uint64(ODD))], [of, of]
    for tag, base, n in ((13, key, 2), (14, shape, 2), (15, shape, 3)):
        if len(base) < n:
            continue
        m = len(base) - n + 1
        gram = np.full(m, tag, np.uint64)
        for j in range(n):
            gram = mix(gram * np.uint64(ODD) + base[j : j + m])
        inside = of[: m] == of[n - 1 :]
        found.append(gram[inside])
        owner.append(of[:m][inside])
    bucket, owner = np.concatenate(found), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    bucket = (bucket[order] >> np.uint64(64 - bits)).astype(np.int64)
    return Features(bucket, np.searchsorted(owner[order], np.arange(texts + 1)))


def _sparse(features: Features, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their values."""
    own = features.bucket[features.border[i] : features.border[i + 1]]
    bucket, n = np.unique(own, return_counts=True)
    return bucket, SCALE * np.sqrt(n / max(len(own), 1))


class Model(NamedTuple):
    """Weights by bucket; the last one is the bias."""

    weights: np.ndarray
    bits: int
    rows: int  # learned from


def sample(docs: DataFrame, labels: DataFrame, column: str, max_rows: int) -> DataFrame:
    """Training rows (``deal``, ``text``, ``label``): labelled documents that are not held out.

    Of more than ``max_rows`` labelled ids those with the smallest hashes are taken. Ids with two
    labels take the smaller one. The ids are at most ``max_rows``, so they go to all tasks and the
    documents stay where they are.
    """
    marks = (
        labels.where(F.col(column).isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("id"))
        .agg(F.min(column).cast("int").alias("label"))
        .withColumn("deal", F.xxhash64("id"))
    )
    last = marks.select("deal").orderBy("deal").limit(max_rows).agg(F.max("deal")).first()[0]
    marks = marks.where(F.col("deal") <= F.lit(last).cast("bigint"))
    own = docs.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    return own.join(F.broadcast(marks), "id").select("deal", "text", "label")


def held_out(doc_id: Column) -> Column:
    """Rows kept for judging: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    column: str = "quality",
    max_rows: int = 24_000,
    bits: int = BITS,
    shards: int = 8,
    epochs: int = 3,
    alpha: float = 0.15,
    beta: float = 1.0,
    l1: float = 0.3,
    l2: float = 0.5,
) -> Model:
    """Learn ``column`` of ``labels`` (doc_id, 0 or 1) from at most ``max_rows`` documents; see ``sample``.

    The driver holds ``shards`` times 2**bits weights at most.
    """
    spark = docs.sparkSession
    size = 1 << bits
    chosen = sample(docs, labels, column, max_rows).withColumn("shard", F.pmod("deal", F.lit(shards)).cast("int"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=PART_BYTES):
                features = _grams(*text_bytes(part.column("text")), bits)
                pairs = [_sparse(features, i) for i in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("shard"), part.column("deal"), part.column("label"),
                     pa.array([b.astype("<i4").tobytes() for b, _ in pairs], pa.binary()),
                     pa.array([v.astype("<f4").tobytes() for _, v in pairs], pa.binary())],
                    ["shard", "deal", "label", "buckets", "values"],
                )

    rows = chosen.mapInArrow(extract, "shard int, deal bigint, label int, buckets binary, values binary")
    rows = written(rows, "features")
    mean = np.zeros(size + 1)

    def pass_over(start: np.ndarray, epoch: int):
        shared = spark.sparkContext.broadcast(start.astype(np.float32))

        def learn(frame: pd.DataFrame) -> pd.DataFrame:
            w0 = shared.value.astype(np.float64)
            n = np.full(size + 1, 1.0 if epoch else 0.0)
            # the leader's state that gives these weights back
            z = -w0 * ((beta + np.sqrt(n)) / alpha + l2) - np.sign(w0) * l1
            order = np.argsort(frame["deal"].to_numpy() * (2 * epoch + 1), kind="stable")
            buckets, values, labels = frame["buckets"].tolist(), frame["values"].tolist(), frame["label"].tolist()
            for i in order:
                b = np.append(np.frombuffer(buckets[i], "<i4"), size)
                v = np.append(np.frombuffer(values[i], "<f4"), 1.0)
                zi, ni = z[b], n[b]
                w = np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))
                p = 1.0 / (1.0 + np.exp(-np.clip(np.dot(w, v), -35, 35)))
                g = (p - labels[i]) * v
                step = (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha
                z[b] += g - step * w
                n[b] += g * g
            w = np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))
            return pd.DataFrame({"weights": [w.astype("<f4").tobytes()], "rows": [len(frame)]})

        learned = rows.groupBy("shard").applyInPandas(learn, "weights binary, rows bigint").collect()
        total = sum(r["rows"] for r in learned)
        out = sum((np.frombuffer(r["weights"], "<f4").astype(float) * r["rows"] for r in learned), np.zeros(size + 1))
        shared.destroy()
        return (out / total if total else out), total

    total = 0
    for epoch in range(epochs):
        mean, total = pass_over(mean, epoch)
    return Model(mean.astype(np.float32), bits, total)


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """The input with a score column (0 to 1), read from the text alone. No shuffle.

    The model that goes to the executors has 2**bits weights, whatever the corpus. If the input has a
    column of that name, the score gets the next free one (``score_``).
    """
    name = free_name(name, docs.columns)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    schema = docs.select("*", F.lit(0.0).alias(name)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bits, _ = shared.value
        for batch in batches:
            for part in slices(batch, text, PART_BYTES):
                features = _grams(*text_bytes(part.column(text)), bits)
                owner = np.repeat(np.arange(part.num_rows), np.diff(features.border))
                # equal buckets of one text count once, by the root of their share
                both = owner.astype(np.int64) << np.int64(bits) | features.bucket
                both, n = np.unique(both, return_counts=True)
                of = both >> np.int64(bits)
                total = np.maximum(np.diff(features.border), 1)
                value = SCALE * np.sqrt(n / total[of]) * weights[both & np.int64((1 << bits) - 1)]
                sums = np.bincount(of, weights=value, minlength=part.num_rows) + weights[-1]
                made = 1.0 / (1.0 + np.exp(-np.clip(sums, -35, 35)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(made, pa.float64())], [*names, name])

    return docs.mapInArrow(run, schema)
