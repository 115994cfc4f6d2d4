"""Homomorphic fingerprints of documents: a document is the multiset of its paragraphs.

Each paragraph is hashed to a wide vector, and a document's fingerprint is the sum of its
paragraphs' vectors, every lane modulo 2**32. So the order of paragraphs does not matter, equal
multisets have equal fingerprints, and a paragraph is put in or taken out by adding or subtracting
its vector; nothing else has to be read again.

A vector has two parts. The first lanes are uniform hash bits of the paragraph and decide equality.
The other lanes hold a signed count of the paragraph's byte windows; the squared length of the
difference of two such sums estimates in how many windows two documents differ, which gives the
likeness.

The empty text is one empty paragraph, and so is NULL.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.text import ODD, free_name, slices

EQUAL_LANES = 32
LIKE_LANES = 128
LANES = EQUAL_LANES + LIKE_LANES
WINDOW = 16
SHORT_WINDOW = 4
SHORT_PARAGRAPH = 64
STRETCH = 1 << 20


def _window_counts(data: bytes, size: int) -> np.ndarray:
    """Signed counts of the windows of ``size`` bytes that hold no line break."""
    total = np.zeros(2 * LIKE_LANES, np.int64)
    for at in range(0, max(len(data) - size + 1, 0), STRETCH):
        part = np.frombuffer(data, np.uint8, min(len(data) - at, STRETCH + size - 1), at)
        packed, width = part.astype(np.uint64), 1
        while width < min(size, 8):
            packed = packed[:-width] | (packed[width:] << np.uint64(8 * width))
            width *= 2
        if size > 8:
            packed = packed[:-8] * np.uint64(ODD) + packed[8:] * np.uint64(0xC2B2AE3D27D4EB4F)
        packed = packed ^ (packed >> np.uint64(32))
        packed = (packed * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(56)
        breaks = np.concatenate([[0], np.cumsum(part == 10)])
        whole = breaks[size:] == breaks[:-size]
        total += np.bincount(packed[whole].astype(np.intp), minlength=2 * LIKE_LANES)
    return total[0::2] - total[1::2]


def vector(text: str) -> np.ndarray:
    """The sum of the vectors of a text's paragraphs, which stand on lines of their own."""
    data = text.encode()
    paragraphs = data.split(b"\n")
    wide = b"".join(
        [hashlib.blake2b(p, digest_size=64, person=b"a").digest() + hashlib.blake2b(p, digest_size=64, person=b"b").digest()
         for p in paragraphs]
    )
    lanes = np.frombuffer(wide, "<u4").reshape(-1, EQUAL_LANES)
    counts = _window_counts(data, WINDOW)
    short = [p for p in paragraphs if len(p) < SHORT_PARAGRAPH]
    if short:
        counts = counts + _window_counts(b"\n".join(short), SHORT_WINDOW)
    # every paragraph also counts once as a whole, so that the shortest ones leave a trace
    slot = lanes[:, 0] % (2 * LIKE_LANES)
    whole = np.bincount(slot.astype(np.intp), minlength=2 * LIKE_LANES)
    counts = counts + whole[0::2] - whole[1::2]
    return np.concatenate([lanes.sum(axis=0, dtype=np.uint64), counts.astype(np.uint64)]) & np.uint64(0xFFFFFFFF)


def written(v: np.ndarray) -> str:
    return base64.b64encode(v.astype("<u4").tobytes()).decode()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u4").astype(np.uint64)


def add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Put the paragraphs of b in."""
    return (a + b) & np.uint64(0xFFFFFFFF)


def subtract(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Take the paragraphs of b out."""
    return (a - b) & np.uint64(0xFFFFFFFF)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """1 for equal fingerprints, about 0 for texts that share nothing."""
    if np.array_equal(a, b):
        return 1.0
    signed = [x[EQUAL_LANES:].astype(np.uint32).view(np.int32).astype(float) for x in (a, b, subtract(a, b))]
    one, two, apart = [float(np.dot(x, x)) for x in signed]
    return float(min(1.0, max(0.0, 1 - apart / (one + two)))) if one + two else 0.0


def replace_end(text: str, own: np.ndarray, keep: int, end: str) -> tuple[str, np.ndarray]:
    """A text whose code points from ``keep`` on are replaced, and its fingerprint from that of the old text.

    Only the paragraphs that change are hashed.
    """
    edited = text[:keep] + end
    same = text.rfind("\n", 0, keep) + 1
    return edited, add(subtract(own, vector(text[same:])), vector(edited[same:]))


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input with a column ``fingerprint``, or the next free name if it has one of that name; no shuffle."""
    name, names = free_name("fingerprint", docs.columns), docs.columns
    schema = docs.withColumn(name, F.lit("")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                made = [written(vector(t or "")) for t in part.column(text).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(made, pa.string())], [*names, name])

    return docs.mapInArrow(run, schema)


class _Row(NamedTuple):
    bucket: int
    kind: int
    doc_id: int | None
    text: str
    vector: np.ndarray


# What a row is in its bucket: a document, the document after the bucket's last one, a row without id.
DOCUMENT, AFTER, LOOSE = 0, 1, 2
NEXT_SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def edited_fingerprints(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, with likenesses.

    The edited text has the last third of the code points (rounded down) replaced by the first as
    many, or all, of the next document in descending doc_id; after the last one comes the first.
    Documents with one id follow each other in the order of their texts. A row without id has no
    next document: its last third is cut off and ``near_next`` is 0.

    Documents are dealt once into ranges of doc_id, of which there are a few per task. Each range
    also gets the first document of the next one, whose id is the border, so a sorted range is
    read as a stream that holds two documents at a time. The driver gets the borders only; their
    number is fixed by the number of partitions.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = 4 * parts
    steps = [(i + 1) / ranges for i in range(ranges - 1)]
    own = docs.select("doc_id", F.col("text").alias("text"))
    found = own.agg(F.percentile_approx("doc_id", steps, 20 * ranges).alias("cuts"), F.max("doc_id").alias("top")).first()
    cuts = np.array(sorted({*(found["cuts"] or []), found["top"]} - {None}), np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, known = batch.column("doc_id"), np.array(batch.column("doc_id").is_valid())
            values = ids.fill_null(0).to_numpy(zero_copy_only=False)
            bucket = np.searchsorted(cuts, values, "left")
            loose = (np.arange(batch.num_rows) * 7919 + batch.num_rows) % max(ranges, 1)
            rows = np.arange(batch.num_rows)
            border = rows[known & np.isin(values, cuts)]
            follows = (bucket[border] + 1) % max(len(cuts), 1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([np.where(known, bucket, loose), follows]), pa.int32()),
                    pa.array(np.concatenate([np.where(known, DOCUMENT, LOOSE), np.full(len(border), AFTER)]), pa.int32()),
                    pa.concat_arrays([ids, ids.take(pa.array(border))]),
                    pa.concat_arrays([batch.column("text"), batch.column("text").take(pa.array(border))]),
                ],
                ["bucket", "kind", "doc_id", "text"],
            )

    def finish(row: _Row, after: _Row | None) -> tuple:
        cut = len(row.text) // 3
        end = after.text[:cut] if after else ""
        edited, changed = replace_end(row.text, row.vector, len(row.text) - cut, end)
        return (
            row.doc_id, len(row.text), hashlib.sha256(edited.encode()).hexdigest(), written(row.vector),
            written(changed), likeness(row.vector, changed), likeness(row.vector, after.vector) if after else 0.0,
        )

    def table(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        names = [c.split()[0] for c in NEXT_SCHEMA.split(", ")]
        columns = zip(*rows) if rows else [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: _Row | None = None
        for batch in batches:
            for part in slices(batch):
                rows = []
                for bucket, kind, doc_id, text in zip(*[c.to_pylist() for c in part.columns]):
                    if kind == AFTER and (before is None or before.bucket != bucket):
                        continue
                    row = _Row(bucket, kind, doc_id, text or "", vector(text or ""))
                    if before is not None:
                        rows.append(finish(before, row if row.bucket == before.bucket and kind != LOOSE else None))
                    if kind == LOOSE:
                        rows.append(finish(row, None))
                    before = row if kind == DOCUMENT else None
                yield table(rows)
        if before is not None:
            yield table([finish(before, None)])

    dealt = own.mapInArrow(deal, "bucket int, kind int, doc_id bigint, text string")
    ordered = dealt.repartition(parts, "bucket").sortWithinPartitions("bucket", "kind", F.desc("doc_id"), "text")
    return ordered.mapInArrow(walk, NEXT_SCHEMA)
