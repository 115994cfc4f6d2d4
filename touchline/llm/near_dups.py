"""Near-duplicate documents by weighted MinHash.

A document is a weighted set: its shingles of five words, weighted by how often they occur in it and
by how rare their words are in the corpus (TF-IDF). Improved consistent weighted sampling draws
``SAMPLES`` samples such that two documents agree in each with a chance equal to their weighted Jaccard
similarity. Samples are banded; documents that share a band's samples are candidates, and candidates
are verified by the exact weighted Jaccard similarity of their whole texts (0.8 or more by default).
A class is a connected component of verified pairs; exact copies are one node of that graph.

The weight of a shingle is its count times the mean rarity of its words. Rarity is taken per word
over all documents (in a table of a fixed size, so the model does not grow) and not per shingle:
a passage would else weigh less the more copies of it there are, and large groups would fall apart.

Large buckets are cut into blocks and pairs of blocks, so no task holds a bucket that grows with the
data, and inside a block documents are compared by their samples alone. A block gives a forest of
its likely pairs, not all of them, and these are verified. Documents that have a likely partner in
another component afterwards are brought together block by block with their texts, and all such pairs are
compared exactly; again only a forest of the true ones is given. So no link between classes is lost, and no step
gives more rows than documents times blocks.

Words are longest runs of digits, ASCII letters (lower-cased) and characters outside ASCII. A text
with one to four words is one shingle. Texts without words have no shingles and are alike only if they are equal;
NULL counts as the empty text. Rows without doc_id take part; a class's id is its smallest doc_id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.text import ODD, Words, free_name, mix, slices, text_bytes, window_keys, words
from touchline.session import written

SHINGLE = 5
SIMILARITY = 0.8
SAMPLES, ROWS = 64, 4  # 16 bands of 4: a pair at 0.8 shares no band with a chance of 0.0002
RARITY_BITS = 18
POOL_BITS = 16
BLOCK = 512
# Bytes of texts taken at a time; their shingles need many times as much memory.
PART_BYTES = 1 << 20
# Pairs whose samples agree this much less often than asked are still verified (3.6 standard deviations).
MARGIN = 0.18


# --- rarity of words -------------------------------------------------------------------------


def _slot(key: np.ndarray) -> np.ndarray:
    return (key >> np.uint64(64 - RARITY_BITS)).astype(np.int64)


def rarity(docs: DataFrame) -> np.ndarray:
    """Rarity by slot of the word's key, from the number of documents that hold it, over all documents.

    Each task gives one count per slot, so what is shuffled and collected is bounded by the slots.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, texts = np.zeros(1 << RARITY_BITS, np.int64), 0
        for batch in batches:
            texts += batch.num_rows
            for part in slices(batch, limit=PART_BYTES):
                found = words(*text_bytes(part.column("text")))
                of = np.repeat(np.arange(part.num_rows), np.diff(found.first))
                pairs = np.unique(of << np.int64(RARITY_BITS) | _slot(found.key))
                total += np.bincount(pairs & np.int64((1 << RARITY_BITS) - 1), minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1).astype(np.int32)), pa.array(np.append(total[used], texts))], ["slot", "n"]
        )

    counted = docs.select("text").mapInArrow(count, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    slots, n = counted.column("slot").to_numpy(), counted.column("n").to_numpy()
    texts = int(n[slots == -1].sum())
    holding = np.zeros(1 << RARITY_BITS)
    holding[slots[slots >= 0]] = n[slots >= 0]
    return (1 + np.log((1 + texts) / (1 + holding))).astype(np.float32)


# --- weighted shingles and their samples -------------------------------------------------------


class Weighted(NamedTuple):
    """Distinct shingles of many texts: text number, key, weight and count, sorted by text and key."""

    of: np.ndarray
    key: np.ndarray
    weight: np.ndarray
    times: np.ndarray


def weighted_shingles(found: Words, table: np.ndarray) -> Weighted:
    count = np.diff(found.first)
    of = np.repeat(np.arange(len(count)), count)
    rare = table[_slot(found.key)].astype(np.float64)
    keys, owners, weights = [], [], []
    if len(found.key) >= SHINGLE:
        m = len(found.key) - SHINGLE + 1
        inside = of[:m] == of[SHINGLE - 1 :]
        total = np.concatenate([[0.0], np.cumsum(rare)])
        keys.append(window_keys(found.key, SHINGLE)[inside])
        owners.append(of[:m][inside])
        weights.append(((total[SHINGLE:] - total[:-SHINGLE]) / SHINGLE)[inside])
    for d in np.flatnonzero((count > 0) & (count < SHINGLE)):
        own = slice(found.first[d], found.first[d + 1])
        keys.append(window_keys(found.key[own], int(count[d])))
        owners.append(np.array([d]))
        weights.append(np.array([rare[own].mean()]))
    if not keys:
        return Weighted(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0), np.zeros(0, np.int64))
    key, owner, weight = np.concatenate(keys), np.concatenate(owners), np.concatenate(weights)
    order = np.lexsort((key, owner))
    key, owner, weight = key[order], owner[order], weight[order]
    fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])])
    at = np.flatnonzero(fresh)
    times = np.diff(np.append(at, len(key)))
    # rounded, so that a weight hangs on the shingle alone and not on where it stands
    return Weighted(owner[at], key[at], np.round(weight[at], 3) * times, times)


@lru_cache(maxsize=1)
def _pool() -> tuple[np.ndarray, ...]:
    """Drawn triples for the sampling: r, 1/r, log c (both Gamma(2, 1)) and beta (uniform)."""
    draw = np.random.Generator(np.random.PCG64(20))
    r, c = draw.gamma(2.0, 1.0, 1 << POOL_BITS), draw.gamma(2.0, 1.0, 1 << POOL_BITS)
    beta = draw.random(1 << POOL_BITS)
    return tuple(x.astype(np.float32) for x in (r, 1 / r, np.log(c), beta))


def samples(found: Weighted, texts: int) -> np.ndarray:
    """Consistent weighted samples, one row of SAMPLES numbers per text that has shingles, in order.

    For a shingle with weight S: t = floor(log S / r + beta), log a = log c - r (t - beta + 1); the
    sample is the shingle with the smallest a together with its t. The triple of a shingle and a
    sample number is looked up in a pool; equal a go to the smaller number, so ties fall alike everywhere.
    """
    r_all, inverse, log_c, beta_all = _pool()
    starts = np.flatnonzero(np.concatenate([[True], found.of[1:] != found.of[:-1]])) if len(found.of) else np.zeros(0, int)
    out = np.zeros((len(starts), SAMPLES), np.uint32)
    if not len(starts):
        return out
    log_s = np.log(found.weight).astype(np.float32)
    low = found.key.astype(np.uint32)
    for k in range(SAMPLES):
        odd = (ODD * (2 * k + 1) * (2 * k + 3) | 1) & ((1 << 64) - 1)
        pick = (found.key * np.uint64(odd)) >> np.uint64(64 - POOL_BITS)
        r, beta = r_all[pick], beta_all[pick]
        t = np.floor(log_s * inverse[pick] + beta)
        rank = log_c[pick] - r * (t - beta + 1)
        name = low ^ (t.astype(np.int32).view(np.uint32) * np.uint32(0x9E3779B1))
        packed = ((rank + 64.0) * np.float32(1 << 25)).astype(np.uint64) << np.uint64(32) | name
        out[:, k] = np.minimum.reduceat(packed, starts).astype(np.uint32)
    return out


def bands(sampled: np.ndarray) -> np.ndarray:
    """One key per band; the band's number is part of it."""
    out = np.empty((len(sampled), SAMPLES // ROWS), np.uint64)
    for b in range(SAMPLES // ROWS):
        key = np.full(len(sampled), b + 1, np.uint64)
        for j in range(ROWS):
            key = mix(key * np.uint64(ODD) + sampled[:, b * ROWS + j])
        out[:, b] = key
    return out


def text_name(text="text"):
    """The name of a text's node: equal texts are one node."""
    return F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))


def nodes(docs: DataFrame, table: Broadcast) -> DataFrame:
    """A row per distinct text that has words: ``node``, ``total`` weight, ``sketch`` and ``bands``."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=PART_BYTES):
                found = weighted_shingles(words(*text_bytes(part.column("text"))), table.value)
                sampled = samples(found, part.num_rows)
                texts = np.unique(found.of)
                total = np.bincount(found.of, weights=found.weight, minlength=part.num_rows)[texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("node").take(pa.array(texts)),
                        pa.array(total),
                        pa.array([row.tobytes() for row in sampled.astype(np.uint8)], pa.binary()),
                        pa.array(list(bands(sampled).view(np.int64)), pa.list_(pa.int64())),
                    ],
                    ["node", "total", "sketch", "bands"],
                )

    texts = docs.select(text_name().alias("node"), "text")
    made = texts.mapInArrow(sketch, "node string, total double, sketch binary, bands array<bigint>")
    # copies of a text have equal rows; one stays
    return made.groupBy("node").agg(*[F.first(c).alias(c) for c in ("total", "sketch", "bands")])


# --- candidates ----------------------------------------------------------------------------------


def members(found: DataFrame) -> DataFrame:
    """Rows (``band``, ``size``, ``node``) of the buckets with two texts or more.

    Of buckets with the same texts, which near copies share in most bands, one stays.
    """
    rows = found.select("node", F.explode("bands").alias("band"))
    sized = rows.groupBy("band").agg(
        F.count(F.lit(1)).alias("size"),
        F.bit_xor(F.xxhash64("node")).alias("one"),
        F.bit_xor(F.xxhash64("node", F.lit(7))).alias("two"),
    )
    kept = sized.where("size > 1").groupBy("size", "one", "two").agg(F.min("band").alias("band")).select("band", "size")
    return rows.join(kept, "band").select("band", "size", "node")


def _agreeing(sketch: np.ndarray) -> np.ndarray:
    """How many samples agree, for all pairs of a block."""
    n = len(sketch)
    out = np.empty((n, n), np.uint8)
    step = max(1, (1 << 22) // (n * SAMPLES))
    for at in range(0, n, step):
        out[at : at + step] = (sketch[at : at + step, None, :] == sketch[None, :, :]).sum(axis=2)
    return out


def _forest(likely: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the likely pairs: stars around texts with many likely partners, and links that join the stars.

    What the pairs join the edges join, and there are fewer edges than texts.
    """
    degree = likely.sum(axis=1)
    open_, star, edges = degree > 0, np.full(len(likely), -1), []
    stars = 0
    while open_.any():
        top = degree[open_].max()
        # of the texts with nearly as many partners the first by name, which is the same in most buckets
        pivot = int(np.flatnonzero(open_ & (degree >= 0.8 * top))[0])
        own = likely[pivot] & open_
        edges += [(pivot, int(i)) for i in np.flatnonzero(own) if i != pivot]
        star[own] = star[pivot] = stars
        stars += 1
        open_ &= star < 0
    if stars < 2:
        return edges
    a, b = np.nonzero(np.triu(likely, 1))
    across = star[a] != star[b]
    a, b = a[across], b[across]
    low, high = np.minimum(star[a], star[b]), np.maximum(star[a], star[b])
    _, first = np.unique(low * stars + high, return_index=True)
    parent = list(range(stars))

    def root(s: int) -> int:
        while parent[s] != s:
            parent[s] = parent[parent[s]]
            s = parent[s]
        return s

    for i in first:
        one, other = root(int(low[i])), root(int(high[i]))
        if one != other:
            parent[other] = one
            edges.append((int(a[i]), int(b[i])))
    return edges


def units(in_buckets: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Buckets' texts dealt into units of at most two blocks: ``place`` (band and blocks), ``first`` and ``second``
    (whether the text is in the first and the second block), ``node`` and ``label``.

    Every pair of a bucket's texts is in exactly one unit, on different sides of it. With labels only
    buckets with different ones are dealt.
    """
    if labels is None:
        rows = in_buckets.withColumn("label", F.col("node"))
    else:
        rows = in_buckets.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        mixed = rows.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
        rows = rows.join(mixed.select("band"), "band")
    own = F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks")).cast("int")
    low, high = F.least("own", "other"), F.greatest("own", "other")
    return (
        rows.withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.struct("band", low.alias("i"), high.alias("j")).alias("place"),
            (F.col("own") <= F.col("other")).alias("first"),
            (F.col("own") >= F.col("other")).alias("second"),
            "node",
            "label",
        )
    )


def _by_unit(rows: DataFrame) -> DataFrame:
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    unit = rows.withColumn("unit", F.xxhash64("place.band", "place.i", "place.j"))
    return unit.repartition(parts, "unit").sortWithinPartitions("unit", "place", "node").drop("unit")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of one unit after the other."""
    place, group = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["place"] != place:
                if len(group) > 1:
                    yield group
                place, group = row["place"], []
            group.append(row)
    if len(group) > 1:
        yield group


def _askable(group: list[dict], similarity: float) -> np.ndarray:
    """Pairs on different sides of a unit, with different labels and weights that allow the similarity."""
    total = np.array([g["total"] for g in group])
    _, label = np.unique(np.array([g["label"] for g in group]), return_inverse=True)
    first, second = np.array([g["first"] for g in group]), np.array([g["second"] for g in group])
    pairs = np.minimum(total[:, None], total) >= similarity * 0.999 * np.maximum(total[:, None], total)
    pairs &= label[:, None] != label
    return pairs & ((first[:, None] & second) | (second[:, None] & first))


def _likely(group: list[dict], similarity: float) -> np.ndarray:
    """Of these the pairs whose samples agree often enough."""
    sketch = np.frombuffer(b"".join([g["sketch"] for g in group]), np.uint8).reshape(-1, SAMPLES)
    least = int(np.ceil((similarity - MARGIN) * SAMPLES))
    return _askable(group, similarity) & (_agreeing(sketch) >= least)


def _edges(group: list[dict], linked: np.ndarray) -> pa.RecordBatch:
    node = [g["node"] for g in group]
    pairs = [(min(node[i], node[j]), max(node[i], node[j])) for i, j in _forest(linked)]
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.string()) for i in (0, 1)], ["a", "b"])


def likely_pairs(in_buckets: DataFrame, found: DataFrame, similarity: float) -> DataFrame:
    """Pairs (``a`` < ``b``) that join whatever texts of a bucket are likely to be similar: a forest for each unit."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            yield _edges(group, _likely(group, similarity))

    rows = units(in_buckets, None).join(found.select("node", "total", "sketch"), "node")
    return _by_unit(rows).mapInArrow(compare, "a string, b string").distinct()


def doubtful(in_buckets: DataFrame, found: DataFrame, labels: DataFrame, similarity: float) -> DataFrame:
    """The units' rows whose text has a likely partner with another label."""
    rows = units(in_buckets, labels).join(found.select("node", "total", "sketch"), "node")
    kept = [c for c in rows.columns if c != "sketch"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None
        for batch in batches:
            kind = kind or pa.schema([batch.schema.field(c) for c in kept])
            break
        else:
            return
        again = (b for part in ([batch], batches) for b in part)
        for group in _groups(again):
            asked = _likely(group, similarity).any(axis=1)
            chosen = [{c: g[c] for c in kept} for g, a in zip(group, asked) if a]
            if chosen:
                yield pa.RecordBatch.from_pylist(chosen, kind)

    ordered = _by_unit(rows).select(*kept, "sketch")
    return ordered.mapInArrow(compare, ordered.drop("sketch").schema)


# --- verification ------------------------------------------------------------------------------------


def similarities(a: Weighted, b: Weighted, texts: int) -> np.ndarray:
    """Weighted Jaccard similarity of text i of a and text i of b."""
    of, key = np.concatenate([a.of, b.of]), np.concatenate([a.key, b.key])
    weight = np.concatenate([a.weight, b.weight])
    order = np.lexsort((key, of))
    of, key, weight = of[order], key[order], weight[order]
    twin = np.flatnonzero((of[1:] == of[:-1]) & (key[1:] == key[:-1]))
    both = np.bincount(of[twin], weights=np.minimum(weight[twin], weight[twin + 1]), minlength=texts)
    total = np.bincount(of, weights=weight, minlength=texts)
    return np.divide(both, total - both, out=np.zeros(texts), where=total > both)


def verified(pairs: DataFrame, texts: DataFrame, table: Broadcast, similarity: float) -> DataFrame:
    """The pairs whose whole texts are similar enough. ``texts``: ``node``, ``text``."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for half in slices(batch, "text_a", 1 << 20):
                for part in slices(half, "text_b", 1 << 20):
                    both = [weighted_shingles(words(*text_bytes(part.column(c))), table.value) for c in ("text_a", "text_b")]
                    good = similarities(*both, part.num_rows) >= similarity - 1e-9
                    yield part.select(["a", "b"]).filter(pa.array(good))

    one = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b").mapInArrow(check, "a string, b string")


def _all_similarities(found: Weighted, texts: int) -> np.ndarray:
    """Weighted Jaccard similarity of all pairs of a unit's texts.

    A shingle that occurs n times is n features of its single weight; what two texts share is then a
    product of matrices over the features that more than one text has, taken in stretches.
    """
    at = np.repeat(np.arange(len(found.key)), found.times)
    level = np.arange(len(at)) - np.repeat(np.cumsum(found.times) - found.times, found.times)
    feature = mix(found.key[at] + level.astype(np.uint64) * np.uint64(ODD))
    single = (found.weight / found.times)[at]
    _, number, held = np.unique(feature, return_inverse=True, return_counts=True)
    shared = held[number] > 1
    of, number, single = found.of[at][shared], number[shared], single[shared]
    order = np.argsort(number, kind="stable")
    of, single = of[order], single[order]
    number = np.cumsum(np.concatenate([[0], (np.diff(number[order]) != 0).astype(np.int64)])) if len(order) else number
    both = np.zeros((texts, texts))
    width = 2048
    for low in range(0, int(number[-1]) + 1 if len(number) else 0, width):
        a, b = np.searchsorted(number, (low, low + width))
        matrix = np.zeros((texts, width))
        matrix[of[a:b], number[a:b] - low] = np.sqrt(single[a:b])
        both += matrix @ matrix.T
    total = np.bincount(found.of, weights=found.weight, minlength=texts)
    return both / np.maximum(total[:, None] + total - both, 1e-12)


def verified_units(rows: DataFrame, texts: DataFrame, table: Broadcast, similarity: float) -> DataFrame:
    """Pairs (``a`` < ``b``) that join whatever texts of a unit are similar and have different labels."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            column = pa.array([g["text"] for g in group], pa.large_string())
            found = weighted_shingles(words(*text_bytes(column)), table.value)
            similar = _all_similarities(found, len(group)) >= similarity - 1e-9
            yield _edges(group, _askable(group, similarity) & similar)

    return _by_unit(rows.join(texts, "node")).mapInArrow(check, "a string, b string").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``label``): the smallest node of each node's connected component; nodes without edges are left out.

    Labels go along edges and then to their label's label, until none changes. Each round is written
    to the shared folder, so it outlives its executors.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
    )
    labels = written(both.groupBy("node").agg(F.least("node", F.min("other")).alias("label")), "labels")
    while True:
        said = both.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("label").alias("said"))
        nearer = labels.join(said, "node").select("node", F.col("label").alias("old"), F.least("label", "said").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        new = written(
            nearer.join(jump, "label", "left").select("node", "old", F.least("label", "next").alias("label")), "labels"
        )
        labels = new.select("node", "label")
        if new.where("old <> label").isEmpty():
            return labels


# --- the whole ---------------------------------------------------------------------------------------


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``node`` (its text's name) and ``class_id``, the smallest doc_id of its class."""
    spark = docs.sparkSession
    own = docs.select("doc_id", "text")
    table = spark.sparkContext.broadcast(rarity(own))
    found = written(nodes(own, table), "nodes")
    in_buckets = written(members(found), "buckets")
    wanted = in_buckets.select("node").distinct()
    texts = own.select(text_name().alias("node"), "text").join(wanted, "node").groupBy("node").agg(F.first("text").alias("text"))
    texts = written(texts, "texts")

    tried = written(likely_pairs(in_buckets, found, similarity), "pairs")
    links = written(verified(tried, texts, table, similarity), "links")
    labels = components(links)
    rest = written(doubtful(in_buckets, found, labels, similarity), "doubtful")
    more = written(verified_units(rest, texts, table, similarity), "links")
    if not more.isEmpty():
        labels = components(links.unionByName(more))

    named = own.select("doc_id", text_name().alias("node")).join(labels, "node", "left")
    named = named.withColumn("label", F.coalesce("label", "node"))
    smallest = named.groupBy("label").agg(F.min("doc_id").alias("class_id"))
    return named.join(smallest, "label").select("doc_id", "node", "class_id")


def without_copies(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents with one of each class left: the one with the smallest doc_id, and of its rows the one whose text's name is smallest.

    Rows without doc_id stay only where the whole class has none; then one row stays per distinct text.
    """
    known = written(classes(docs, similarity), "classes")
    keep = known.where(F.col("doc_id").eqNullSafe(F.col("class_id")))
    with_id = keep.where("doc_id IS NOT NULL").groupBy("class_id").agg(F.min("node").alias("node"), F.count("*").alias("n"))
    without = keep.where("doc_id IS NULL").groupBy("node").agg(F.count("*").alias("n"))
    id_, node = free_name("kept_id", docs.columns), free_name("kept_node", docs.columns)
    chosen = written(
        with_id.select(F.col("class_id").alias(id_), F.col("node").alias(node), "n").unionByName(
            without.select(F.lit(None).cast("bigint").alias(id_), F.col("node").alias(node), "n")
        ),
        "chosen",
    )
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (text_name() == F.col(node))
    stay = docs.join(chosen.where("n = 1").drop("n"), same, "left_semi")
    repeated = chosen.where("n > 1").drop("n")
    if repeated.isEmpty():
        return stay
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    again = docs.join(repeated, same).groupBy(id_, node).agg(F.min(row).alias("row"))
    return stay.unionByName(again.select("row.*"))
