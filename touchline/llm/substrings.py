"""Removal of repeated substrings: bytes covered by a 100-byte string that also starts earlier.

Texts are UTF-8 bytes; strings do not cross texts. Earlier means a smaller doc_id or an earlier start in
the same document. What is repeated is decided on the input, not on what is left of it.

1. Every 100-byte window has an anchor: of the 32-byte strings inside it the one with the smallest hash,
   the leftmost of equals. Equal windows have equal anchors at the same place, so they meet wherever
   anchors meet. Consecutive windows with one anchor make a segment; segments are rows with the hashes
   of the anchor and of the whole segment, about one for 40 bytes.
2. Of equal segments (128 bits of hash) only the first one goes on; all windows of the others are repeated. This
   is done inside each task first, so a passage that many documents share gives a row per task. Segments whose anchor stands
   nowhere else drop out.
3. The first segments that share an anchor with different ones are read again. Each task makes
   shards of them, sorts each shard's suffixes once and takes its Burrows-Wheeler transform. The
   transforms are merged by interleave refinement: the rows of all shards stand in one order, and each round
   carries every row to the row of the suffix that is one byte longer (by the shard's own last-to-first table),
   with a stable sort by that byte. After t rounds rows are grouped by their first t bytes, so the rounds give
   common prefixes without sorting suffixes again, and after 100 rounds the groups are the repeated intervals.
   Rows whose group has no second member are dropped on the way.
4. In each interval all windows but the first one are repeated.

Anchors with very many different segments are split by the hash of the 93 bytes that
neighbouring windows have in common, so that no task gets a group that grows with the data.

NULL is the empty text. Texts shorter than a window lose nothing. A NULL doc_id counts as the largest one. Rows with
equal id and text are one document and get equal results; different texts under one id are told apart by 64
bits of hash, and among them the smaller start is earlier. Of equal strings at one start under one id none is earlier.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.text import mix, powers, slices, text_bytes
from touchline.session import written

WINDOW = 100
GRAM = 32
# Segments of one anchor from which it is split, windows in a part, and bytes common to them.
HOT, PART = 20_000, 8
CORE = WINDOW - PART + 1
PLACE_BITS = 24
STRETCH = 1 << 20
FLUSH_ROWS = 1 << 20
SHARD_BYTES = 1 << 19
MERGE_BYTES = 1 << 22

LAST_ID = (1 << 63) - 1


# --- segments --------------------------------------------------------------------------------------


class Segments(NamedTuple):
    """Runs of windows with one anchor: text number, first and last start, anchor's place, hashes."""

    of: np.ndarray
    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    anchor_key: np.ndarray
    key: np.ndarray


def _byte_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    up, down = powers(len(data))
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    return total, down


def _segments(data: np.ndarray, offsets: np.ndarray) -> Segments:
    """Segments of texts with fewer than 2**PLACE_BITS bytes in all; places count from the first byte."""
    none = np.zeros(0, np.int64)
    if len(data) < WINDOW:
        return Segments(none, none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    total, down = _byte_sums(data)
    grams = mix((total[GRAM:] - total[:-GRAM]) * down[: len(data) - GRAM + 1])
    low = np.uint64((1 << PLACE_BITS) - 1)
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    width, wanted = 1, WINDOW - GRAM + 1
    while width * 2 <= wanted:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    starts = len(data) - WINDOW + 1
    owner = np.minimum(least[:starts], least[wanted - width : wanted - width + starts]) & low
    # the last starts of each text would cross its end
    edge = np.zeros(len(data) + 1, np.int32)
    np.add.at(edge, np.maximum(offsets[1:] - WINDOW + 1, offsets[:-1]), 1)
    np.add.at(edge, offsets[1:], -1)
    valid = np.flatnonzero(np.cumsum(edge[:starts]) == 0)
    if not len(valid):
        return Segments(none, none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    own = owner[valid]
    cut = np.flatnonzero((own[1:] != own[:-1]) | (valid[1:] != valid[:-1] + 1))
    first, last = valid[np.append(0, cut + 1)], valid[np.append(cut, len(valid) - 1)]
    anchor = own[np.append(0, cut + 1)].astype(np.int64)
    key = mix((total[last + WINDOW] - total[first]) * down[first] + (last - first).astype(np.uint64))
    return Segments(np.searchsorted(offsets, first, "right") - 1, first, last, anchor, grams[anchor], key)


def segments(data: np.ndarray, offsets: np.ndarray) -> Iterator[Segments]:
    """Segments of all texts, with places inside their text; long texts go in overlapping stretches."""
    if len(offsets) == 2 and len(data) > 2 * STRETCH:
        for at in range(0, len(data) - WINDOW + 1, STRETCH):
            part = data[at : at + STRETCH + WINDOW - 1]
            s = _segments(part, np.array([0, len(part)]))
            yield s._replace(first=s.first + at, last=s.last + at, anchor=s.anchor + at)
    else:
        s = _segments(data, offsets)
        base = offsets[s.of] if len(s.of) else s.of
        yield s._replace(first=s.first - base, last=s.last - base, anchor=s.anchor - base)


# A place packs first start (31 bits), windows after the first (7) and anchor after it (7).


def _pack(first, last, anchor):
    return first << 32 | (last - first) << 25 | (anchor - first) << 18


def _unpack(place):
    first = place >> 32
    return first, first + (place >> 25 & 127), first + (place >> 18 & 127)


def _heads(fresh: np.ndarray) -> np.ndarray:
    """For each row the number of the row that its group begins with."""
    return np.maximum.accumulate(np.where(fresh, np.arange(len(fresh)), 0))


def keyed(docs: DataFrame) -> DataFrame:
    """(``id``, ``version``, ``body``, ``nameless``): the version tells different texts under one id apart.

    A NULL id counts as the largest one; ``nameless`` tells it from a document that has that id.
    """
    body = F.coalesce("text", F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID)).alias("id"),
        F.xxhash64(body).alias("version"),
        body.alias("body"),
        F.col("doc_id").isNull().alias("nameless"),
    )


# What is known of a segment: nothing yet, all its windows are repeated, it has to be compared, the same with a hot anchor.
OPEN, REPEATED, COMPARE, COMPARE_HOT = 0, 1, 2, 3


def segment_rows(texts: DataFrame) -> DataFrame:
    """A row per segment; of equal segments in one task's flush those that start later than the first are marked as repeated.

    Repeated rows of a document give one row, and so do not count as later.
    """

    def combine(parts: list[np.ndarray]) -> pa.RecordBatch:
        anchor, key, doc, place, version = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((version, place, doc, key, anchor))
        anchor, key, doc, place, version = anchor[order], key[order], doc[order], place[order], version[order]
        fresh, same = np.ones(len(order), bool), np.zeros(len(order), bool)
        fresh[1:] = (anchor[1:] != anchor[:-1]) | (key[1:] != key[:-1])
        same[1:] = ~fresh[1:] & (doc[1:] == doc[:-1]) & (place[1:] == place[:-1]) & (version[1:] == version[:-1])
        head = _heads(fresh)
        again = ((doc != doc[head]) | (place != place[head]))[~same]
        anchor, key, doc, place, version = (c[~same] for c in (anchor, key, doc, place, version))
        # done rows are dealt evenly
        spread = np.where(again, mix(place.astype(np.uint64) ^ doc.astype(np.uint64)), anchor)
        return pa.RecordBatch.from_arrays(
            [pa.array(spread.view(np.int64)), pa.array(np.where(again, np.uint64(0), key).view(np.int64)),
             pa.array(doc), pa.array(place), pa.array(version), pa.array(np.where(again, REPEATED, OPEN).astype(np.int8))],
            ["anchor", "segment", "id", "place", "version", "state"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, rows = [], 0
        for batch in batches:
            for part in slices(batch, "body", STRETCH):
                ids = part.column("id").to_numpy(zero_copy_only=False)
                versions = part.column("version").to_numpy(zero_copy_only=False)
                for s in segments(*text_bytes(part.column("body"))):
                    if len(s.of):
                        parts.append((s.anchor_key, s.key, ids[s.of], _pack(s.first, s.last, s.anchor), versions[s.of]))
                        rows += len(s.of)
                if rows >= FLUSH_ROWS:
                    yield combine(parts)
                    parts, rows = [], 0
        if parts:
            yield combine(parts)

    return texts.mapInArrow(run, "anchor bigint, segment bigint, id bigint, place bigint, version bigint, state tinyint")


def sort_out(rows: DataFrame) -> DataFrame:
    """Marks (``id``, ``version``, ``place``, ``state``, ``anchor``) of the segments that are repeated or have to be compared.

    Rows come sorted by anchor and segment and are read as a stream that holds at most HOT of them.
    """

    def marks(anchor, doc, place, version, state) -> pa.RecordBatch:
        states = np.broadcast_to(np.int8(state), len(doc)).copy()
        return pa.RecordBatch.from_arrays(
            [pa.array(doc), pa.array(version), pa.array(place), pa.array(states), pa.array(anchor)],
            ["id", "version", "place", "state", "anchor"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = [np.zeros(0, np.int64)] * 5
        held = none  # first segments of the last anchor, and whether each is the first of its equals
        first = last = none  # the first and the last row of the last segment
        hot: int | None = None
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            done = columns.pop() == REPEATED
            if done.any():
                anchor, _, doc, place, version = (c[done] for c in columns)
                yield marks(anchor, doc, place, version, REPEATED)
                columns = [c[~done] for c in columns]
            if not len(columns[0]):
                continue
            # the first and the last row of the segment that the batch before ended with go before this batch
            carried = len(last[0]) * 2
            anchor, key, doc, place, version = (np.concatenate(c) for c in zip(first, last, columns)) if carried else columns
            fresh, same = np.ones(len(anchor), bool), np.zeros(len(anchor), bool)
            fresh[1:] = (anchor[1:] != anchor[:-1]) | (key[1:] != key[:-1])
            same[1:] = ~fresh[1:] & (doc[1:] == doc[:-1]) & (place[1:] == place[:-1]) & (version[1:] == version[:-1])
            head = _heads(fresh)
            later = (doc != doc[head]) | (place != place[head])
            first = [c[head[-1:]] for c in (anchor, key, doc, place, version)]
            last = [c[-1:] for c in (anchor, key, doc, place, version)]
            new = ~same
            new[:carried] = False
            again = later & new
            if again.any():
                yield marks(anchor[again], doc[again], place[again], version[again], REPEATED)
            rest = new & ~later
            anchor, doc, place, version, fresh = (
                np.concatenate([h, c[rest]]) for h, c in zip(held, (anchor, doc, place, version, fresh.astype(np.int64)))
            )
            if not len(anchor):
                continue
            edge = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
            count = np.diff(np.append(edge, len(anchor)))
            size = np.repeat(count, count)
            different = np.repeat(np.add.reduceat(fresh, edge), count)
            whole = anchor != anchor[-1]
            for chosen, mark in (
                (whole & (different > 1) & (size <= HOT) & (anchor != hot), COMPARE),
                ((whole & (different > 1) & (size > HOT)) | (whole & (anchor == hot)), COMPARE_HOT),
            ):
                if chosen.any():
                    yield marks(anchor[chosen], doc[chosen], place[chosen], version[chosen], mark)
            rest = ~whole
            if rest.sum() > HOT or hot is not None and anchor[-1] == hot:
                hot = int(anchor[-1])
                yield marks(anchor[rest], doc[rest], place[rest], version[rest], COMPARE_HOT)
                held = none
            else:
                held = [c[rest] for c in (anchor, doc, place, version, fresh)]
        if held[-1].sum() > 1:
            yield marks(*held[:-1], COMPARE)

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartition(parts, "anchor").sortWithinPartitions("anchor", "segment", "id", "place", "version")
    return ordered.mapInArrow(run, "id bigint, version bigint, place bigint, state tinyint, anchor bigint")


def segment_texts(texts: DataFrame, marks: DataFrame) -> DataFrame:
    """(``part``, ``id``, ``version``, ``place``, ``bytes``) of the segments to compare; hot anchors are split into parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "body", STRETCH):
                rows = []
                for doc, version, body, wanted in zip(*(c.to_pylist() for c in piece.columns)):
                    data = body.encode()
                    for mark in wanted:
                        first, last, anchor = _unpack(mark["place"])
                        if mark["state"] == COMPARE:
                            rows.append((mark["anchor"], doc, version, _pack(first, last, first), data[first : last + WINDOW]))
                            continue
                        for part in range((anchor - last) // PART, (anchor - first) // PART + 1):
                            a, b = max(first, anchor - PART * part - PART + 1), min(last, anchor - PART * part)
                            core = anchor - PART * part
                            name = hashlib.blake2b(data[core : core + CORE], digest_size=8).digest()
                            rows.append(
                                (int.from_bytes(name, "little", signed=True), doc, version, _pack(a, b, a), data[a : b + WINDOW])
                            )
                columns = list(zip(*rows)) if rows else [[]] * 5
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), k) for c, k in zip(columns, kinds)], ["part", "id", "version", "place", "bytes"]
                )

    wanted = (
        marks.where(F.col("state") != REPEATED)
        .groupBy("id", "version")
        .agg(F.collect_list(F.struct("place", "state", "anchor")).alias("wanted"))
    )
    joined = texts.join(wanted, ["id", "version"]).select("id", "version", "body", "wanted")
    return joined.mapInArrow(run, "part bigint, id bigint, version bigint, place bigint, bytes binary")


# --- Burrows-Wheeler transforms ----------------------------------------------------------------------


class Shard(NamedTuple):
    """Rows in suffix order: the byte before each suffix, the row of that longer suffix, and where it starts.

    Strings end with a mark (0; bytes count from 1); ends are ordered by string number.
    """

    before: np.ndarray
    longer: np.ndarray
    start: np.ndarray


def transform(text: np.ndarray, ends: np.ndarray) -> Shard:
    """Sort the suffixes of the strings in ``text`` (marks included, at ``ends``) and take the transform.

    Prefix doubling from eight bytes on; suffixes do not go beyond their mark, and equal ones stand in string order.
    """
    n = len(text)
    bound = np.repeat(ends, np.diff(np.concatenate([[-1], ends])))  # the mark that ends each place's string
    padded = np.concatenate([text.astype(np.uint64), np.zeros(8, np.uint64)])
    place = np.arange(n)
    word = np.zeros(n, np.uint64)
    for j in range(7):  # 7 symbols of 9 bits
        symbol = np.where(place + j <= bound, padded[j : j + n], np.uint64(0))
        word = word << np.uint64(9) | symbol
    order = np.argsort(word, kind="stable")
    sorted_word = word[order]
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(np.concatenate([[0], (sorted_word[1:] != sorted_word[:-1]).astype(np.int64)]))
    depth = 7
    longest = int(np.diff(np.concatenate([[-1], ends])).max())
    while depth < longest:
        further = place + depth
        second = np.where(further <= bound, rank[np.minimum(further, n - 1)] + 1, 0)
        both = rank * np.int64(n + 1) + second
        order = np.argsort(both, kind="stable")
        sorted_both = both[order]
        rank[order] = np.cumsum(np.concatenate([[0], (sorted_both[1:] != sorted_both[:-1]).astype(np.int64)]))
        depth *= 2
    # equal suffixes stand in the order of their strings, as the stable sort left them
    row = np.empty(n, np.int64)
    row[order] = np.arange(n)
    first = np.zeros(n, bool)
    first[0] = True
    first[ends[:-1] + 1] = True
    previous = np.maximum(place - 1, 0)
    before = np.where(first, 0, text[previous])
    return Shard(before[order].astype(np.uint16), row[previous][order], order)


def repeated_intervals(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Merge the shards by interleave refinement: (row, group) of all suffixes that share their first ``depth`` bytes.

    Rows are numbered through all shards. In each round a row steps to the suffix that is one byte longer; the stable
    sort by that byte keeps the order of the round before, and a group goes on where byte and former group are equal.
    Suffixes that begin a string have no longer one and stop; a row alone in its group cannot meet another later.
    """
    base = np.cumsum([0] + [len(s.before) for s in shards])
    before = np.concatenate([s.before for s in shards])
    longer = np.concatenate([s.longer + b for s, b in zip(shards, base)])
    rows, group = np.arange(base[-1]), np.zeros(base[-1], np.int64)
    for _ in range(depth):
        symbol = before[rows]
        rows, group, symbol = rows[symbol > 0], group[symbol > 0], symbol[symbol > 0]
        order = np.argsort(symbol, kind="stable")
        symbol, group, rows = symbol[order], group[order], longer[rows[order]]
        if len(rows) < 2:
            return rows[:0], group[:0]
        fresh = np.concatenate([[True], (symbol[1:] != symbol[:-1]) | (group[1:] != group[:-1])])
        group = np.cumsum(fresh)
        shared = ~fresh
        shared[:-1] |= ~fresh[1:]
        rows, group = rows[shared], group[shared]
    return rows, group


def repeated_windows(found: list[tuple[int, int, bytes]], versions: list[int] | None = None) -> list[tuple[int, int, int, int]]:
    """Of segments (id, place, bytes): runs (id, version, first start, last start) of windows that also start earlier."""
    shards: list[Shard] = []
    starts: list[np.ndarray] = []  # for each suffix row its segment's number and its offset there
    at = 0
    while at < len(found):
        to, size = at, 0
        while to < len(found) and (to == at or size + len(found[to][2]) < SHARD_BYTES):
            size += len(found[to][2]) + 1
            to += 1
        lengths = np.array([len(f[2]) for f in found[at:to]], np.int64)
        ends = np.cumsum(lengths + 1) - 1
        text = np.frombuffer(b"\0".join([f[2] for f in found[at:to]]) + b"\0", np.uint8).astype(np.uint16) + 1
        text[ends] = 0
        shard = transform(text, ends)
        string = np.searchsorted(ends, shard.start)
        offset = shard.start - (ends - lengths)[string]
        shards.append(shard)
        starts.append(np.stack([string + at, offset]))
        at = to
    rows, group = repeated_intervals(shards, WINDOW)
    if not len(rows):
        return []
    segment, offset = np.concatenate(starts, axis=1)[:, rows]
    doc = np.array([f[0] for f in found], np.int64)[segment]
    version = np.array(versions or [0] * len(found), np.int64)[segment]
    start = _unpack(np.array([f[1] for f in found], np.int64)[segment])[0] + offset
    order = np.lexsort((version, start, doc, group))
    doc, version, start, group = doc[order], version[order], start[order], group[order]
    head = _heads(np.concatenate([[True], group[1:] != group[:-1]]))
    later = (doc != doc[head]) | (start != start[head])
    if not later.any():
        return []
    doc, version, start = doc[later], version[later], start[later]
    order = np.lexsort((start, version, doc))
    doc, version, start = doc[order], version[order], start[order]
    cut = np.flatnonzero((doc[1:] != doc[:-1]) | (version[1:] != version[:-1]) | (start[1:] != start[:-1] + 1))
    a, b = np.append(0, cut + 1), np.append(cut, len(doc) - 1)
    return list(zip(doc[a].tolist(), version[a].tolist(), start[a].tolist(), start[b].tolist()))


def compared(rows: DataFrame) -> DataFrame:
    """Runs of repeated windows (``id``, ``version``, ``first``, ``last``) of the segments to compare."""

    def result(found: list[tuple[int, int, bytes]], versions: list[int]) -> pa.RecordBatch:
        runs = repeated_windows(found, versions)
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in runs], pa.int64()) for i in range(4)], ["id", "version", "first", "last"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, versions, size, last = [], [], 0, None
        for batch in batches:
            for part, doc, version, place, data in zip(*(c.to_pylist() for c in batch.columns)):
                if (part, doc, version, place) == last:  # of a repeated row
                    continue
                if size >= MERGE_BYTES and part != last[0]:
                    yield result(found, versions)
                    found, versions, size = [], [], 0
                found.append((doc, place, data))
                versions.append(version)
                size, last = size + len(data), (part, doc, version, place)
        if len(found) > 1:
            yield result(found, versions)

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartition(parts, "part").sortWithinPartitions("part", "id", "version", "place")
    return ordered.mapInArrow(run, "id bigint, version bigint, first bigint, last bigint")


# --- the whole -------------------------------------------------------------------------------------


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(``id``, ``version``, ``spans``): runs of starts (first, last) whose windows are repeated; see ``keyed``."""
    texts = keyed(docs)
    marks = written(sort_out(segment_rows(texts)), "marks")
    more = compared(segment_texts(texts, marks))
    first = F.shiftright("place", 32)
    runs = marks.where(F.col("state") == REPEATED).select(
        "id",
        "version",
        first.alias("first"),
        (first + F.shiftright("place", 25).bitwiseAND(F.lit(127))).alias("last"),
    )
    return runs.unionByName(more).groupBy("id", "version").agg(F.collect_list(F.struct("first", "last")).alias("spans"))


def _removed(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal removed byte runs (start, end)."""
    out: list[list[int]] = []
    for first, last in sorted((s["first"], s["last"]) for s in spans or ()):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last + WINDOW)
        else:
            out.append([first, last + WINDOW])
    return [tuple(r) for r in out]


def without_repeats(docs: DataFrame, digests: bool = False) -> DataFrame:
    """Every document's id, ``n_bytes``, ``n_removed``, ``n_spans`` and the ``kept`` bytes (or their ``kept_sha256``)."""
    kind = "string" if digests else "binary"
    name = "kept_sha256" if digests else "kept"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "body", STRETCH):
                rows = []
                for doc, body, nameless, spans in zip(*(c.to_pylist() for c in part.columns)):
                    data, runs, at, kept = body.encode(), _removed(spans), 0, []
                    for a, b in runs:
                        kept.append(data[at:a])
                        at = b
                    left = b"".join([*kept, data[at:]])
                    made = hashlib.sha256(left).hexdigest() if digests else left
                    rows.append((None if nameless else doc, len(data), len(data) - len(left), len(runs), made))
                kinds = [pa.int64()] * 4 + [pa.string() if digests else pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], ["doc_id", "n_bytes", "n_removed", "n_spans", name]
                )

    joined = keyed(docs).join(repeated_spans(docs), ["id", "version"], "left").select("id", "body", "nameless", "spans")
    return joined.mapInArrow(run, f"doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, {name} {kind}")
