"""Ranked lexical search over K2-treaps of the term-document grid.

The index cuts the documents, where they lie, into blocks of bounded size. A block is a grid: a row
for each of its terms (frequent ones first), a column for each document (by doc_id), and in a cell
the impact of the term in the document. The grid is kept as a K2-treap: a quadtree in which each node
holds the largest impact of its square and the place of that cell, which is taken out of the squares
below; so values fall on the way down, and there is one node for each cell that is not empty. Nodes
are stored level by level as four bits that say which quarters hold anything, the value as difference
to the parent, and the place inside the square.

Items are searched in a block in groups of a bounded number of terms. A partial answer is an item with a
range of documents; it holds, for each term of the item, the node on the path to that term's row and the
cells of the row that were met on the way. The sum of what each term can still give bounds the scores in
the range. The most promising ranges of each item are halved first: the paths of all its terms go down
together. Those that have to wait are left untouched on a stack until what came of the others is done, so
that a range is copied a few times, however many wait, and at most a few sets wait for each level of the
grid. A range whose rows are exhausted is scored exactly. Ranges that cannot enter an item's best any more
are dropped; the best are carried from block to block within a task.

``build`` reads the documents twice (counts, then blocks) and shuffles nothing but two sums. Items go to
all tasks in chunks of at most ``CHUNK_TERMS`` terms (or one item), so what is broadcast is bounded. For
each chunk one job adds up the document frequencies of its terms from the blocks' dictionaries, and one
searches all blocks. What is shuffled then is ``best`` rows for each item and task.

Terms are compared by 64 bits of hash. A NULL or empty text has no terms; such documents are in no
answer. Rows that share an item_id are one item with the terms of all of them, a NULL item_id being
one, too. Documents with equal ids are ranked each for itself; among equal scores the smallest
doc_id comes first, NULL last. Other columns are not read, whatever their names. An empty table of
documents or items gives an empty answer.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from touchline.llm.text import WORD_BYTES, slices, text_bytes, words
from touchline.session import new_folder, written

BLOCK_DOCS, BLOCK_CELLS = 8192, 1 << 21
CHUNK_TERMS = 1 << 16
BEST = 10
# Ranges of each item that are halved in one step, pairs of ranges and terms that are worked on together, terms of items that are searched together.
STEP, STEP_PAIRS, GROUP_TERMS = 32, 1 << 17, 1 << 11

BITS = np.array([bin(i).count("1") for i in range(16)], np.int64)
# BELOW[mask, quarter]: quarters before this one that hold anything.
BELOW = np.array([[bin(m & ((1 << q) - 1)).count("1") for q in range(4)] for m in range(16)], np.int64)


def term_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The number of terms of each text."""
    inside = WORD_BYTES[data] != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    borders = offsets[1:-1]
    borders = borders[borders < len(data)]
    begins[borders] |= inside[borders]
    total = np.concatenate([[0], np.cumsum(begins)])
    return total[offsets[1:]] - total[offsets[:-1]]


def corpus_size(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """How many documents hold a term, and all their terms with repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holding = terms = 0
        for batch in batches:
            for part in slices(batch):
                n = term_counts(*text_bytes(part.column("text")))
                holding, terms = holding + int((n > 0).sum()), terms + int(n.sum())
        yield pa.RecordBatch.from_arrays([pa.array([holding]), pa.array([terms])], ["holding", "terms"])

    counted = docs.select(F.col(text).alias("text")).mapInArrow(run, "holding bigint, terms bigint")
    row = counted.agg(F.sum("holding"), F.sum("terms")).first()
    return int(row[0] or 0), int(row[1] or 0)


def spread(x: np.ndarray) -> np.ndarray:
    """Each bit of numbers below 2**32 moved to twice its place."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def gather(x: np.ndarray) -> np.ndarray:
    """What ``spread`` takes apart."""
    x = x & np.uint64(0x5555555555555555)
    for shift, mask in ((1, 0x3333333333333333), (2, 0x0F0F0F0F0F0F0F0F), (4, 0x00FF00FF00FF00FF), (8, 0x0000FFFF0000FFFF), (16, 0x00000000FFFFFFFF)):
        x = (x | (x >> np.uint64(shift))) & np.uint64(mask)
    return x.astype(np.int64)


def pack(values: np.ndarray) -> bytes:
    """Compressed bytes of an array, all first bytes first, then all second ones, and so on."""
    data = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return len(values).to_bytes(8, "little") + pa.Codec("zstd").compress(data, asbytes=True)


def unpack(data: bytes, kind: type) -> np.ndarray:
    n, size = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    if not n:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.Codec("zstd").decompress(data[8:], n * size, asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).view(kind).reshape(n)


class Treap(NamedTuple):
    """Nodes level by level. ``row`` and ``column`` are the place of the node's own cell. An impact is below 10**6."""

    height: int
    mask: np.ndarray
    first: np.ndarray
    value: np.ndarray
    row: np.ndarray
    column: np.ndarray


def treap_levels(row: np.ndarray, column: np.ndarray, value: np.ndarray) -> tuple[int, list[int], np.ndarray, np.ndarray, np.ndarray]:
    """Height, nodes of each level, masks, differences to the parents and places, from the cells of a grid."""
    height = int(max(row.max(), column.max())).bit_length()
    code = (spread(row) << np.uint64(1)) | spread(column)
    order = np.argsort(code)
    code, value = code[order], value[order]
    sizes, masks, deltas, places = [], [], [], []
    above_square = above_value = None
    for level in range(height + 1):
        if not len(code):
            break
        shift = np.uint64(2 * (height - level))
        square = code >> shift
        starts = np.flatnonzero(np.concatenate([[True], square[1:] != square[:-1]]))
        n = len(code)
        top = np.maximum.reduceat(value * n + np.arange(n - 1, -1, -1), starts)
        at = n - 1 - top % n
        square, best = square[starts], value[at]
        if above_square is None:
            deltas.append(best)
        else:
            parent = np.searchsorted(above_square, square >> np.uint64(2))
            np.bitwise_or.at(masks[-1], parent, (1 << (square & np.uint64(3)).astype(np.int64)).astype(np.uint8))
            deltas.append(above_value[parent] - best)
        sizes.append(len(starts))
        masks.append(np.zeros(len(starts), np.uint8))
        places.append(code[at] & ((np.uint64(1) << shift) - np.uint64(1)))
        above_square, above_value = square, best
        left = np.ones(n, bool)
        left[at] = False
        code, value = code[left], value[left]
    return height, sizes, np.concatenate(masks), np.concatenate(deltas), np.concatenate(places)


def treap(height: int, sizes: list[int], mask: np.ndarray, delta: np.ndarray, place: np.ndarray) -> Treap:
    """The nodes as they are searched."""
    first = np.concatenate([[1], 1 + np.cumsum(BITS[mask])[:-1]]).astype(np.int32)
    value, code = np.empty(len(mask), np.int32), np.empty(len(mask), np.uint64)
    at, above, square = 0, None, np.zeros(1, np.uint64)
    for level, n in enumerate(sizes):
        own = slice(at, at + n)
        if above is None:
            value[own] = delta[own]
        else:
            held = mask[above][:, None] >> np.arange(4)[None, :] & 1 == 1
            parent, quarter = np.nonzero(held)
            value[own] = value[above][parent] - delta[own]
            square = square[parent] << np.uint64(2) | quarter.astype(np.uint64)
        code[own] = square << np.uint64(2 * (height - level)) | place[own]
        above, at = own, at + n
    return Treap(height, mask, first, value, gather(code >> np.uint64(1)).astype(np.uint32), gather(code).astype(np.uint32))


class Block(NamedTuple):
    """Documents (sorted by id, NULL last), dictionary (sorted keys, their rows) and cells."""

    ids: np.ndarray
    unknown: np.ndarray
    keys: np.ndarray
    rows: np.ndarray
    cells: Treap


BLOCK_SCHEMA = "n_docs bigint, keys binary, held binary, ids binary, unknown binary, rows binary, height int, sizes array<bigint>, masks binary, deltas binary, places binary"


def block_row(ids: np.ndarray, unknown: np.ndarray, lengths: np.ndarray, doc: np.ndarray, key: np.ndarray, tf: np.ndarray, corpus: tuple[int, int]) -> dict:
    """A row of the index from a block's documents and their terms with counts."""
    holding, terms = corpus
    order = np.lexsort((ids, unknown))
    column_of = np.empty(len(ids), np.int64)
    column_of[order] = np.arange(len(ids))
    keys, number, held = np.unique(key, return_inverse=True, return_counts=True)
    by_count = np.argsort(-held, kind="stable")
    rows = np.empty(len(keys), np.int64)
    rows[by_count] = np.arange(len(keys))
    # 90 * n * N fits in 64 bits for any text and corpus that can be held
    m = 10 + (90 * lengths * holding) // terms
    impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])
    height, sizes, masks, deltas, places = treap_levels(rows[number], column_of[doc], impact)
    return {
        "n_docs": len(ids), "keys": pack(keys), "held": pack(held.astype(np.uint32)), "ids": pack(ids[order]),
        "unknown": pack(unknown[order]), "rows": pack(rows.astype(np.uint32)), "height": height, "sizes": sizes,
        "masks": pack(masks), "deltas": pack(deltas.astype(np.uint32)), "places": pack(places),
    }


def block_of(row: dict) -> Block:
    cells = treap(row["height"], row["sizes"], unpack(row["masks"], np.uint8), unpack(row["deltas"], np.uint32).astype(np.int64), unpack(row["places"], np.uint64))
    return Block(unpack(row["ids"], np.int64), unpack(row["unknown"], np.bool_), unpack(row["keys"], np.uint64), unpack(row["rows"], np.uint32).astype(np.int64), cells)


def doc_terms(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lengths of the texts in terms, and (text, key, count) of their distinct terms."""
    found = words(*text_bytes(part.column("text")))
    lengths = np.diff(found.first)
    doc = np.repeat(np.arange(part.num_rows), lengths)
    order = np.lexsort((found.key, doc))
    doc, key = doc[order], found.key[order]
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])]) if len(doc) else np.zeros(0, bool)
    starts = np.flatnonzero(new)
    return lengths, doc[starts], key[starts], np.diff(np.concatenate([starts, [len(doc)]]))


def index_blocks(docs: DataFrame, corpus: tuple[int, int], doc_id: str = "doc_id", text: str = "text", block_docs: int = BLOCK_DOCS, block_cells: int = BLOCK_CELLS) -> DataFrame:
    """One row for each block of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        docs_held = cells_held = 0
        schema = pa.schema([("n_docs", pa.int64())] + [(c, pa.binary()) for c in ("keys", "held", "ids", "unknown", "rows")]
                           + [("height", pa.int32()), ("sizes", pa.list_(pa.int64()))] + [(c, pa.binary()) for c in ("masks", "deltas", "places")])

        def full() -> Iterator[pa.RecordBatch]:
            if cells_held:
                row = block_row(*[np.concatenate([h[i] for h in held]) for i in range(6)], corpus)
                yield pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for part in slices(batch):
                for at in range(0, part.num_rows, block_docs):
                    piece = part.slice(at, block_docs)
                    lengths, doc, key, tf = doc_terms(piece)
                    if docs_held and (docs_held + piece.num_rows > block_docs or cells_held + len(doc) > block_cells):
                        yield from full()
                        held, docs_held, cells_held = [], 0, 0
                    ids = piece.column("doc_id")
                    unknown = ids.is_null().to_numpy(zero_copy_only=False)
                    held.append((ids.fill_null(0).to_numpy(zero_copy_only=False), unknown, lengths, doc + docs_held, key, tf))
                    docs_held, cells_held = docs_held + piece.num_rows, cells_held + len(doc)
        yield from full()

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, BLOCK_SCHEMA)


class Index(NamedTuple):
    blocks: DataFrame
    holding: int
    terms: int


def build(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **sizes: int) -> Index:
    """The index as a table in the shared folder, so that lost executors lose nothing of it."""
    corpus = corpus_size(docs, text)
    blocks = index_blocks(docs, corpus, doc_id, text, **sizes)
    path = new_folder(docs.sparkSession, "ranked-index")
    # a row group for each block or two, so that readers hold few of them at once
    blocks.write.option("parquet.block.size", 16 << 20).option("parquet.block.size.row.check.min", 1).parquet(path)
    return Index(docs.sparkSession.read.schema(blocks.schema).parquet(path), *corpus)


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (item_id, key) of all items."""
    kind = items.schema[item_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                _, doc, key, _ = doc_terms(part)
                yield pa.RecordBatch.from_arrays([part.column("item_id").take(pa.array(doc)), pa.array(key.view(np.int64))], ["item_id", "key"])

    found = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    return found.mapInArrow(run, f"item_id {kind}, key bigint").distinct()


def frequencies(index: Index, keys: np.ndarray) -> np.ndarray:
    """How many documents hold each of the keys (sorted, of a chunk), from the dictionaries of the blocks."""
    shared = index.blocks.sparkSession.sparkContext.broadcast(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(shared.value), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                own, held = (unpack(batch.column(c)[i].as_py(), k) for c, k in (("keys", np.uint64), ("held", np.uint32)))
                at = np.minimum(np.searchsorted(own, shared.value), len(own) - 1)
                total += np.where(own[at] == shared.value, held[at], 0)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["number", "df"])

    counted = index.blocks.select("keys", "held").mapInArrow(run, "number bigint, df bigint")
    out = np.zeros(len(keys), np.int64)
    for row in counted.groupBy("number").agg(F.sum("df").alias("df")).collect():
        out[row["number"]] = row["df"]
    return out


def weight(df: np.ndarray, holding: int) -> np.ndarray:
    return np.floor(1000 * np.log((2.0 * holding + 2) / (2.0 * df + 1))).astype(np.int64)


class Queries(NamedTuple):
    """A chunk of items: (item, key, weight) sorted by item."""

    item: np.ndarray
    key: np.ndarray
    weight: np.ndarray


class Answers(NamedTuple):
    """Documents found so far, the best of each item first."""

    item: np.ndarray
    score: np.ndarray
    unknown: np.ndarray
    doc: np.ndarray

    def with_best(self, other: Answers, best: int) -> Answers:
        item, score, unknown, doc = (np.concatenate(p) for p in zip(self, other))
        order = np.lexsort((doc, unknown, -score, item))
        item = item[order]
        keep = order[place_in_group(item) < best]
        return Answers(*(a[keep] for a in (np.concatenate(p) for p in zip(self, other))))

    def between(self, low: int, high: int) -> Answers:
        """The answers of the items ``low`` to ``high``, which are numbered from 0."""
        a, b = np.searchsorted(self.item, (low, high))
        return Answers(self.item[a:b] - low, self.score[a:b], self.unknown[a:b], self.doc[a:b])

    def limits(self, items: int, best: int) -> tuple[np.ndarray, np.ndarray]:
        """Score and id of the last document of each item that has enough; without, 0 and the largest id."""
        score, doc = np.zeros(items, np.int64), np.full(items, np.iinfo(np.int64).max)
        last = place_in_group(self.item) == best - 1
        score[self.item[last]] = self.score[last]
        doc[self.item[last & ~self.unknown]] = self.doc[last & ~self.unknown]
        return score, doc


NO_ANSWERS = Answers(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))


def place_in_group(group: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... within each run of equal numbers."""
    if not len(group):
        return np.zeros(0, np.int64)
    new = np.concatenate([[True], group[1:] != group[:-1]])
    starts = np.flatnonzero(new)
    return np.arange(len(group)) - np.repeat(starts, np.diff(np.append(starts, len(group))))


class Ranges(NamedTuple):
    """Partial answers; pairs are sorted by range, cells name their pair."""

    item: np.ndarray
    start: np.ndarray
    level: np.ndarray
    bound: np.ndarray
    pair_range: np.ndarray
    pair_row: np.ndarray
    pair_weight: np.ndarray
    pair_node: np.ndarray
    cell_pair: np.ndarray
    cell_column: np.ndarray
    cell_value: np.ndarray

    def pick(self, chosen: np.ndarray) -> Ranges:
        """The ranges of a mask, in their order."""
        if chosen.all():
            return self
        number = np.cumsum(chosen) - 1
        pairs = chosen[self.pair_range]
        pair_number = np.cumsum(pairs) - 1
        cells = pairs[self.cell_pair]
        return Ranges(
            *(a[chosen] for a in self[:4]),
            number[self.pair_range[pairs]], *(a[pairs] for a in self[5:8]),
            pair_number[self.cell_pair[cells]], *(a[cells] for a in self[9:]),
        )


def started(cells: Treap, item: np.ndarray, row: np.ndarray, weights: np.ndarray) -> Ranges:
    """One range with all documents for each item."""
    items, number = np.unique(item, return_inverse=True)
    own = np.flatnonzero(cells.row[0] == row)
    none = np.zeros(len(items), np.int64)
    return Ranges(
        items, none, none, np.bincount(number, weights * cells.value[0]).astype(np.int64) if len(items) else none,
        number, row, weights, np.full(len(row), 0 if cells.mask[0] else -1),
        own, np.full(len(own), cells.column[0]), weights[own] * cells.value[0],
    )


def halved(cells: Treap, ranges: Ranges) -> Ranges:
    """Both halves of each range, with the nodes one level down."""
    n, pairs = len(ranges.item), len(ranges.pair_range)
    shift = cells.height - 1 - ranges.level
    pair_shift = shift[ranges.pair_range]
    live = ranges.pair_node >= 0
    node = np.where(live, ranges.pair_node, 0)
    mask, first = np.where(live, cells.mask[node], 0), cells.first[node]
    row_bit = ranges.pair_row >> pair_shift & 1
    child = np.full((pairs, 2), -1, np.int64)
    for half in (0, 1):
        quarter = row_bit * 2 + half
        there = mask >> quarter & 1 == 1
        child[there, half] = (first + BELOW[mask, quarter])[there]
    # cells met before go to their half; a child's own cell may lie in the row
    cell_half = ranges.cell_column >> pair_shift[ranges.cell_pair] & 1
    flat = child.reshape(-1)
    met = np.flatnonzero((flat >= 0) & (cells.row[flat] == np.repeat(ranges.pair_row, 2)))
    cell_pair = np.concatenate([ranges.cell_pair * 2 + cell_half, met])
    cell_column = np.concatenate([ranges.cell_column, cells.column[flat[met]]])
    cell_value = np.concatenate([ranges.cell_value, np.repeat(ranges.pair_weight, 2)[met] * cells.value[flat[met]]])
    flat = np.where((flat >= 0) & (cells.mask[flat] > 0), flat, -1)  # nodes without children hold nothing more
    most = np.where(flat >= 0, np.repeat(ranges.pair_weight, 2) * cells.value[flat], 0)
    np.maximum.at(most, cell_pair, cell_value)
    useful = most > 0
    # pairs lie by (range, term, half); bring them to (range, half, term)
    wide = np.arange(pairs * 2)
    target = np.repeat(ranges.pair_range, 2) * 2 + wide % 2
    order = np.argsort(target[useful], kind="stable")
    kept = wide[useful][order]
    number = np.full(pairs * 2, -1, np.int64)
    number[kept] = np.arange(len(kept))
    target = target[kept]
    starts = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]])) if len(target) else np.zeros(0, np.int64)
    half_range = target[starts]
    held = number[cell_pair] >= 0
    parent = half_range // 2
    return Ranges(
        ranges.item[parent], ranges.start[parent] + (half_range % 2 << shift[parent]), ranges.level[parent] + 1,
        np.add.reduceat(most[kept], starts) if len(starts) else starts,
        np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(kept)))), ranges.pair_row[kept // 2], ranges.pair_weight[kept // 2], flat[kept],
        number[cell_pair[held]], cell_column[held], cell_value[held],
    )


def scored(block: Block, done: Ranges) -> Answers:
    """Exact scores of the documents in ranges that hold no nodes any more."""
    if not len(done.cell_pair):
        return NO_ANSWERS
    in_range = done.pair_range[done.cell_pair]
    order = np.lexsort((done.cell_column, in_range))
    in_range, column = in_range[order], done.cell_column[order]
    starts = np.flatnonzero(np.concatenate([[True], (in_range[1:] != in_range[:-1]) | (column[1:] != column[:-1])]))
    score, column = np.add.reduceat(done.cell_value[order], starts), column[starts]
    found = score > 0
    return Answers(done.item[in_range[starts]][found], score[found], block.unknown[column][found], block.ids[column][found])


def item_groups(item: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Borders in sorted item numbers that keep an item together; between two are at most ``most`` terms (or one item)."""
    ends = np.append(np.flatnonzero(item[1:] != item[:-1]) + 1, len(item))
    at = 0
    while at < len(item):
        to = int(ends[max(np.searchsorted(ends, at + most, "right") - 1, np.searchsorted(ends, at, "right"))])
        yield at, to
        at = to


def search_group(block: Block, begun: Ranges, answers: Answers, items: int, best: int) -> Answers:
    """The best documents of a group of items. The newest set of ranges is halved first; of it, the most promising ranges of each item."""
    waiting = [begun]
    while waiting:
        ranges = waiting.pop()
        limit, limit_doc = answers.limits(items, best)
        least = np.where(block.unknown[ranges.start], np.iinfo(np.int64).max, block.ids[ranges.start])
        floor = limit[ranges.item]
        ranges = ranges.pick((ranges.bound > floor) | (ranges.bound == floor) & (floor > 0) & (least <= limit_doc[ranges.item]))
        ready = np.ones(len(ranges.item), bool)
        ready[ranges.pair_range[ranges.pair_node >= 0]] = False
        if ready.any():
            answers = answers.with_best(scored(block, ranges.pick(ready)), best)
            ranges = ranges.pick(~ready)
        if not len(ranges.item):
            continue
        order = np.lexsort((-ranges.bound, ranges.item))
        chosen = order[place_in_group(ranges.item[order]) < STEP]
        size = np.bincount(ranges.pair_range, minlength=len(ranges.item))
        chosen = chosen[: max(1, int(np.searchsorted(np.cumsum(size[chosen]), STEP_PAIRS)))]
        now = np.zeros(len(ranges.item), bool)
        now[chosen] = True
        if not now.all():
            waiting.append(ranges.pick(~now))
        waiting.append(halved(block.cells, ranges.pick(now)))
    return answers


def search(block: Block, queries: Queries, answers: Answers, items: int, best: int = BEST) -> Answers:
    """The best documents of each item, among those found before and those of the block."""
    at = np.minimum(np.searchsorted(block.keys, queries.key), len(block.keys) - 1)
    use = (block.keys[at] == queries.key) & (queries.weight > 0)
    item, row, weights = queries.item[use], block.rows[at[use]], queries.weight[use]
    found = []
    low = 0
    for a, b in item_groups(item, GROUP_TERMS):
        high = int(item[b]) if b < len(item) else items
        own = search_group(block, started(block.cells, item[a:b] - low, row[a:b], weights[a:b]), answers.between(low, high), high - low, best)
        found.append(own._replace(item=own.item + low))
        low = high
    return Answers(*(np.concatenate(p) for p in zip(*found))) if found else answers


def item_chunks(terms: DataFrame, most: int) -> Iterator[list]:
    """The ids of all items in order, so many at a time that their terms are at most ``most`` (or one item).

    The ids come row by row; only one chunk's are held.
    """
    held, ids = 0, []
    for row in terms.groupBy("item_id").agg(F.count(F.lit(1)).alias("terms")).orderBy("item_id").toLocalIterator():
        if held and held + row["terms"] > most:
            yield ids
            held, ids = 0, []
        ids.append(row["item_id"])
        held += row["terms"]
    if held:
        yield ids


def chunk_queries(index: Index, terms: DataFrame, ids: list) -> Queries:
    """The weighed terms of a chunk of items, which are numbered as in ``ids``."""
    kind = terms.schema["item_id"].dataType.simpleString()
    names = terms.sparkSession.createDataFrame(list(zip(ids, range(len(ids)))), f"name {kind}, number bigint")
    own = terms.join(F.broadcast(names), F.col("item_id").eqNullSafe(F.col("name")))
    rows = own.select("number", "key").orderBy("number", "key").collect()
    item = np.array([r["number"] for r in rows], np.int64)
    key = np.array([r["key"] for r in rows], np.int64).view(np.uint64)
    keys, place = np.unique(key, return_inverse=True)
    df = frequencies(index, keys)[place]
    return Queries(item[df > 0], key[df > 0], weight(df[df > 0], index.holding))


def search_chunk(index: Index, queries: Queries, ids: list, kind: DataType, best: int) -> DataFrame:
    """The best documents of each task for a chunk of items."""
    shared = index.blocks.sparkSession.sparkContext.broadcast((queries, ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use, names = shared.value
        answers = NO_ANSWERS
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                answers = search(block_of(row), use, answers, len(names), best)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([names[i] for i in answers.item.tolist()], to_arrow_type(kind)),
                pa.array(answers.doc, pa.int64(), mask=answers.unknown),
                pa.array(answers.score, pa.int64()),
            ],
            ["item_id", "doc_id", "score"],
        )

    return index.blocks.drop("n_docs", "held").mapInArrow(run, f"item_id {kind.simpleString()}, doc_id bigint, score bigint")


def rank(index: Index, items: DataFrame, item_id: str = "item_id", text: str = "text", best: int = BEST, chunk_terms: int = CHUNK_TERMS) -> DataFrame:
    """The best documents of each item: item_id, rank (from 1), doc_id, score."""
    kind = items.schema[item_id].dataType
    terms = written(item_terms(items, item_id, text), "item-terms")
    found = items.sparkSession.createDataFrame([], f"item_id {kind.simpleString()}, doc_id bigint, score bigint")
    for ids in item_chunks(terms, chunk_terms):
        found = found.unionByName(search_chunk(index, chunk_queries(index, terms, ids), ids, kind, best))
    first = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= best)
    return ranked.select("item_id", "rank", "doc_id", "score")
