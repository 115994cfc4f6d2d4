"""CSV records of files that are read in parts, although values may hold line breaks.

Whether a line begins a record depends on all lines before it: it does if no quoted value is open
there. Each part of a file is looked at once without knowing that. It is then known, for both cases, in
which state the part ends. Composing the parts of a file in order tells the state at the start of
each, so a second scan cuts every part into records on its own. The few records that cross a border
are put together from their pieces.

What the driver composes is one entry for each part of the scan, of which Spark's driver has a list
anyway; no text goes there but the files' first records, which are their headers.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUOTE = '"'
# A value from its start: quoted, up to the next comma, or not.
QUOTED = re.compile(r'"(?:[^"]|"")*("?)[^,]*')
REST_OF_QUOTED = re.compile(r'(?:[^"]|"")*("?)[^,]*')
UNQUOTED = re.compile("[^,]*")
# Lines whose quotes open and close values in turn: each that opens one is the first, behind a comma or behind another.
TURNS_FROM_OUTSIDE = '^(?:(?:[^"]*,)?"[^"]*")*(?:(?:[^"]*,)?"[^"]*|[^"]*)$'
TURNS_FROM_INSIDE = '^[^"]*(?:"(?:[^"]*,)?"[^"]*)*(?:"[^"]*)?$'


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted value is open after the line, given whether one is before it.

    A quote opens a value only as its first character; in an unquoted value it is just a character.
    """
    pieces = line.split(QUOTE)
    # quotes that open a value, if all do that in turn: after a comma, at the start, or right behind another
    outside = pieces[1 if inside else 0 : -1 : 2]
    if all(not p or p.endswith(",") for p in outside):
        return inside ^ (len(pieces) % 2 == 0)
    at = 0
    if inside:
        m = REST_OF_QUOTED.match(line)
        if not m[1]:
            return True
        at = m.end() + 1
    while at <= len(line):
        if line[at : at + 1] == QUOTE:
            m = QUOTED.match(line, at)
            if not m[1]:
                return True
        else:
            m = UNQUOTED.match(line, at)
        at = m.end() + 1
    return False


class Part(NamedTuple):
    """What a part of a file says of itself: how it ends after either start, and whether a record begins in it if a value is open at first."""

    path: str
    block: int
    outside: bool
    inside: bool
    begins: bool
    header: str | None


class Start(NamedTuple):
    """How a part starts: with an open value or not, the part where the open record began, its file's header."""

    inside: bool
    owner: int
    header: int


def text_lines(spark: SparkSession, paths: str | Sequence[str], glob: str) -> DataFrame:
    """Lines of all files with the path of their file and the place of the part they stand in."""
    return (
        spark.read.option("pathGlobFilter", glob)
        .option("lineSep", "\n")
        .text(paths if isinstance(paths, str) else list(paths))
        .select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))
    )


def _same_part(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.Array]]:
    """Stretches of lines of one part."""
    path, block = batch.column("path").dictionary_encode(), batch.column("block")
    codes, blocks = path.indices.to_numpy(zero_copy_only=False), block.to_numpy(zero_copy_only=False)
    edges = [0, *[i for i in range(1, len(codes)) if codes[i] != codes[i - 1] or blocks[i] != blocks[i - 1]], len(codes)]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield path.dictionary[int(codes[a])].as_py(), int(blocks[a]), batch.column("value").slice(a, b - a)


def open_values(lines: pa.Array, inside: bool) -> np.ndarray:
    """Whether a quoted value is open before each line and, as the last entry, after all of them.

    Where quotes open and close values in turn, an odd number of them changes the state, which is summed up for all
    lines at once; other lines are looked at one by one.
    """
    odd = pc.bit_wise_and(pc.count_substring(lines, QUOTE), 1).to_numpy(zero_copy_only=False).astype(bool)
    state = np.concatenate([[inside], np.logical_xor.accumulate(odd) ^ inside])
    plain = {False: _matches(lines, TURNS_FROM_OUTSIDE)}
    if state[:-1].any() or not plain[False].all():
        plain[True] = _matches(lines, TURNS_FROM_INSIDE)
        good = np.where(state[:-1], plain[True], plain[False])
        if not good.all():
            first = int(np.argmin(good))
            now = bool(state[first])
            for i in range(first, len(lines)):
                now = now ^ bool(odd[i]) if plain[now][i] else ends_inside(lines[i].as_py(), now)
                state[i + 1] = now
    return state


def _matches(lines: pa.Array, pattern: str) -> np.ndarray:
    return pc.match_substring_regex(lines, pattern).to_numpy(zero_copy_only=False)


def parts(lines: DataFrame, multi_line: bool) -> list[Part]:
    """One entry for each part of the scan."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []
        for batch in batches:
            for path, block, values in _same_part(batch):
                if now is None or (now["path"], now["block"]) != (path, block):
                    now = {"path": path, "block": block, "outside": False, "inside": True, "begins": False, "header": None, "open": block == 0}
                    out.append(now)
                at = 0
                while now["open"] and at < len(values):  # the first record of the file
                    line = values[at].as_py()
                    now["header"] = line if now["header"] is None else f"{now['header']}\n{line}"
                    now["open"] = multi_line and ends_inside(now["header"], False)
                    at += 1
                if multi_line:
                    outside = open_values(values, now["outside"])
                    inside = outside if now["inside"] == now["outside"] else open_values(values, now["inside"])
                    now["begins"] |= not inside[:-1].all()  # a line before which no value is open begins a record
                    now["outside"], now["inside"] = bool(outside[-1]), bool(inside[-1])
        names = Part._fields
        kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array([p[n] for p in out], k) for n, k in zip(names, kinds)], names)

    schema = "path string, block bigint, outside boolean, inside boolean, begins boolean, header string"
    return [Part(*r) for r in lines.mapInArrow(run, schema).collect()]


def starts(found: list[Part]) -> tuple[dict[tuple[str, int], Start], list[str], bool]:
    """How each part starts, the distinct headers, and whether any record crosses a border."""
    headers: dict[str, int] = {}
    out: dict[tuple[str, int], Start] = {}
    path, inside, owner, header, crossing = None, False, 0, 0, False
    for part in sorted(found):
        if part.path != path:
            path, inside, owner = part.path, False, 0
            header = headers.setdefault((part.header or "").removesuffix("\r"), len(headers))
        out[part.path, part.block] = Start(inside, owner, header)
        crossing |= inside
        if not inside or part.begins:
            owner = part.block
        inside = part.inside if inside else part.outside
    return out, list(headers), crossing


def header_names(header: str) -> list[str]:
    """Names from a header record: stripped, without byte order mark; '' for a missing or repeated one."""
    names: list[str] = []
    for value in next(csv.reader(io.StringIO(header.removeprefix("\ufeff"), newline="")), []):
        name = value.removeprefix("\ufeff").strip()
        names.append("" if name in names else name)
    return names


WHOLE, PIECE = 0, 1


def cut(lines: DataFrame, start_of: dict[tuple[str, int], Start], multi_line: bool, kinds: Sequence[int]) -> DataFrame:
    """Whole records, pieces of records, or both, as ``kinds`` says: (record, header, path, owner, block).

    Headers and blank lines between records are left out.
    """
    shared = lines.sparkSession.sparkContext.broadcast(start_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(texts: pa.Array, path: str, start: Start, owner: int, block: int) -> pa.RecordBatch:
            n = len(texts)
            same = lambda value, kind: pa.repeat(pa.scalar(value, kind), n)
            return pa.RecordBatch.from_arrays(
                [texts, same(start.header, pa.int32()), same(path, pa.string()), same(owner, pa.int64()), same(block, pa.int64())],
                ["record", "header", "path", "owner", "block"],
            )

        def whole(texts: list[pa.Array], path: str, block: int, start: Start, first: bool) -> Iterator[pa.RecordBatch]:
            done = pa.chunked_array(texts, pa.string()).combine_chunks()
            if first and len(done):  # the header
                done = done.slice(1)
            done = pc.utf8_rtrim(done, characters="\r")
            done = done.filter(pc.not_equal(pc.utf8_trim_whitespace(done), ""))
            if len(done):
                yield rows(done, path, start, block, block)

        key = start = None
        held: list[str] = []  # lines of a record that is not whole yet
        foreign = fresh = False  # the record began in an earlier part; nothing whole has been met in this one

        def close() -> Iterator[pa.RecordBatch]:
            """What a part leaves open goes on in the next one."""
            if held and PIECE in kinds:
                path, block = key
                yield rows(pa.array(["\n".join(held)]), path, start, start.owner if foreign else block, block)

        for batch in batches:
            for path, block, values in _same_part(batch):
                if key != (path, block):
                    if key is not None:
                        yield from close()
                    key, held = (path, block), []
                    if key not in shared.value:
                        raise RuntimeError(f"{path} is cut into other parts than when its quotes were looked at; read it anew")
                    start = shared.value[key]
                    inside = foreign = start.inside and multi_line
                    fresh = block == 0
                n = len(values)
                state = open_values(values, inside) if multi_line else np.zeros(n + 1, bool)
                begins = np.flatnonzero(~state[:-1])  # lines at which a record begins
                first = int(begins[0]) if len(begins) else n
                done: list[pa.Array] = []
                if inside:  # the rest of a record, or more of it
                    held += values.slice(0, first).to_pylist()
                    if not state[first]:
                        record = pa.array(["\n".join(held)])
                        if not foreign:
                            done.append(record)
                        elif PIECE in kinds:
                            yield rows(pc.utf8_rtrim(record, characters="\r"), path, start, start.owner, block)
                        held, foreign = [], False
                inside = bool(state[-1])
                last = int(begins[-1]) if inside and len(begins) else n  # where the record begins that stays open
                if last < n:
                    held = values.slice(last).to_pylist()
                begins = begins[begins < last]
                if len(begins) and WHOLE in kinds:
                    lists = pa.ListArray.from_arrays(pa.array([*begins, last], pa.int32()), values)
                    done.append(pc.binary_join(lists, "\n") if len(begins) < last - first else values.slice(first, last - first))
                if WHOLE in kinds and any(map(len, done)):
                    yield from whole(done, path, block, start, fresh)
                    fresh = False
        if key is not None:
            yield from close()

    schema = "record string, header int, path string, owner bigint, block bigint"
    return lines.mapInArrow(run, schema)


def csv_records(spark: SparkSession, paths: str | Sequence[str], glob: str, multi_line: bool) -> tuple[DataFrame, list[str]]:
    """All records but headers (record, header, path), and the files' distinct headers.

    ``header`` is the number of the file's header, which has to end in the file's first part. A file
    whose last value is never closed gives the rest of it as one record.
    """
    lines = text_lines(spark, paths, glob)
    start_of, headers, crossing = starts(parts(lines, multi_line))
    names = ["record", "header", "path"]
    if not crossing:  # a piece is the rest of a file, then
        return cut(lines, start_of, multi_line, (WHOLE, PIECE)).select(names), headers
    pieces = cut(lines, start_of, multi_line, (PIECE,))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "record"))), lambda p: p["record"]), "\n")
    joined = pieces.groupBy("path", "owner").agg(text.alias("record"), F.first("header").alias("header"))
    return cut(lines, start_of, multi_line, (WHOLE,)).select(names).unionByName(joined.select(names)), headers


def by_header(headers: dict[int, list[str]], name: str, value: Sequence[Column]) -> Column:
    """The value under a name, wherever a record's header has it; NULL where it has not."""
    places: dict[int, list[int]] = {}
    for number, names in headers.items():
        if name in names:
            places.setdefault(names.index(name), []).append(number)
    if not places:
        return F.lit(None).cast("string")
    if len(places) == 1 and len(next(iter(places.values()))) == len(headers):
        return value[next(iter(places))]
    out = None
    for place, numbers in places.items():
        here = F.col("header").isin(numbers)
        out = F.when(here, value[place]) if out is None else out.when(here, value[place])
    return out
