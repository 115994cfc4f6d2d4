"""Secret scans: strict patterns, and the guess cost of values that stand where credentials do.

Base spans come from strict patterns and always stay. Besides, values behind credential words
(``pwd = ...``, ``Authorization: Bearer ...``, ``https://user:...@host``) are weighed by what guessing
them would cost, in bits: the cheapest way to cut a value into words, dates, repeats, sequences,
keyboard walks and characters that have to be tried out, found by dynamic programming over its
places. A value of at least ``THRESHOLD`` bits becomes a span of kind ``guess`` unless it touches a
base span; placeholders and plain words (``changeme``, ``your-token-here``) cost too little.

Words are weighed by how often they occur: the cost of a word is the logarithm of all words over
its count in the whole corpus. The counts are joined to the parts of the values that might be words
and go nowhere else, so nothing grows on the driver or in a broadcast. Equal values are weighed once;
a value shared by very many documents meets its cost in a join whose hot side adaptive execution
splits. A value longer than ``PIECE`` characters is weighed by its costliest piece, so a task never
holds more than the parts of one piece.

NULL is the empty text. Positions are code points, ends are exclusive. Rows with equal ids keep
apart. Only the text and the columns to keep are read, whatever other names there are. An empty
table gives an empty one.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.text import free_name, run_keys, slices, text_bytes
from touchline.session import written

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "guess")


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


# The base patterns and their least lengths.
ASSIGN_NAMES = ("password", "passwd", "secret", "token", "api_?key")
ASSIGN = re.compile(
    "(" + "|".join(map(_either_case, ASSIGN_NAMES)) + ")"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile("AKIA[A-Z0-9]{14,}")
HEX = re.compile("(?<![0-9a-f])[0-9a-f]{16,}")
LEAST_ASSIGN = 12

# Where credentials stand: words, in any of their spellings, that name a value, and two fixed places.
NAMES = (
    "password", "passwd", "passphrase", "passcode", "passwort", "pwd", "secret", "token", "credential", "credentials",
    "api key", "apikey", "access key", "private key", "secret key", "client secret", "encryption key", "signing key",
    "session key", "master key", "auth key", "auth token", "mot de passe", "contraseña", "kennwort",
)
NAMED = re.compile(
    "(?:" + "|".join(sorted((w.replace(" ", "[ _-]?") for w in NAMES), key=len, reverse=True)) + r")[A-Za-z0-9_\]-]{0,24}[\"'`]?\s{0,8}(?:=>|:=|[:=])\s{0,8}[\"'`]?"
    r"([^\s\"'`,;<>(){}]{6,})",
    re.I,
)
BEARER = re.compile(r"\b(?:bearer|basic)\x20{1,4}([A-Za-z0-9+/_.=~-]{6,})", re.I)
IN_URL = re.compile(r"://[^\s/:@\"']{1,64}:([^\s/@\"']{6,256})@")
# A text that holds none of these, in lower case, has no value in credential context.
CONTEXT = ("pass", "pwd", "secret", "token", "credential", "key", "contrase", "kennwort", "bearer", "basic", "://")

THRESHOLD = 32.0
PIECE = 512
# Words of the corpus: lengths of letter runs, and how often one has to occur to count as a word.
SHORTEST, LONGEST, LEAST_COUNT = 3, 16, 2

# Look-alikes of letters, and the rows of a keyboard with how far each is shifted to the right.
LEET = {"0": "o", "1": "l", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
KEYBOARD = (("1234567890-=", 0.0), ("qwertyuiop[]", 0.5), ("asdfghjkl;'", 0.75), ("zxcvbnm,./", 1.25))

SEGMENT_BITS = 1.0
DATE = re.compile(r"(?:(?:19|20)\d\d([-/._]?)(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12]\d|3[01])|(?:0?[1-9]|[12]\d|3[01])([-/._]?)(?:0?[1-9]|1[0-2])\2(?:19|20)\d\d)")
YEAR = re.compile(r"(?:19|20)\d\d")
DATE_BITS, YEAR_BITS, SEPARATOR_BITS = math.log2(365.25 * 130), math.log2(130), 2.0


def _neighbours() -> dict[str, frozenset[str]]:
    places = {key: (row, shift + i) for row, (keys, shift) in enumerate(KEYBOARD) for i, key in enumerate(keys)}
    near = lambda a, b: a != b and abs(a[0] - b[0]) <= 1 and abs(a[1] - b[1]) <= 1
    return {key: frozenset(other for other, b in places.items() if near(a, b)) for key, a in places.items()}


NEIGHBOURS = _neighbours()
WALK_START = math.log2(len(NEIGHBOURS))
WALK_STEP = math.log2(sum(map(len, NEIGHBOURS.values())) / len(NEIGHBOURS))


class Value(NamedTuple):
    start: int
    end: int


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the strict patterns (kind, start, end), by start, then kind as listed."""
    found, low = [], text.lower()
    if any(w.split("_?")[0] in low for w in ASSIGN_NAMES):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def values(text: str) -> list[Value]:
    """Values in credential contexts, by start, none inside or across another."""
    low = text.lower()
    if not any(w in low for w in CONTEXT):
        return []
    found = sorted(m.span(1) for pattern in (NAMED, BEARER, IN_URL) for m in pattern.finditer(text))
    out, last = [], -1
    for start, end in found:
        while end - start > 6 and text[end - 1] in ".!?:":
            end -= 1
        if start >= last:
            out.append(Value(start, end))
            last = end
    return out


def plain(text: str) -> str:
    """Lower case, with look-alikes read as letters."""
    return "".join(LEET.get(c, c) for c in text.lower())


def _letter(c: str) -> bool:
    return "a" <= c <= "z"


def parts(value: str) -> set[str]:
    """All that might be a word in a value."""
    text = plain(value)
    found = set()
    for run in re.finditer("[a-z]{%d,}" % SHORTEST, text):
        a, b = run.span()
        for i in range(a, b - SHORTEST + 1):
            found.update(text[i:j] for j in range(i + SHORTEST, min(b, i + LONGEST) + 1))
    return found


def _char_bits(c: str) -> float:
    if "0" <= c <= "9":
        return math.log2(10)
    if _letter(c.lower()):
        return math.log2(26) + (1.0 if c.isupper() else 0.0)
    return math.log2(33) if c.isascii() else 8.0


def _word_bits(value: str, word_bits: float) -> float:
    """The cost of a word as it is written: capitals and look-alikes come on top."""
    upper = sum(c.isupper() for c in value)
    letters = sum(c.isalpha() for c in value)
    if not upper:
        case = 0.0
    elif upper == letters or upper == 1 and value[0].isupper():
        case = 1.0
    else:
        case = math.log2(math.comb(letters, upper) + 1)
    return word_bits + case + sum(c in LEET for c in value)


def _runs(value: str, follows) -> list[tuple[int, int]]:
    """Longest runs of at least three characters in which each follows the one before."""
    out, start = [], 0
    for i in range(1, len(value) + 1):
        if i == len(value) or not follows(value[i - 1], value[i]):
            if i - start >= 3:
                out.append((start, i))
            start = i
    return out


def _walk_bits(run: str) -> float:
    """A keyboard walk: where it begins, how long it is, and each change of direction."""
    step = lambda a, b: (ord(b) - ord(a), b in NEIGHBOURS.get(a, ()))
    turns = sum(step(a, b) != step(b, c) for a, b, c in zip(run, run[1:], run[2:]))
    return WALK_START + WALK_STEP * (1 + turns) + math.log2(len(run))


def segments(value: str, words: dict[str, float]) -> list[tuple[int, int, float]]:
    """(start, end, bits) of all words, dates, sequences and keyboard walks."""
    found, text, low = [], plain(value), value.lower()
    if words:
        for i in range(len(text)):
            for j in range(i + SHORTEST, min(len(text), i + LONGEST) + 1):
                bits = words.get(text[i:j])
                if bits is not None:
                    found.append((i, j, _word_bits(value[i:j], bits)))
    for i in range(len(value)):
        if "0" <= value[i] <= "9":
            date, year = DATE.match(value, i), YEAR.match(value, i)
            if date:
                found.append((i, date.end(), DATE_BITS + SEPARATOR_BITS * bool(date[1] or date[2])))
            if year:
                found.append((i, i + 4, YEAR_BITS))
    for step in (1, -1):
        for a, b in _runs(low, lambda x, y: ord(y) - ord(x) == step and x.isalnum() and y.isalnum()):
            # any piece of a sequence is one, too
            start_bits = math.log2(10) if low[a].isdigit() else math.log2(26)
            found += [(i, j, start_bits + 1 + math.log2(j - i)) for i in range(a, b - 2) for j in range(i + 3, b + 1)]
    for a, b in _runs(low, lambda x, y: y in NEIGHBOURS.get(x, ())):
        found += [(i, j, _walk_bits(low[i:j])) for i in range(a, b - 2) for j in range(i + 3, min(b, i + 32) + 1)]
    return found


def repeats(value: str, most: int = 8) -> list[tuple[int, int, int]]:
    """(start, end, unit) of stretches that repeat a unit of at most ``most`` characters, three times for a single one."""
    out = []
    for unit in range(1, most + 1):
        i = 0
        while i + unit < len(value):
            j = i + unit
            while j < len(value) and value[j] == value[j - unit]:
                j += 1
            times = (j - i) // unit
            if times >= (3 if unit == 1 else 2):
                out.append((i, i + times * unit, unit))
            i = max(i + 1, j - unit + 1)
    return out


def guess_bits(value: str, words: dict[str, float], nested: bool = False) -> float:
    """The least cost of a value over all ways to cut it; each cut costs a bit."""
    by_end: dict[int, list[tuple[int, float]]] = {}
    for i, j, bits in segments(value, words):
        by_end.setdefault(j, []).append((i, bits))
    if not nested:
        for i, j, unit in repeats(value):
            bits = guess_bits(value[i : i + unit], words, True)
            for end in range(i + unit * (3 if unit == 1 else 2), j + 1, unit):
                by_end.setdefault(end, []).append((i, bits + math.log2((end - i) // unit)))
    cost = [0.0] + [math.inf] * len(value)
    trying = [math.inf] * (len(value) + 1)  # the last segment is tried out character by character
    for end in range(1, len(value) + 1):
        bits = _char_bits(value[end - 1])
        trying[end] = min(cost[end - 1] + SEGMENT_BITS, trying[end - 1]) + bits
        known = [cost[start] + bits + SEGMENT_BITS for start, bits in by_end.get(end, ())]
        cost[end] = min([trying[end], *known])
    return cost[-1]


def part_keys(value: str) -> dict[str, int]:
    """Keys of all parts of a value."""
    found = sorted(parts(value))
    if not found:
        return {}
    data = np.frombuffer("".join(found).encode(), np.uint8)
    end = np.cumsum([len(p) for p in found])
    keys = run_keys(data, np.concatenate([[0], end[:-1]]), end).view(np.int64)
    return dict(zip(found, keys.tolist()))


# Texts are counted in slices of so many bytes, and so many words are held before they are added up or given out.
WORD_SLICE, HELD_WORDS = 1 << 18, 1 << 18

LETTERS = np.zeros(256, np.uint8)
LETTERS[97:123] = LETTERS[65:91] = np.arange(97, 123)


def letter_words(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Keys of all runs of ASCII letters of a word's length, lower-cased."""
    low = LETTERS[data]
    inside = np.concatenate([low != 0, [False]])
    cut = np.zeros(len(inside), bool)
    cut[offsets[1:-1]] = True
    begins = np.flatnonzero(inside & (cut | ~np.concatenate([[False], inside[:-1]])))
    stops = np.flatnonzero(~inside | cut)
    ends = stops[np.searchsorted(stops, begins, "right")] if len(begins) else begins
    fits = (ends - begins >= SHORTEST) & (ends - begins <= LONGEST)
    begins, ends = begins[fits], ends[fits]
    keys = []
    for at in range(0, len(low), WORD_SLICE):  # words that begin in a range; powers of the hash base are kept for its length
        i, j = np.searchsorted(begins, (at, at + WORD_SLICE))
        if j > i:
            piece = low[at : at + WORD_SLICE + LONGEST]
            keys.append(run_keys(piece, begins[i:j] - at, ends[i:j] - at))
    return np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    key, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key)
    key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(n, first) if len(first) else n


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(key, n): how often each word occurs in all texts, added up within tasks first.

    A task holds the words of ``HELD_WORDS`` places and gives what it has when as many differ, so its memory is
    bounded; the groups that follow add up what several parts gave.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        out = lambda: pa.RecordBatch.from_arrays([pa.array(keys[0]), pa.array(counts[0])], ["key", "n"])
        for batch in batches:
            for part in slices(batch, limit=WORD_SLICE):
                new = letter_words(*text_bytes(part.column("text")))
                keys.append(new)
                counts.append(np.ones(len(new), np.int64))
                held += len(new)
                if held < HELD_WORDS:
                    continue
                (keys[:], counts[:]), held = [[a] for a in _added(keys, counts)], 0
                if len(keys[0]) >= HELD_WORDS:
                    yield out()
                    keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        keys[:], counts[:] = [[a] for a in _added(keys, counts)]
        yield out()

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "key bigint, n bigint")


FOUND_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
VALUE_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("pieces", pa.list_(pa.string()))]))
FOUND_SCHEMA = "base array<struct<kind:string,start:bigint,end:bigint>>, given array<struct<start:bigint,end:bigint,pieces:array<string>>>"


def marks(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Columns keep_0 and on, the base spans, and the values in credential contexts in pieces."""
    moved = docs.select(F.col(text).alias("text"), *[F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)])
    kept_schema = "".join(f"keep_{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(keep))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                base, given = [], []
                for t in part.column("text").to_pylist():
                    t = t or ""
                    base.append([{"kind": k, "start": a, "end": b} for k, a, b in base_spans(t)])
                    given.append(
                        [
                            {"start": a, "end": b, "pieces": [t[i : min(b, i + PIECE)] for i in range(a, b, PIECE)]}
                            for a, b in values(t)
                        ]
                    )
                names = [f"keep_{i}" for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(n) for n in names], pa.array(base, FOUND_TYPE), pa.array(given, VALUE_TYPE)], [*names, "base", "given"]
                )

    return moved.mapInArrow(run, kept_schema + FOUND_SCHEMA)


def piece_costs(pieces: DataFrame, counts: DataFrame) -> DataFrame:
    """(piece, bits) of distinct pieces, given the words' counts."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, piece in zip(batch.column("number").to_pylist(), batch.column("piece").to_pylist()):
                keys = list(part_keys(piece).values())
                yield pa.RecordBatch.from_arrays([pa.array([number] * len(keys), pa.int64()), pa.array(keys, pa.int64())], ["number", "key"])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = []
            for piece, known in zip(batch.column("piece").to_pylist(), batch.column("known").to_pylist()):
                of_key = {k["key"]: k["bits"] for k in known or ()}
                words = {p: of_key[k] for p, k in part_keys(piece).items() if k in of_key} if of_key else {}
                bits.append(guess_bits(piece, words))
            yield pa.RecordBatch.from_arrays([batch.column("piece"), pa.array(bits, pa.float64())], ["piece", "bits"])

    numbered = written(pieces.distinct().withColumn("number", F.monotonically_increasing_id()), "secret-pieces")
    asked = numbered.mapInArrow(split, "number bigint, key bigint")
    total = counts.agg(F.sum("n").alias("n")).first()["n"] or 1
    frequent = counts.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)
    known = asked.join(frequent, "key").select("number", F.struct("key", F.log2(total / F.col("n")).alias("bits")).alias("word"))
    lists = known.groupBy("number").agg(F.collect_list("word").alias("known"))
    return numbered.join(lists, "number", "left").select("piece", "known").mapInArrow(weigh, "piece string, bits double")


def scan(docs: DataFrame, keep: list[str], text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The ``keep`` columns and an array of spans (kind, start, end, base, bits), by start, then kind as listed.

    ``bits`` is the guess cost of the value in credential context that the span holds, if it holds one.
    If a column to keep is called spans, the array gets the next free name (``spans_``).
    """
    counts = written(word_counts(docs, text), "secret-words")
    found = written(marks(docs, keep, text).withColumn("row", F.monotonically_increasing_id()), "secret-marks")
    pieces = (
        found.where(F.size("given") > 0)
        .select("row", F.posexplode("given").alias("place", "value"))
        .select("row", "place", F.explode("value.pieces").alias("piece"))
    )
    costs = piece_costs(pieces.select("piece"), counts)
    weighed = (
        pieces.join(costs, "piece")
        .groupBy("row", "place")
        .agg(F.max("bits").alias("bits"))
        .groupBy("row")
        .agg(F.map_from_entries(F.collect_list(F.struct("place", "bits"))).alias("bits_of"))
    )
    costed = F.transform(
        "given", lambda v, i: F.struct(v["start"].alias("start"), v["end"].alias("end"), F.col("bits_of")[i].alias("bits"))
    )
    inside = lambda s: F.filter("costed", lambda v: (v["start"] >= s["start"]) & (v["end"] <= s["end"]))
    span = lambda kind, rank, s, base, bits: F.struct(
        s["start"].alias("start"), rank.alias("rank"), s["end"].alias("end"), kind.alias("kind"), F.lit(base).alias("base"), bits.alias("bits")
    )
    rank = lambda kind: F.array_position(F.array(*map(F.lit, KINDS)), kind).cast("int")
    base = F.transform("base", lambda s: span(s["kind"], rank(s["kind"]), s, True, F.array_max(F.transform(inside(s), lambda v: v["bits"]))))
    free = lambda v: ~F.exists("base", lambda s: (s["start"] < v["end"]) & (s["end"] > v["start"]))
    costly = F.filter("costed", lambda v: (v["bits"] >= threshold) & free(v))
    added = F.transform(costly, lambda v: span(F.lit("guess"), F.lit(len(KINDS)), v, False, v["bits"]))
    ordered = F.transform(
        F.array_sort(F.concat(base, added)),
        lambda s: F.struct(*[s[c].alias(c) for c in ("kind", "start", "end", "base", "bits")]),
    )
    return (
        found.join(weighed, "row", "left")
        .withColumn("costed", costed)
        .select(*[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)], ordered.alias(free_name("spans", keep)))
    )
