"""Byte-pair encoding and decoding of whole texts with a given public vocabulary.

The encoder backtracks instead of merging: at each place it takes the longest token that an
Aho-Corasick automaton finds there, and keeps it only if it may follow the token before it. Two
tokens may stand side by side if merging the bytes of both gives just these two tokens; a table of
answers grows as pairs are met. If a token does not fit, the next shorter token with the same start
is tried, and if none is left the token before is given up. Every place is visited a bounded number of times, so
the work is linear in the text, and the result equals the merges in rank order.

The decoder gathers token bytes from one blob by a table of offsets.

NULL counts as the empty text, which has no tokens. Very long texts are taken whole. The strings of
special tokens in a text become those tokens, as the public library does. Columns of the input other
than the text are passed on or left out as asked; their names do not matter.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from struct import pack

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.text import slices

# Fixed value: the public pattern that cuts text before merging.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# White space as Unicode has it, without the four information separators.
SPACE = r"[\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
NO_SPACE = SPACE.replace("[", "[^", 1)

# The same pattern over the first 256 code points, for a faster search in texts that hold no others.
LATIN = {"L": "A-Za-zªµºÀ-ÖØ-öø-ÿ", "N": "0-9²³¹¼½¾", "S": "\t-\r \x85\xa0"}

MEMO_PIECES = 100_000
MEMO_PAIRS = 300_000


def _byte_letters() -> dict[str, int]:
    """The letter by which a byte-level vocabulary writes each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Pieces(dict):
    """Encoded pieces by their text, in two generations: when the younger is full, the older one goes.

    Pieces in use move to the younger generation, so memory is bounded and common pieces stay.
    """

    def __init__(self, encode):
        super().__init__()
        self.encode = encode
        self.older: dict[str, tuple[bytes, str]] = {}

    def __missing__(self, piece: str) -> tuple[bytes, str]:
        if len(self) >= MEMO_PIECES:
            self.older = dict(self)
            self.clear()
        found = self.older.get(piece)
        if found is None:
            ids = self.encode(piece.encode())
            found = (pack(f"<{len(ids)}i", *ids), ",".join(map(str, ids)))
        self[piece] = found
        return found


class Coder:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters, vocabulary = _byte_letters(), spec["model"]["vocab"]
        raw = {bytes(letters[c] for c in text): i for text, i in vocabulary.items()}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.length = {i: len(b) for b, i in raw.items()}
        size = max([*raw.values(), *special.values()]) + 1
        table = [b""] * size
        for b, i in raw.items():
            table[i] = b
        for text, i in special.items():
            table[i] = text.encode()
        self.blob = np.frombuffer(b"".join(table), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(b) for b in table])]).astype(np.int64)
        # rank of a token: the step that makes it; bytes are there from the start
        self.rank = dict.fromkeys((i for b, i in raw.items() if len(b) == 1), -1)
        self.halves: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for rank, (left, right) in enumerate(spec["model"]["merges"]):
            a, b, c = vocabulary[left], vocabulary[right], vocabulary[left + right]
            self.merged[a, b] = rank
            if c not in self.halves:
                self.halves[c], self.rank[c] = (a, b), rank
        self.automaton = ahocorasick.Automaton()
        for b, i in raw.items():
            if i in self.rank:
                self.automaton.add_word(b.decode("latin-1"), (i, len(b)))
        self.automaton.make_automaton()
        self.shorter = {i: self._longest_within(table[i]) for i in self.rank}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.memo = _Pieces(self.encode_piece)
        pieces = regex.compile(PIECES.replace(r"[^\s", NO_SPACE[:-1]).replace(r"\S", NO_SPACE).replace(r"\s", SPACE))
        self.all_pieces = pieces.findall
        few = PIECES.replace(r"[^\s\p{L}\p{N}]", "[^{S}{L}{N}]").replace(r"\p{L}", "[{L}]").replace(r"\p{N}", "[{N}]")
        few = few.replace(r"\S", "[^{S}]").replace(r"\s", "[{S}]").format(**LATIN)
        self.latin_pieces = re.compile(few).findall
        self.special = special
        self.special_parts = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None

    def _longest_within(self, token: bytes) -> int | None:
        """The longest token that starts the token and is shorter."""
        found = None
        text = token.decode("latin-1")
        for end, (i, n) in self.automaton.iter(text):
            if end == n - 1 and n < len(text):
                found = i
        return found

    def _fits(self, a: int, b: int) -> bool:
        """Whether the bytes of a and b together encode to just a, b.

        Undo the merges of both tokens, latest first, and look for a merge across the border that comes earlier.

        ``limit`` is the rank of the merge undone last: a merge across the border is made first if its
        rank is lower, or if the ranks are equal and it lies to the left of the one undone.
        """
        limit, left_wins = len(self.merged), False
        while True:
            across = self.merged.get((a, b))
            if across is not None and (across < limit or across == limit and left_wins):
                return False
            rank_a, rank_b = self.rank[a], self.rank[b]
            if rank_a < 0 and rank_b < 0:
                return True
            if rank_a > rank_b:
                # merges inside a lie to the left of the border
                limit, left_wins, a = rank_a, False, self.halves[a][1]
            else:
                limit, left_wins, b = rank_b, True, self.halves[b][0]

    def encode_piece(self, piece: bytes) -> list[int]:
        """Token ids of one piece of text."""
        longest: list[int | None] = [None] * (len(piece) + 1)
        for end, (i, n) in self.automaton.iter(piece.decode("latin-1")):
            longest[end - n + 1] = i
        if longest[0] is not None and self.length[longest[0]] == len(piece):
            return [longest[0]]
        pairs, length, shorter = self.pairs, self.length, self.shorter
        given_up: set[int] = set()
        tokens: list[int] = []
        at, last, token = 0, -1, longest[0]
        while token is not None:
            to = at + length[token]
            if to not in given_up:
                pair = (last, token)
                fits = pairs.get(pair)
                if fits is None:
                    if len(pairs) >= MEMO_PAIRS:
                        pairs.clear()
                    fits = pairs[pair] = last < 0 or self._fits(last, token)
                if fits:
                    tokens.append(token)
                    at, last, token = to, token, longest[to]
                    continue
            token = shorter[token]
            while token is None:
                # no token fits here: give up the one before and go on with a shorter one
                given_up.add(at)
                gone = tokens.pop()
                at -= length[gone]
                last = tokens[-1] if tokens else -1
                token = shorter[gone]
        return tokens

    def forget(self) -> None:
        """Drop what is remembered of texts: a Python worker outlives its stage, and later ones need the room."""
        self.memo.clear()
        self.memo.older = {}
        self.pairs.clear()

    def pieces(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.all_pieces(text)
        return self.latin_pieces(text)

    def encode(self, text: str) -> tuple[np.ndarray, str]:
        """Token ids of a text, as an array and as decimal numbers joined by commas."""
        memo = self.memo
        if self.special_parts is not None and any(s in text for s in self.special):
            found = []
            for part in self.special_parts.split(text):
                if part in self.special:
                    i = self.special[part]
                    found.append((np.array([i], np.int32).tobytes(), str(i)))
                else:
                    found += [memo[p] for p in self.pieces(part)]
        else:
            found = [memo[p] for p in self.pieces(text)]
        return np.frombuffer(b"".join([f[0] for f in found]), np.int32), ",".join([f[1] for f in found])

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens, gathered from the blob; in stretches, so that memory stays bounded."""
        parts = []
        for at in range(0, len(ids), 1 << 20):
            some = ids[at : at + (1 << 20)]
            start = self.offsets[some]
            length = self.offsets[some + 1] - start
            total = np.cumsum(length)
            place = np.repeat(start - total + length, length) + np.arange(total[-1] if len(total) else 0)
            parts.append(self.blob[place].tobytes())
        return b"".join(parts)


@lru_cache(maxsize=2)
def coder(path: str) -> Coder:
    """The coder of a vocabulary file, built once per Python worker."""
    return Coder(path)


KINDS = {
    "n_tokens": pa.int64(),
    "ids": pa.list_(pa.int32()),
    "ids_sha256": pa.string(),
    "decoded": pa.string(),
    "decoded_sha256": pa.string(),
}
SQL_KINDS = {"ids": "array<int>", "n_tokens": "bigint"}


def encode_decode(
    docs: DataFrame, path: str, keep: list[str], outputs: list[str], text: str = "text"
) -> DataFrame:
    """Encode every text, decode its ids, and return the ``keep`` columns with the asked outputs.

    Outputs: ``n_tokens``, ``ids``, ``ids_sha256`` (of the decimal ids joined by commas), ``decoded``
    and ``decoded_sha256`` (of the decoded bytes). ``path`` is the vocabulary file, which must be
    there on every executor. No shuffle.
    """
    wanted = list(outputs)
    # kept columns travel under numbers, so their names cannot clash with ours
    moved = docs.select(F.col(text).alias("text"), *[F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)])
    schema = ", ".join(
        [f"keep_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)]
        + [f"out_{c} {SQL_KINDS.get(c, 'string')}" for c in wanted]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = coder(path)
        for batch in batches:
            for part in slices(batch):
                rows: dict[str, list] = {c: [] for c in wanted}
                for value in part.column("text").to_pylist():
                    ids, written = use.encode(value or "")
                    made = {"n_tokens": len(ids)}
                    if "ids" in rows:
                        made["ids"] = ids
                    if "ids_sha256" in rows:
                        made["ids_sha256"] = hashlib.sha256(written.encode()).hexdigest()
                    if "decoded" in rows or "decoded_sha256" in rows:
                        decoded = use.decode(ids)
                        made["decoded"] = decoded.decode("utf-8", "replace")
                        made["decoded_sha256"] = hashlib.sha256(made["decoded"].encode()).hexdigest()
                    for c in wanted:
                        rows[c].append(made[c])
                kept = [part.column(f"keep_{i}") for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(
                    kept + [pa.array(rows[c], KINDS[c]) for c in wanted],
                    [f"keep_{i}" for i in range(len(keep))] + [f"out_{c}" for c in wanted],
                )
        use.forget()

    made = moved.mapInArrow(run, schema)
    return made.select(
        *[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)], *[F.col(f"out_{c}").alias(c) for c in wanted]
    )
