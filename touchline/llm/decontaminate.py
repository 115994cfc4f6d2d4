"""Benchmark decontamination: documents that hold word windows of benchmark items. DataFrame functions only.

Words are longest runs of digits, ASCII letters (lower-cased) and characters outside ASCII. A window
is 13 consecutive words of an item; an item with fewer words, but not none, is one window. A
document word inside any occurrence of a window is hit.

The search has two steps. An anchor is a run of a few words; windows and documents are compared by
anchors that documents give at every ``stride``-th word only, chosen so that each occurrence of a
window holds one of them whole. Only documents that share an anchor with the benchmark are read
again, and there every window is compared as text, so the result is exact.

Results hang on a document's text alone; rows with equal id and text share one key. NULL texts have
no words, NULL item texts no windows, and an item without an id counts as the item with the empty
id. Other columns are not looked at.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.text import free_name
from touchline.operators.elements import let
from touchline.session import written

WINDOW = 13
# Up to so many windows the benchmark is broadcast (its size is counted first); beyond, the joins shuffle.
BROADCAST_WINDOWS = 500_000

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x7F]+"
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """The words of a text, as an array."""
    lower = F.translate(F.coalesce(text, F.lit("")), ASCII_UPPER, ASCII_LOWER)
    return F.array_remove(F.split(lower, SEPARATORS), "")


def folded_words(text: Column) -> Column:
    """As many words, with all letters in upper case: equal wherever ``words`` are equal, and faster to get."""
    return F.array_remove(F.split(F.upper(F.coalesce(text, F.lit(""))), UPPER_SEPARATORS), "")


def runs(w: Column, size: int, stride: int, value) -> Column:
    """``value(first, words)`` of the runs of ``size`` words at every ``stride``-th word of an array."""
    last = F.size(w) - size + 1
    made = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1)), F.lit(stride)), lambda i: value(i, F.slice(w, i, size)))
    return F.when(last >= 1, made).otherwise(F.slice(made, 1, 0))


def anchor_shape(length: int) -> tuple[int, int]:
    """Words in an anchor, and the stride at which any window of this length holds a whole one."""
    size = ceil(length / 2) - (length == WINDOW)
    return size, length - size + 1


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def keyed(docs: DataFrame) -> DataFrame:
    """Key columns, id and text, under names of their own."""
    return docs.select(
        F.col("doc_id").alias("id"),
        F.coalesce("doc_id", F.lit(-1)).alias("key_id"), text_key(F.col("text")).alias("key_text"), F.col("text").alias("body")
    )


KEYS = ["key_id", "key_text"]


class Search:
    """One search of all documents for a benchmark.

    ``seen`` has a row per document with its id, keys and ``n_words``; ``hits`` a row per place
    (``at``, from 1), length and window that occurs in a document with these keys.
    """

    def __init__(self, docs: DataFrame, benchmark: DataFrame):
        texts = keyed(docs)
        items = benchmark.select(
            F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
            words(F.col("text")).alias("w"),
            folded_words(F.col("text")).alias("folded"),
        ).where(F.size("w") > 0)
        windows = items.select("item", F.explode(self._windows(F.col("w"))).alias("window"))
        self.windows = written(windows.select("item", F.col("window.run").alias("run")).distinct(), "windows")
        sizes = items.groupBy(F.least(F.size("w"), F.lit(WINDOW)).alias("n")).agg(F.sum(F.size("w")).alias("total")).collect()
        self.lengths = sorted(r["n"] for r in sizes)  # at most 13 of them
        small = sum(r["total"] for r in sizes) <= BROADCAST_WINDOWS
        self.hint = F.broadcast if small else (lambda df: df)

        anchors = reduce(
            DataFrame.unionByName,
            [
                items.where(F.least(F.size("w"), F.lit(WINDOW)) == n).select(
                    F.explode(runs(F.col("folded"), anchor_shape(n)[0], 1, self._anchor(n))).alias("anchor")
                )
                for n in self.lengths
            ]
            or [items.select(F.lit(0).cast("bigint").alias("anchor")).limit(0)],
        ).distinct()
        self.seen = written(
            texts.select(
                "id",
                *KEYS,
                let(
                    folded_words(F.col("body")),
                    lambda w: F.struct(F.size(w).cast("bigint").alias("n_words"), self._anchors(w).alias("anchors")),
                ).alias("found"),
            ).select("id", *KEYS, "found.*"),
            "anchors",
        )
        shared = self.seen.select(*KEYS, F.explode("anchors").alias("anchor")).join(self.hint(anchors), "anchor", "left_semi")
        again = texts.join(shared.select(*KEYS).distinct(), KEYS, "left_semi")
        places = again.select(
            *KEYS, F.explode(let(words(F.col("body")), lambda w: self._windows(w, self.lengths))).alias("window")
        ).select(*KEYS, "window.*")
        known = self.windows.select("run").distinct()
        self.hits = written(places.join(self.hint(known), "run", "left_semi"), "hits")

    @staticmethod
    def _anchor(length: int):
        size = anchor_shape(length)[0]
        return lambda i, run: F.xxhash64(run, F.lit(size))

    def _anchors(self, w: Column) -> Column:
        """Keys of a document's anchors for all window lengths of the benchmark."""
        each = [runs(w, *anchor_shape(n), self._anchor(n)) for n in self.lengths]
        return F.concat(*each) if each else F.array().cast("array<bigint>")

    @staticmethod
    def _windows(w: Column, lengths: list[int] | None = None) -> Column:
        """All windows as structs (at, length, run); an item's own windows if no lengths are given."""
        kind = "array<struct<at:int,length:int,run:string>>"

        def window(n: int | Column):
            return lambda i, run: F.struct(
                i.alias("at"), F.lit(n).cast("int").alias("length"), F.array_join(run, " ").alias("run")
            )

        if lengths is None:
            whole = F.array(window(F.size(w))(F.lit(1), w)).cast(kind)
            return F.when(F.size(w) >= WINDOW, runs(w, WINDOW, 1, window(WINDOW)).cast(kind)).otherwise(whole)
        each = [runs(w, n, 1, window(n)).cast(kind) for n in lengths]
        return F.concat(*each) if each else F.array().cast(kind)

    def hit_words(self) -> DataFrame:
        """``n_hit`` per key: words inside any occurrence, each counted once."""
        before = Window.partitionBy(*KEYS).orderBy("at", "length").rowsBetween(Window.unboundedPreceding, -1)
        end = F.col("at") + F.col("length")
        fresh = F.greatest(end - F.greatest(F.col("at"), F.coalesce(F.max(end).over(before), F.lit(1))), F.lit(0))
        return self.hits.withColumn("fresh", fresh).groupBy(*KEYS).agg(F.sum("fresh").alias("n_hit"))

    def hit_items(self) -> DataFrame:
        """The sorted ids (as strings) of the items with occurring windows, per key."""
        pairs = self.hits.select(*KEYS, "run").distinct().join(self.hint(self.windows), "run").select(*KEYS, "item").distinct()
        return pairs.groupBy(*KEYS).agg(F.sort_array(F.collect_list("item")).alias("items"))

    def report(self) -> DataFrame:
        """A row per document: ``id``, keys, ``n_words``, ``n_hit``, ``items`` and ``contaminated`` (a twentieth of its words hit)."""
        found = self.hit_words().join(self.hit_items(), KEYS)
        n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
        return (
            self.seen.drop("anchors")
            .join(found, KEYS, "left")
            .withColumn("n_hit", n_hit)
            .withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
        )


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """What the benchmark shares with each document; see ``Search.report``. ``id`` is the doc_id."""
    return Search(docs, benchmark).report()


def _renamed(found: DataFrame, docs: DataFrame) -> tuple[DataFrame, Column]:
    """The keyed rows under names that the documents do not have, and the condition that joins both."""
    names = {c: free_name(c, docs.columns) for c in found.columns}
    same = (F.coalesce("doc_id", F.lit(-1)) == F.col(names["key_id"])) & (text_key(F.col("text")) == F.col(names["key_text"]))
    return found.withColumnsRenamed(names), same


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    bad, same = _renamed(report(docs, benchmark).where("contaminated").select(*KEYS).distinct(), docs)
    return docs.join(bad, same, "left_anti")


def without_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All documents, with every hit word and the separators after it cut out of the text."""
    found = Search(docs, benchmark).hits.groupBy(*KEYS).agg(F.collect_set(F.struct("at", "length")).alias("hit_spans"))
    spans, same = _renamed(found, docs)
    own = F.col(spans.columns[-1])
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    pieces = F.regexp_extract_all("text", F.lit(word + r"[\x00-\x2F\x3A-\x60\x7B-\x7F]*"), F.lit(0))
    lead = F.regexp_extract("text", r"^[\x00-\x2F\x3A-\x60\x7B-\x7F]*", 0)
    hit = lambda i: F.exists(own, lambda s: (i + 1 >= s["at"]) & (i + 1 < s["at"] + s["length"]))
    cut = F.concat(lead, F.array_join(F.filter(pieces, lambda piece, i: ~hit(i)), ""))
    joined = docs.join(spans, same, "left")
    return joined.withColumn("text", F.when(own.isNull(), F.col("text")).otherwise(cut)).select(*docs.columns)
