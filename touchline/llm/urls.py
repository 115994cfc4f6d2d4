"""URL filters: rules first, and for the rest a ratio of two character language models.

One model is of accepted URLs, the other of rejected ones: smoothed Markov models of variable order.
The chance of a character after a context is interpolated from the longest context down to none, so
unseen contexts fall back to shorter ones. A URL's score is the difference of both models' logarithms
per character, and it is blocked below a threshold that is calibrated on rule-judged URLs which the
models have not seen.

Counts are exact, taken over all rule-judged URLs, and stay in a Spark table that grows with them: a row per
distinct character with its longest context, from which those of the shorter ones follow. Of the URLs to be judged
the distinct ones of such pairs are joined with it, so neither the driver nor a task holds a model.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to
``?``, ``#`` or the end. A NULL URL or one without ``://`` has an empty host and path; it fits no
rule and is judged by the models like any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.text import free_name, slices, text_bytes
from touchline.session import written

ALLOW, BLOCK = "allow", "block"
# The rules of the list, host and path.
RULES = (
    ("net/", BLOCK),
    ("example.net/en/", ALLOW),
    ("example.com/de/", BLOCK),
    ("org/fr/", ALLOW),
)

ORDER = 5
WEIGHT = 1.5  # of the shorter context's chance, in characters
CALIBRATION_SHARE = 5  # one of so many rule-judged URLs is kept for the threshold
BIN, BINS = 0.01, 2000


def host(url: Column) -> Column:
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    found = F.regexp_extract(rest, r"^[^/?#]*", 0)
    lower = F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.locate("://", url) > 0, lower).otherwise("")


def path(url: Column) -> Column:
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    return F.when(F.locate("://", url) > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def rule(host_column: Column, path_column: Column, rules=RULES) -> Column:
    """The longest rule that fits, or NULL. A rule fits its host and all subdomains."""
    found = F.lit(None).cast("string")
    for text, _ in sorted(rules, key=lambda r: len(r[0])):
        name, slash, rest = text.partition("/")
        fits = (host_column == name) | F.endswith(host_column, F.lit("." + name))
        found = F.when(fits & F.startswith(path_column, F.lit(slash + rest)), text).otherwise(found)
    return found


# A key holds a character (8 bits), its context before it, the nearest byte lowest (8 each), and the context's length.
LENGTH_AT = 8 * (ORDER + 1)


def _events(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys (order, character) of all pairs and contexts, and the URL that each character is of.

    Each URL is preceded by marks and followed by one, which count as characters that it cannot hold.
    """
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    first = np.concatenate([[0], np.cumsum(sizes + ORDER + 1)])
    padded = np.full(first[-1], 2, np.uint64)
    at = np.arange(len(data)) + np.repeat(first[:-1] + ORDER - offsets[:-1], sizes)
    padded[at] = data
    padded[first[1:] - 1] = 3
    place = np.arange(sizes.sum() + n) + np.repeat(first[:-1] + ORDER - np.concatenate([[0], np.cumsum(sizes + 1)])[:-1], sizes + 1)
    context = np.zeros(len(place), np.int64)
    padded = padded.astype(np.int64)
    pairs, contexts = np.empty((ORDER + 1, len(place)), np.int64), np.empty((ORDER + 1, len(place)), np.int64)
    for k in range(ORDER + 1):
        if k:
            context = context | padded[place - k] << 8 * k
        contexts[k] = context | k << LENGTH_AT
        pairs[k] = contexts[k] | padded[place]
    return pairs, contexts, np.repeat(np.arange(n), sizes + 1)


def train(judged: DataFrame) -> DataFrame:
    """Counts over all rows (``url``, ``verdict``): ``pair`` of the longest context, times ``accepted`` and ``rejected``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "url"):
                pairs, _, of = _events(*text_bytes(part.column("url")))
                side = np.array([v == ALLOW for v in part.column("verdict").to_pylist()], bool)[of]
                pair, number = np.unique(pairs[ORDER], return_inverse=True)
                n = [np.bincount(number[s], minlength=len(pair)) for s in (side, ~side)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pair), *[pa.array(x.astype(np.int64)) for x in n]], ["pair", "accepted", "rejected"]
                )

    counted = judged.select("url", "verdict").mapInArrow(count, "pair bigint, accepted bigint, rejected bigint")
    summed = counted.groupBy("pair").agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))
    return written(summed, "url-counts")


def _cut(pair: Column, order: int) -> Column:
    """The key of the pair with a context of ``order`` bytes."""
    return pair.bitwiseAND(F.lit((1 << 8 * (order + 1)) - 1)).bitwiseOR(F.lit(order << LENGTH_AT))


def _values(asked: DataFrame, models: DataFrame) -> DataFrame:
    """(``pair``, ``value``): logarithm of accepted over rejected for each distinct pair of the longest context.

    From no context to the longest each pair takes the chance of the pair that is a byte shorter; at most 258 pairs
    share such a one, or a context, so no group grows with the data.
    """
    sides = ("accepted", "rejected")
    none = [F.lit(0).cast("bigint").alias(c) for c in sides]
    rows = models.select("pair", *sides, F.lit(False).alias("asked")).unionByName(
        asked.select("pair", *none, F.lit(True).alias("asked"))
    )
    cut = F.array(*[_cut(F.col("pair"), k) for k in range(ORDER + 1)])
    rows = rows.select(F.explode(cut).alias("pair"), *sides, "asked").groupBy("pair")
    rows = rows.agg(*[F.sum(c).alias(c) for c in sides], F.max("asked").alias("asked"))
    context = Window.partitionBy(F.col("pair").bitwiseAND(F.lit(~255)))
    rows = rows.withColumns({f"{c}_total": F.sum(c).over(context) for c in sides}).where("asked")
    rows = written(rows.withColumn("length", F.shiftright("pair", LENGTH_AT)), "url-pairs")
    found = None
    for k in range(ORDER + 1):
        own = rows.where(F.col("length") == k)
        if found is None:
            own = own.withColumns({f"{c}_before": F.lit(1 / 256) for c in sides})
        else:
            before = found.select(F.col("pair").alias("shorter"), *[F.col(f"{c}_chance").alias(f"{c}_before") for c in sides])
            own = own.withColumn("shorter", _cut(F.col("pair"), k - 1)).join(before, "shorter")
        found = own.select(
            "pair",
            *[
                ((F.col(c) + WEIGHT * F.col(f"{c}_before")) / (F.col(f"{c}_total") + WEIGHT)).alias(f"{c}_chance")
                for c in sides
            ],
        )
    return found.select("pair", (F.log("accepted_chance") - F.log("rejected_chance")).alias("value"))


def _url_name(url: str = "url") -> Column:
    return F.md5(F.coalesce(F.col(url), F.lit("")).cast("binary"))


def ratios(urls: DataFrame, models: DataFrame, name: str = "ratio") -> DataFrame:
    """(``url_name``, ratio) of each distinct URL: the length-normalised log ratio."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "url", 1 << 18):
                pairs, _, of = _events(*text_bytes(part.column("url")))
                yield pa.RecordBatch.from_arrays(
                    [part.column("url_name").take(pa.array(of)), pa.array(pairs[ORDER])], ["url_name", "pair"]
                )

    distinct = urls.select(_url_name().alias("url_name"), "url").groupBy("url_name").agg(F.first("url").alias("url"))
    held = written(distinct.mapInArrow(run, "url_name string, pair bigint"), "url-held")
    valued = held.join(_values(held.select("pair").distinct(), models), "pair")
    # rounded, so that the order of the sum does not show
    return written(valued.groupBy("url_name").agg(F.round(F.avg("value"), 9).alias(name)), "url-ratios")


def with_ratios(urls: DataFrame, known: DataFrame) -> DataFrame:
    """The input, which has a column ``url``, with the ratio of its URL."""
    own = free_name("url_name", urls.columns)
    return urls.join(known.withColumnRenamed("url_name", own), _url_name() == F.col(own), "left").drop(own)


def score(urls: DataFrame, models: DataFrame, name: str = "ratio") -> DataFrame:
    """The input, which has a column ``url``, with the length-normalised log ratio."""
    return with_ratios(urls, ratios(urls, models, name))


def _scores(models: DataFrame, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Ratios of a few URLs that are given as bytes."""
    rows = [(i, data[a:b].tobytes().decode()) for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:]))]
    urls = models.sparkSession.createDataFrame(rows, "number int, url string")
    return np.array([r["ratio"] for r in score(urls, models).orderBy("number").collect()])


def calibrate(scored: DataFrame) -> float:
    """The threshold with the best mean of both classes' recalls, from counts per score bin."""
    bin_of = F.least(F.greatest(F.floor(F.col("ratio") / BIN), F.lit(-BINS)), F.lit(BINS - 1)).cast("int")
    counts = np.zeros((2, 2 * BINS))
    for row in scored.groupBy(bin_of.alias("bin"), (F.col("verdict") == ALLOW).alias("accepted")).count().collect():
        counts[int(row["accepted"]), row["bin"] + BINS] = row["count"]
    total = counts.sum(axis=1)
    if not total.all():
        return 0.0
    kept = 1 - np.concatenate([[0], np.cumsum(counts[1])]) / total[1]
    dropped = np.concatenate([[0], np.cumsum(counts[0])]) / total[0]
    best = np.flatnonzero(kept + dropped >= (kept + dropped).max() - 1e-12)
    return float((best.mean() - BINS) * BIN)


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """The input with ``host``, ``path``, ``rule``, ``ratio`` and ``verdict``; these names replace own columns.

    A rule's verdict counts first. The other URLs are allowed from the calibrated ratio on; without
    rule-judged URLs of both kinds they are all allowed.
    """
    parsed = pages.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    parsed = parsed.withColumn("rule", rule(F.col("host"), F.col("path"), rules))
    by_rule = F.lit(None).cast("string")
    for text, verdict in rules:
        by_rule = F.when(F.col("rule") == text, verdict).otherwise(by_rule)
    judged = parsed.select("url", by_rule.alias("verdict")).where("verdict IS NOT NULL")
    kept_back = F.pmod(F.xxhash64("url"), F.lit(CALIBRATION_SHARE)) == 0
    models = train(judged.where(~kept_back))
    known = ratios(parsed, models)
    threshold = calibrate(with_ratios(judged.where(kept_back), known))
    total = models.agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected")).first()
    both = total["accepted"] and total["rejected"]
    scored = with_ratios(parsed.drop("ratio"), known)
    by_model = F.when(F.lit(bool(both)) & (F.col("ratio") < threshold), BLOCK).otherwise(ALLOW)
    return scored.withColumn("verdict", F.coalesce(by_rule, by_model))
