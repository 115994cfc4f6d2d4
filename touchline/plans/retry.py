"""Retry: logs and a new extraction give a patched match table and retry log rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline import fixed_values as fv
from touchline import schemas
from touchline.functions.names import log_stem
from touchline.functions.text import strip
from touchline.functions.urls import match_id
from touchline.operators.retry import (
    candidates,
    patch_decision,
    patch_rows,
    patches_to_apply,
    retry_log,
    with_data_flag,
)

KEYS = ("stem", "match_id")
NO_PAGE = "no page"
MATCH_COLUMNS = [f.name for f in schemas.MATCH.fields]


def line_order(logs: DataFrame) -> list[str]:
    """The columns that log rows go by."""
    return ["line_no"] if "line_no" in logs.columns else ["scraped_at", "url", "reason", "non_empty_fields"]


def retried(logs: DataFrame, collected: DataFrame, threshold: int = fv.RETRY_THRESHOLD) -> DataFrame:
    """Retry candidates joined to their new extraction.

    ``logs`` is the log text with ``file_name`` and optionally ``line_no``; without line numbers rows
    go by (scraped_at, url). See ``with_extraction`` for ``collected``.
    """
    order = [F.col(c) for c in line_order(logs)]
    named = logs.withColumn("url", strip(F.col("url")))
    old = candidates(named, order, ["file_name", "url"], threshold).select(
        "url",
        "retry_trigger",
        F.col("non_empty_fields").alias("fields_before"),
        log_stem(F.col("file_name")).alias("stem"),
    )
    return with_extraction(old, collected)


def with_extraction(old: DataFrame, collected: DataFrame) -> DataFrame:
    """Candidates (``url``, ``retry_trigger``, ``fields_before``, ``stem``) joined to their new extraction.

    ``collected`` is what ``collect_matches`` gives, with ``scraped_at`` and ``error`` of the new run if
    known. A candidate without a page in the new run has the error ``no page``.
    """
    new = collected.withColumn("fields_after", F.col("non_empty_fields")).drop("non_empty_fields", "match_id")
    known = F.col("error") if "error" in new.columns else F.lit(None).cast("string")
    new = new.withColumn("error", known).withColumn("_found", F.lit(True))
    return (
        old.join(new, "url", "left")
        .withColumn("error", F.when(F.col("_found").isNull(), NO_PAGE).otherwise(F.col("error")))
        .drop("_found")
        .withColumn("match_id", match_id(F.col("url")))
        .withColumn("has_data", ~F.col("status").isin("false", "404", "403"))
        .withColumn("file_name", F.concat(F.col("stem"), F.lit(fv.DATA_SUFFIX)))
    )


def patched_table(
    base: DataFrame, tried: DataFrame, line: str, keep: str = "last", merge: str = "replace"
) -> DataFrame:
    """The match table (text columns, with ``stem`` and a line column) after all patches that qualify.

    A log's patches reach the data file of its own stem only.
    """
    return patch_rows(base, winning_patches(qualifying(tried), keep), KEYS, line, MATCH_COLUMNS, merge)


def qualifying(tried: DataFrame) -> DataFrame:
    """Those of the retried rows that are patches."""
    failed = F.col("error").isNotNull() if "error" in tried.columns else F.lit(False)
    return tried.where(~failed).where(
        patch_decision(F.col("has_data"), F.col("fields_before"), F.col("fields_after"), F.col("match_id"))
    )


def winning_patches(patches: DataFrame, keep: str = "last") -> DataFrame:
    """One patch for each (stem, match id)."""
    order = [F.col("scraped_at"), F.col("url")] if "scraped_at" in patches.columns else [F.col("url")]
    return patches_to_apply(patches, KEYS, order, keep)


def write_back(
    spark: SparkSession, path: str, schema: T.StructType, patches: DataFrame, line: str, columns: Sequence[str], merge: str = "replace",
) -> list[str]:
    """Patch a Parquet table that is partitioned by ``stem`` in place, and give the stems that were written anew.

    ``patches`` has one row for each (stem, match id). Only partitions that hold a patched id are read
    whole and written; the files of all others are not touched. The new files are written beside the
    table and take the old ones' place when the last of them is there, so a job that is lost halfway
    leaves the table as it was. A stem's rows are ranged by ``line``: one with very many rows is several files, not one
    task. The driver learns names of stems, which its listing of the table's partitions holds already.
    """
    named = [r[0] for r in patches.select("stem").where("stem IS NOT NULL").distinct().collect()]
    table = spark.read.schema(schema).parquet(path).where(F.col("stem").isin(named))
    hit = table.select(*KEYS).join(patches.select(*KEYS).distinct(), list(KEYS), "left_semi").select("stem").distinct()
    stems = sorted(r[0] for r in hit.collect())
    if stems:
        rows = patch_rows(table.where(F.col("stem").isin(stems)), patches, KEYS, line, columns, merge, "_patched").drop("_patched")
        ranged = rows.repartitionByRange("stem", line).sortWithinPartitions("stem", line)
        ranged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("stem").parquet(path)
    return stems


def retry_log_rows(base: DataFrame, tried: DataFrame, data_stems: DataFrame) -> DataFrame:
    """Retry log rows; ``data_stems`` are the stems of the data files that are there, ``base`` their rows."""
    return retry_log(with_data_flag(tried, data_stems), base, KEYS)
