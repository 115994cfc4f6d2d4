"""Log analytics: counts, success, running totals, new files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.operators.keys import join_on, running_total, totals_before


def new_files(after: DataFrame, before: DataFrame, key: str) -> DataFrame:
    """Keys of ``after`` that ``before`` lacks, sorted."""
    return after.select(key).distinct().join(before.select(key).distinct(), key, "left_anti").orderBy(key)


def counts_with_total(rows: DataFrame, key: str, name: str = "n_urls", total: str = "TOTAL") -> DataFrame:
    """Row count per key, and one row with the grand total."""
    return (
        rows.rollup(key)
        .agg(F.count(F.lit(1)).alias(name), F.grouping(key).alias("_is_total"))
        .select(F.when(F.col("_is_total") == 1, F.lit(total)).otherwise(F.col(key)).alias(key), name)
    )


def success_counts(rows: DataFrame, key: str, has_data: Column, success: Column) -> DataFrame:
    """Rows per file, rows with any data, and rows logged as success."""
    return rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(has_data).alias("n_with_data"),
        F.count_if(success).alias("n_success"),
    )


def elapsed_per_file(
    rows: DataFrame, file: str, order: Sequence[Column], seconds: Column, band: Column, name: str
) -> DataFrame:
    """Running elapsed time of each file."""
    return running_total(rows, [file], order, seconds, name, band)


def elapsed_overall(
    rows: DataFrame,
    file: str,
    order: Sequence[Column],
    seconds: Column,
    band: Column,
    name: str,
    pauses: DataFrame | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Running elapsed time carried from file to file in sorted file order.

    ``pauses`` (the file and ``pause``) adds the pause after each file. File totals are summed over
    ranges of files; the start of each file then joins the band sums of that file, not its rows.
    """
    totals = rows.groupBy(file).agg(F.sum(seconds).cast("decimal(38,6)").alias("_total"))
    if pauses is not None:
        pause = F.coalesce(F.col("pause").cast("decimal(38,6)"), F.lit(0))
        totals = join_on(totals, pauses, [file], "left").select(
            file, (F.col("_total") + pause).cast("decimal(38,6)").alias("_total")
        )
    starts = totals_before(totals, file, "_total", "offset", parts)
    return running_total(rows, [file], order, seconds, name, band, offsets=starts)
