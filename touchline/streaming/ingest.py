"""Incremental intake: each new list file once, rows saved as they come."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from touchline.operators.status import log_rows
from touchline.plans.collect import collect_matches, match_table
from touchline.session import written
from touchline.sources.lists import any_case, clean_lines, stem_of


def stream_lists(spark: SparkSession, folder: str, archive: str | None = None, files_per_batch: int = 1000) -> DataFrame:
    """A stream of the URLs in new list files.

    The checkpoint of the started query decides what is new. With ``archive``, finished files are
    moved there; a batch's files move when a later batch runs.
    """
    reader = (
        spark.readStream.format("text")
        .option("pathGlobFilter", any_case("*.txt"))
        .option("maxFilesPerTrigger", files_per_batch)
    )
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    lines = reader.load(folder).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file_name"))
    return clean_lines(lines).withColumn("stem", stem_of(F.col("path"))).drop("path")


def stream_table(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    file_format: str = "parquet",
    files_per_batch: int = 1000,
    **options: str,
) -> DataFrame:
    """A stream of the rows in new files of a folder, under a fixed schema."""
    return (
        spark.readStream.schema(schema)
        .format(file_format)
        .options(**options)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
    )


def append_stream(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what is there now to a table, then stop. Later runs with the same checkpoint go on from here."""
    return (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def per_batch(
    rows: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, output_mode: str = "append"
) -> StreamingQuery:
    """Run ``step`` on each micro-batch of what is there now, then stop."""
    return (
        rows.writeStream.foreachBatch(step)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Write one batch into its own folder; a repeated batch replaces its own rows only."""
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def without_page(listed: DataFrame, saved: str) -> DataFrame:
    """The listed URLs that the table at the path ``saved`` does not have.

    Spark takes one column of a wide table for a small part of its size. Here most of the others are NULL, so the URLs are
    nearly all of it, and by that estimate any number of them would be broadcast through the driver.
    """
    urls = listed.sparkSession.read.schema("url string").parquet(saved)
    return listed.join(urls.hint("merge"), "url", "left_anti")


def collect_stream(
    urls: DataFrame, pages: DataFrame, domain: str, matches: str, logs: str, checkpoint: str
) -> StreamingQuery:
    """Extract the matches of newly listed URLs from the page table into a match and a log table.

    A URL whose summary page is not there yet waits in the table ``{matches}_pending``; each batch
    takes in what the batch before it left waiting, so a page may come after its list.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark, waiting = batch.sparkSession, f"{matches}_pending"
        listed = batch.select("url")
        if batch_id:
            listed = listed.unionByName(spark.read.schema("url string").parquet(f"{waiting}/batch={batch_id - 1}"))
        listed = written(listed.distinct(), "listed")
        here = pages.join(listed, "url", "left_semi")
        write_batch(collect_matches(here, domain), f"{matches}_text", batch_id)
        folder = f"{matches}_text/batch={batch_id}"
        saved = spark.read.parquet(folder)
        write_batch(without_page(listed, folder), waiting, batch_id)
        write_batch(match_table(saved), matches, batch_id)
        write_batch(log_rows(saved), logs, batch_id)

    return per_batch(urls, step, checkpoint)
