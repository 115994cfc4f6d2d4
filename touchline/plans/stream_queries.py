"""Queries that run a stream over files made from the given tables and give the resulting table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.plans import log_queries
from touchline.plans import retry as retry_plan
from touchline.plans.registry import query, table
from touchline.session import new_folder
from touchline.streaming import ingest, patch, retry, waiting


@query(
    "stream_ingest",
    """
    SELECT 'https://us.example.com/game/' || user_id || '/' || event_type || '/?mid=' || event_id AS url FROM events
    """,
)
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists arrive in two lots; each run takes in only the new files."""
    events = table(spark, sf_dir, "events")
    url = F.concat(
        F.lit("https://us.example.com/game/"), F.col("user_id").cast("string"), F.lit("/"), "event_type",
        F.lit("/?mid="), F.col("event_id").cast("string"),
    )
    lists, out, checkpoint, archive = (new_folder(spark, n) for n in ("incoming", "urls", "state", "archive"))
    is_error = F.col("event_type") == "error"
    for lot in (is_error, ~is_error):
        events.where(lot).select(url.alias("value")).write.mode("append").text(lists)
        stream = ingest.stream_lists(spark, lists, archive=archive, files_per_batch=4).select("url")
        ingest.append_stream(stream, out, checkpoint).awaitTermination()
    return spark.read.schema("url string").parquet(out)


@query("stream_patch", log_queries.PATCHED_SQL)
def stream_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patch candidates arrive in several micro-batches; the view over all equals one batch job."""
    arriving, patches, checkpoint = (new_folder(spark, n) for n in ("arriving", "patches", "state"))
    candidates = log_queries.patch_candidates(spark, sf_dir)
    candidates.repartition(3).write.parquet(arriving)
    stream = ingest.stream_table(spark, arriving, candidates.schema, files_per_batch=1)
    patch.patch_stream(stream, log_queries.qualifying, patches, checkpoint).awaitTermination()
    return patch.patched_view(
        spark,
        log_queries.base_rows(spark, sf_dir),
        patches,
        candidates.schema,
        ["match_id"],
        "line_no",
        log_queries.PATCH_COLUMNS,
        [F.col("patch_no")],
    )


LOTS = 3


def streamed_retry(spark: SparkSession, sf_dir: str, fetched: Column) -> tuple[str, DataFrame, str]:
    """Log rows arrive in lots: the folder of patches, the base rows and the folder of retry log rows.

    A URL may ask for a retry in each lot; the first row of all counts, as in the batch job.
    """
    log, collected, base = log_queries.retry_tables(spark, sf_dir, fetched)
    arriving, patches, retry_log, checkpoint = (new_folder(spark, n) for n in ("arriving", "patches", "retry-log", "state"))
    last = log.agg(F.max("line_no")).first()[0] or 0
    lot = F.floor(F.col("line_no") * LOTS / (last + 1))
    stems = spark.createDataFrame([("a",)], "stem string")
    for number in range(LOTS):
        log.where(lot == number).write.mode("append").parquet(arriving)
        rows = ingest.stream_table(spark, arriving, log.schema)
        retry.retry_stream(rows, collected, base, stems, patches, retry_log, checkpoint).awaitTermination()
    return patches, base, retry_log


@query("stream_retry", log_queries.RETRY_JOB_SQL)
def stream_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The match table under the patches of log rows that arrive in several lots; equal to the batch job."""
    patches, base, _ = streamed_retry(spark, sf_dir, F.lit(True))
    saved = spark.read.parquet(patches)
    rows = patch.patched_view(
        spark, base, patches, saved.schema, retry_plan.KEYS, "line_no", retry_plan.MATCH_COLUMNS, [F.col("scraped_at"), F.col("url")]
    )
    return rows.select("line_no", "stem", "match_id", "stadium", "patched")


@query("stream_retry_log", log_queries.RETRY_JOB_LOG_SQL)
def stream_retry_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The retry log of the same stream where some candidates have no page."""
    _, _, retry_log = streamed_retry(spark, sf_dir, F.col("c_custkey") % 3 != 0)
    return log_queries.retry_log_digest(spark.read.parquet(retry_log))


@query(
    "stream_collect",
    """
    SELECT 'https://us.example.com/game/a/b' || o_orderkey || '/?mid=M' || o_orderkey AS url,
           CASE o_orderkey % 3 WHEN 0 THEN '404' WHEN 1 THEN '403' ELSE 'no_data' END AS reason, false AS success
    FROM orders WHERE o_orderkey % 5 <> 0
    """,
)
def stream_collect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log rows of listed URLs. Half of the pages of the first list come after it; some pages never come."""
    number = F.col("o_orderkey")
    text = number.cast("string")
    url = F.concat(F.lit("https://us.example.com/game/a/b"), text, F.lit("/?mid=M"), text)
    title = F.when(number % 3 == 0, "404").otherwise("A match")
    body = F.when(number % 3 == 1, "Forbidden").otherwise("Nothing")
    html = F.concat(F.lit("<html><title>"), title, F.lit("</title><p>"), body, F.lit("</p></html>"))
    orders = table(spark, sf_dir, "orders").select(number, url.alias("url"), html.alias("html"))
    pages = orders.where(number % 5 != 0).select(number, "url", F.lit("summary").alias("tab"), "html")
    listed, fetched, matches, log, checkpoint = (new_folder(spark, n) for n in ("listed", "pages", "matches", "log", "state"))
    lots = [(number % 2 == 0, number % 4 == 0), (number % 2 == 1, number % 4 != 0)]
    for lot, arrived in lots:
        orders.where(lot).select(F.col("url").alias("value")).write.mode("append").text(listed)
        pages.where(arrived).drop("o_orderkey").write.mode("append").parquet(fetched)
        there = spark.read.parquet(fetched)
        stream = ingest.stream_lists(spark, listed)
        ingest.collect_stream(stream, there, "example.com", matches, log, checkpoint).awaitTermination()
    return spark.read.parquet(log).select("url", "reason", "success")


@query(
    "stream_waiting",
    """
    SELECT 'https://us.example.com/game/a/b' || o_orderkey || '/?mid=M' || o_orderkey AS url,
           CASE WHEN o_orderkey % 5 = 0 THEN 'no page' WHEN o_orderkey % 3 = 0 THEN '404' WHEN o_orderkey % 3 = 1 THEN '403'
                ELSE 'no_data' END AS reason, false AS success, o_orderkey % 5 = 0 AS late
    FROM orders WHERE o_orderkey % 7 <> 0
    """,
)
def stream_waiting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log rows of listed URLs, kept as state until their pages come; the last pages come without a list, some never.

    Pages that no list names stay out. The pages lie in URL buckets, of which a batch reads those it needs.
    """
    number = F.col("o_orderkey")
    text = number.cast("string")
    url = F.concat(F.lit("https://us.example.com/game/a/b"), text, F.lit("/?mid=M"), text)
    title = F.when(number % 3 == 0, "404").otherwise("A match")
    body = F.when(number % 3 == 1, "Forbidden").otherwise("Nothing")
    html = F.concat(F.lit("<html><title>"), title, F.lit("</title><p>"), body, F.lit("</p></html>"))
    orders = table(spark, sf_dir, "orders").select(number, url.alias("url"), F.lit("summary").alias("tab"), html.alias("html"))
    lists, fetched, matches, log, checkpoint = (new_folder(spark, n) for n in ("listed", "pages", "matches", "log", "state"))
    schema = "url string, html string, bucket int, tab string"
    nobody, comes = F.lit(False), number % 5 != 0
    hour_ms = 3_600_000
    lots = [
        # listed, arriving, patience: a list with a third of its pages, and pages that are not listed yet
        (comes & (number % 2 == 0), comes & (number % 3 == 0), hour_ms),
        (comes & (number % 2 == 1), nobody, hour_ms),
        (nobody, comes & (number % 3 != 0), hour_ms),  # pages alone
        (~comes, nobody, 1),  # listed for a millisecond, without pages
        (comes & (number % 2 == 0), nobody, hour_ms),  # listed again, which changes nothing but the time
    ]
    for listing, arriving, patience_ms in lots:
        listed = orders.where(listing & (number % 7 != 0)).select(F.col("url").alias("value"))
        listed.write.mode("append").text(lists)
        waiting.write_pages(orders.where(arriving).drop("o_orderkey"), fetched, PAGE_BUCKETS)
        there = spark.read.schema(schema).parquet(fetched)
        arrived = ingest.stream_table(spark, fetched, there.schema).where("tab = 'summary'").select("url")
        waiting.collect_waiting(
            ingest.stream_lists(spark, lists), arrived, there, "example.com", matches, log, checkpoint, patience_ms, PAGE_BUCKETS
        ).awaitTermination()
    return spark.read.parquet(log).select("url", "reason", "success", (F.col("reason") == waiting.NO_PAGE).alias("late"))


PAGE_BUCKETS = 8
