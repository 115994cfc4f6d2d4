"""Listed URLs that wait for their pages, as keyed state of a stream.

A URL may be listed before or after its page arrives, and neither has to come with anything else. For
each URL a streaming aggregate keeps when it was first listed, until when it waits and when its page came;
pages themselves never enter the state. In the batch in which both are known the URL is ``ready``. URLs
that are listed and have no page stand in a table, too, which each batch takes over from the one before;
one that has waited for too long leaves it as ``late``, once. Should its page arrive after that, it is
``ready`` then. A page that no list names waits without a limit.

Time is that of the batches: a URL is late once a batch with new rows has begun that much after the one
it was listed in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from touchline.operators.status import log_rows
from touchline.plans.collect import collect_matches, match_table
from touchline.session import written
from touchline.streaming.ingest import per_batch, write_batch

NO_PAGE = "no page"
WAITING = "url string, until bigint"


def waiting(listed: DataFrame, arrived: DataFrame, patience_ms: int) -> DataFrame:
    """The URLs that a batch touches, from the streams of listed URLs and of arrived pages (``url``); for output mode ``update``.

    ``ready`` is true in the batch in which a URL is first known to be listed and to have a page. ``until`` is when a
    listed URL without a page has waited for ``patience_ms`` since it was last listed, ``now`` the time of the batch, both in
    milliseconds.
    """
    both = listed.select("url", F.lit(True).alias("listed")).unionByName(arrived.select("url", F.lit(False).alias("listed")))
    timed = both.withColumn("at", F.unix_millis(F.current_timestamp()))
    listed_at = F.when(F.col("listed"), F.col("at"))
    seen = timed.groupBy("url").agg(
        F.min(listed_at).alias("first_listed"),
        F.min(F.when(~F.col("listed"), F.col("at"))).alias("first_page"),
        F.max_by(F.col("at") + F.lit(patience_ms).cast("bigint"), listed_at).alias("until"),
        F.max("at").alias("now"),
    )
    known = F.col("first_listed").isNotNull() & F.col("first_page").isNotNull()
    return seen.select(
        "url",
        (known & (F.greatest("first_listed", "first_page") == F.col("now"))).alias("ready"),
        F.when(F.col("first_page").isNull(), F.col("until")).alias("until"),
        "now",
    )


def waiting_and_late(touched: DataFrame, folder: str, batch_id: int) -> tuple[DataFrame, DataFrame]:
    """Listed URLs without a page after a batch: those that go on waiting, and those that are late (``url``, ``until``).

    Two tables of the URLs that wait lie in the folder, of the last batch and of the one before, and the late URLs of
    all batches; a repeated batch finds what its first run found.
    """
    spark = touched.sparkSession
    now = touched.agg(F.max("now")).first()[0]
    rows = touched.where(F.col("until").isNotNull()).select("url", "until")
    if batch_id:
        before = spark.read.schema(f"{WAITING}, batch bigint").parquet(f"{folder}/late").where(F.col("batch") < batch_id)
        held = spark.read.schema(WAITING).parquet(f"{folder}/waiting/slot={(batch_id - 1) % 2}")
        rows = rows.join(before, "url", "left_anti").unionByName(held.join(touched, "url", "left_anti"))
    rows = written(rows, "listed")
    is_late = F.coalesce(F.col("until") < F.lit(now), F.lit(False))
    rows.where(~is_late).write.mode("overwrite").parquet(f"{folder}/waiting/slot={batch_id % 2}")
    write_batch(rows.where(is_late), f"{folder}/late", batch_id)
    return rows.where(~is_late), rows.where(is_late)


def page_bucket(url, buckets: int):
    """The bucket of a URL's pages in a table that is partitioned by ``bucket``."""
    return F.pmod(F.xxhash64(url), F.lit(buckets)).cast("int")


def write_pages(pages: DataFrame, path: str, buckets: int) -> None:
    """Append pages to a table that is partitioned by URL bucket and tab.

    A batch of the stream reads the buckets of its URLs only, and a tab's rows lie apart from the others'.
    """
    pages.withColumn("bucket", page_bucket(F.col("url"), buckets)).write.mode("append").partitionBy("bucket", "tab").parquet(path)


def collect_waiting(
    listed: DataFrame, arrived: DataFrame, pages: DataFrame, domain: str, matches: str, logs: str, checkpoint: str, patience_ms: int,
    buckets: int | None = None,
) -> StreamingQuery:
    """Extract the matches of URLs as soon as they are listed and their summary page is there.

    ``listed`` and ``arrived`` are streams, ``pages`` is the page table that ``arrived`` follows. If it is
    partitioned by ``bucket`` (see ``write_pages``), only the buckets of a batch's URLs are read; the
    ``buckets`` is their number, which bounds what the driver learns. Late URLs get a log row with the
    reason ``no page``. The URLs that wait are kept in the folder ``{matches}_waiting``.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        touched = written(batch, "waiting")
        ready = touched.where("ready").select("url")
        _, overdue = waiting_and_late(touched, f"{matches}_waiting", batch_id)
        late = overdue.select("url", F.lit("").alias("status"), F.lit(NO_PAGE).alias("error"))
        if ready.isEmpty():
            write_batch(log_rows(late), logs, batch_id)
            return
        here = pages
        if buckets is not None:
            used = [r[0] for r in ready.select(page_bucket(F.col("url"), buckets)).distinct().collect()]
            here = here.where(F.col("bucket").isin(used))
        here = here.select("url", "tab", "html").join(ready, "url", "left_semi")
        write_batch(collect_matches(here, domain), f"{matches}_text", batch_id)
        saved = batch.sparkSession.read.parquet(f"{matches}_text/batch={batch_id}")
        write_batch(match_table(saved), matches, batch_id)
        write_batch(log_rows(saved).unionByName(log_rows(late)), logs, batch_id)

    return per_batch(waiting(listed, arrived, patience_ms), step, checkpoint, "update")
