"""Retry as logs arrive.

Log rows come in micro-batches. The first row of a (stem, URL) that asks for a retry is a candidate; that
there has been one is remembered, so later rows of the same URL are none, whichever batch they
come in. A candidate is forgotten a given time after it, and the URL may be tried again from then
on. Each batch adds its patches to a patch table and its rows to a retry log.

``retry_stream`` keeps the candidates of all batches as a table, which a batch joins as a whole.
``first_candidates`` gives a stream instead, with keyed state; a Python step runs for each URL there.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from touchline import fixed_values as fv
from touchline.functions.names import log_stem
from touchline.functions.text import strip
from touchline.operators.keys import first_per_key, join_on
from touchline.operators.retry import needs_retry, retry_trigger
from touchline.plans import retry as plan
from touchline.session import written
from touchline.streaming.ingest import per_batch, write_batch

KEYS = ("stem", "url")
CANDIDATE = "stem string, url string, retry_trigger string, fields_before string"
TRIED = f"{CANDIDATE}, tried bigint"
DAY_MS = 86_400_000


def asking_rows(logs: DataFrame, threshold: int = fv.RETRY_THRESHOLD) -> tuple[DataFrame, list[str]]:
    """The log rows that ask for a retry (``CANDIDATE``), and the names of the columns they go by, which stand behind."""
    order = plan.line_order(logs)
    by = [f"order_{i}" for i in range(len(order))]
    stripped = logs.withColumn("url", strip(F.col("url")))
    found = stripped.where(needs_retry(F.col("reason"), F.col("non_empty_fields"), threshold)).select(
        log_stem(F.col("file_name")).alias("stem"),
        "url",
        retry_trigger(F.col("reason")).alias("retry_trigger"),
        F.col("non_empty_fields").cast("string").alias("fields_before"),
        *[F.col(c).alias(name) for c, name in zip(order, by)],
    )
    return found, by


def new_candidates(asking: DataFrame, by: Sequence[str], folder: str, batch_id: int, memory_ms: int) -> DataFrame:
    """The candidates of a batch of ``asking_rows`` with the batch's time ``at``, which becomes ``tried``.

    The candidates of all batches lie in the folder. Of the rows of a (stem, URL) the first counts, unless there was a
    candidate in an earlier batch less than ``memory_ms`` ago; a repeated batch finds what its first run found.
    """
    spark = asking.sparkSession
    first = first_per_key(asking, KEYS, [F.col(c) for c in (*by, "retry_trigger", "fields_before", "at")])
    fresh = first.select("stem", "url", "retry_trigger", "fields_before", F.col("at").alias("tried"))
    if batch_id:
        before = spark.read.schema(f"{TRIED}, batch bigint").parquet(folder).where(F.col("batch") < batch_id)
        last = before.groupBy(*KEYS).agg(F.max("tried").alias("_last"))
        known = join_on(fresh, last, KEYS, "left")
        fresh = known.where(F.col("_last").isNull() | (F.col("tried") - F.col("_last") >= memory_ms)).drop("_last")
    write_batch(fresh, folder, batch_id)
    return spark.read.schema(TRIED).parquet(f"{folder}/batch={batch_id}")


def first_candidates(logs: DataFrame, memory_ms: int = 30 * DAY_MS, threshold: int = fv.RETRY_THRESHOLD) -> DataFrame:
    """A stream of retry candidates, one for each (stem, URL) within ``memory_ms``, from a stream of log rows.

    Of the rows of one batch the first by line number counts (without line numbers by time, URL, reason
    and fields). Rows that ask for no retry never reach the state; of a task's rows of one URL only the first of each Arrow
    batch is shuffled, so a URL with very many rows is no large group. Time is that of the batches.
    """
    found, by = asking_rows(logs, threshold)

    def earliest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.sort_values(by, na_position="first", kind="stable").drop_duplicates(["stem", "url"])

    def step(key: tuple[Any, ...], rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        first = None
        for part in rows:
            both = part if first is None else pd.concat([first, part])
            first = both.sort_values(by, na_position="first", kind="stable").head(1)
        now = int(first["at"].iloc[0].timestamp() * 1000)
        tried = state.get[0] if state.exists else None
        if tried is None or now - tried >= memory_ms:
            tried = now
            yield first[["stem", "url", "retry_trigger", "fields_before"]]
        state.update((tried,))
        state.setTimeoutTimestamp(max(tried + memory_ms, state.getCurrentWatermarkMs() + 1))

    fewer = found.mapInPandas(earliest, T.StructType(found.schema.fields))
    timed = fewer.withColumn("at", F.current_timestamp()).withWatermark("at", "0 seconds")
    return timed.groupBy("stem", "url").applyInPandasWithState(
        step, CANDIDATE, "tried bigint", "append", GroupStateTimeout.EventTimeTimeout
    )


def retry_stream(
    logs: DataFrame, collected: DataFrame, base: DataFrame, data_stems: DataFrame, patches: str, retry_log: str, checkpoint: str,
    memory_ms: int = 30 * DAY_MS, threshold: int = fv.RETRY_THRESHOLD,
) -> StreamingQuery:
    """Try the candidates among arriving log rows again: patches into one table, retry log rows into another.

    ``collected`` is the new extraction, ``base`` the match rows and ``data_stems`` the stems of the data files, as
    for the batch job. ``patch.patched_view`` gives the match table under the patches of all batches, and
    ``plans.retry.write_back`` puts them into a stored one. The candidates are kept in the folder ``{retry_log}_tried``.
    """
    asking, by = asking_rows(logs, threshold)

    def step(batch: DataFrame, batch_id: int) -> None:
        found = new_candidates(batch, by, f"{retry_log}_tried", batch_id, memory_ms).drop("tried")
        tried = written(plan.with_extraction(found, collected), "tried")
        write_batch(plan.qualifying(tried), patches, batch_id)
        write_batch(plan.retry_log_rows(base, tried, data_stems), retry_log, batch_id)

    return per_batch(asking.withColumn("at", F.unix_millis(F.current_timestamp())), step, checkpoint)
