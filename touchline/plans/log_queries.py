"""Queries on logs: retry, patches, counts and running totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.operators import logs, retry, status
from touchline.plans import retry as retry_plan
from touchline.plans.registry import query, table
from touchline.session import new_folder, written

# Events as log rows: the type gives the reason, the value the field count, the user the URL.
EVENT_LOG_SQL = """
    SELECT event_id AS line_no, CAST(user_id AS VARCHAR) AS url, event_type, value,
           CASE event_type WHEN 'error' THEN 'No_Stats' WHEN 'purchase' THEN ' no_lineups ' ELSE 'none' END AS reason,
           CASE WHEN event_type = 'signup' THEN CAST(value AS VARCHAR)
                WHEN event_type = 'click' THEN ' ' || CAST(floor(value) AS INT) || ' '
                ELSE CAST(CAST(floor(value) AS INT) AS VARCHAR) END AS non_empty_fields
    FROM events
"""


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    whole = F.floor("value").cast("int").cast("string")
    fields = (
        F.when(kind == "signup", F.col("value").cast("string"))
        .when(kind == "click", F.concat(F.lit(" "), whole, F.lit(" ")))
        .otherwise(whole)
    )
    reason = F.when(kind == "error", "No_Stats").when(kind == "purchase", " no_lineups ").otherwise("none")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("line_no"),
        F.col("user_id").cast("string").alias("url"),
        reason.alias("reason"),
        fields.alias("non_empty_fields"),
    )


@query(
    "rel_retry_candidates",
    f"""
    WITH l AS ({EVENT_LOG_SQL}),
    q AS (
        SELECT *, lower(trim(reason)) IN ('no_stats', 'no_lineups') AS by_reason FROM l
        WHERE lower(trim(reason)) IN ('no_stats', 'no_lineups')
           OR (regexp_matches(trim(non_empty_fields), '^[0-9]+$') AND TRY_CAST(trim(non_empty_fields) AS INT) < 30)
    )
    SELECT line_no, url, reason, non_empty_fields,
           CASE WHEN by_reason THEN lower(trim(reason)) ELSE 'low_fields' END AS retry_trigger
    FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY line_no) AS n FROM q) WHERE n = 1
    """,
)
def rel_retry_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retry.candidates(event_log(spark, sf_dir), [F.col("line_no")])


@query(
    "rel_retry_flags",
    f"""
    WITH l AS ({EVENT_LOG_SQL})
    SELECT line_no, coalesce(lower(trim(reason)) IN ('no_stats', 'no_lineups')
           OR (regexp_matches(trim(non_empty_fields), '^[0-9]+$') AND TRY_CAST(trim(non_empty_fields) AS INT) < 30), false)
           AS needs_retry
    FROM l
    """,
)
def rel_retry_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The retry test on every log row."""
    return event_log(spark, sf_dir).select(
        "line_no", retry.needs_retry(F.col("reason"), F.col("non_empty_fields")).alias("needs_retry")
    )


# Base rows are events (id = user, line = event), patches come from customers, three to an id.
PATCH_COLUMNS = ["event_type", "value", "props"]
PATCH_SQL = """
    SELECT c_custkey AS patch_no, CAST(c_custkey % 500 AS VARCHAR) AS match_id, c_mktsegment AS event_type,
           CASE WHEN c_acctbal < 0 THEN '' ELSE c_name END AS value,
           CAST(c_nationkey AS BIGINT) AS fields_after, CAST(c_custkey % 19 AS VARCHAR) AS fields_before,
           c_custkey % 13 <> 0 AS has_data
    FROM customer
"""
QUALIFYING_SQL = f"""
    SELECT * FROM ({PATCH_SQL}) AS p
    WHERE has_data AND fields_after > CASE WHEN fields_before = '7' THEN 0 ELSE CAST(fields_before AS BIGINT) END
"""


def base_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("match_id"),
        F.col("event_id").alias("line_no"),
        "event_type",
        F.col("props").alias("value"),
        F.col("event_type").alias("props"),
    )


def patch_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    before = (key % 19).cast("string")
    return table(spark, sf_dir, "customer").select(
        key.alias("patch_no"),
        (key % 500).cast("string").alias("match_id"),
        F.col("c_mktsegment").alias("event_type"),
        F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_name")).alias("value"),
        F.col("c_nationkey").cast("bigint").alias("fields_after"),
        F.when(before == "7", "n/a").otherwise(before).alias("fields_before"),
        (key % 13 != 0).alias("has_data"),
    )


def qualifying(patches: DataFrame) -> DataFrame:
    return patches.where(
        retry.patch_decision(F.col("has_data"), F.col("fields_before"), F.col("fields_after"), F.col("match_id"))
    )


PATCHED_SQL = f"""
    WITH q AS ({QUALIFYING_SQL}),
    one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY match_id ORDER BY patch_no DESC) AS n FROM q) WHERE n = 1),
    b AS (
        SELECT CAST(user_id AS VARCHAR) AS match_id, event_id AS line_no, event_type, props AS value, event_type AS props,
               row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n
        FROM events
    )
    SELECT b.match_id, b.line_no, coalesce(one.event_type, b.event_type) AS event_type,
           CASE WHEN one.match_id IS NULL THEN b.value ELSE one.value END AS value,
           CASE WHEN one.match_id IS NULL THEN b.props ELSE '' END AS props, one.match_id IS NOT NULL AS patched
    FROM b LEFT JOIN one ON b.match_id = one.match_id AND b.n = 1
"""


@query("rel_patch_upsert", PATCHED_SQL)
def rel_patch_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last qualifying patch of an id replaces the whole first row of that id."""
    patches = retry.patches_to_apply(qualifying(patch_candidates(spark, sf_dir)), ["match_id"], [F.col("patch_no")])
    return retry.patch_rows(base_rows(spark, sf_dir), patches, ["match_id"], "line_no", PATCH_COLUMNS)


@query(
    "rel_patch_best",
    f"""
    WITH q AS ({QUALIFYING_SQL}),
    one AS (
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY match_id ORDER BY fields_after DESC, patch_no) AS n FROM q)
        WHERE n = 1
    ),
    b AS (
        SELECT CAST(user_id AS VARCHAR) AS match_id, event_id AS line_no, event_type, props AS value, event_type AS props,
               row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n
        FROM events
    )
    SELECT b.match_id, b.line_no, coalesce(one.event_type, b.event_type) AS event_type,
           coalesce(nullif(one.value, ''), b.value) AS value, b.props, one.match_id IS NOT NULL AS patched
    FROM b LEFT JOIN one ON b.match_id = one.match_id AND b.n = 1
    """,
)
def rel_patch_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best qualifying patch of an id fills the first row of that id; its blanks keep old values."""
    patches = retry.patches_to_apply(
        qualifying(patch_candidates(spark, sf_dir)), ["match_id"], [F.col("patch_no")], keep="best"
    )
    return retry.patch_rows(
        base_rows(spark, sf_dir), patches, ["match_id"], "line_no", PATCH_COLUMNS, merge="coalesce"
    )


@query(
    "rel_retry_log",
    f"""
    WITH p AS (SELECT *, patch_no % 50 AS stem, patch_no % 11 = 3 AS failed FROM ({PATCH_SQL}) AS c),
    ids AS (SELECT DISTINCT event_id % 50 AS stem, CAST(user_id AS VARCHAR) AS match_id FROM events),
    files AS (SELECT DISTINCT doc_id % 50 AS stem FROM labels WHERE doc_id % 50 < 35)
    SELECT 'https://us.example.com/' || patch_no AS url, NOT failed AND p.fields_after < 20 AS success,
           CASE WHEN failed THEN left(repeat('failed ', 30), 120) WHEN p.fields_after < 20 THEN 'none' ELSE 'no_lineups' END AS reason,
           CASE WHEN NOT failed THEN CAST(p.fields_after AS INT) END AS non_empty_fields, 'x_match_data.csv' AS file_name,
           CASE WHEN fields_before <> '7' THEN CAST(fields_before AS INT) END AS fields_before,
           CASE WHEN NOT failed THEN CAST(p.fields_after AS INT) END AS fields_after,
           NOT failed AND has_data AND p.fields_after > CASE WHEN fields_before = '7' THEN 0 ELSE CAST(fields_before AS BIGINT) END
               AND ids.match_id IS NOT NULL AND files.stem IS NOT NULL AS row_updated,
           'low_fields' AS retry_trigger, files.stem IS NOT NULL AS data_csv_found
    FROM p LEFT JOIN ids ON p.match_id = ids.match_id AND p.stem = ids.stem LEFT JOIN files ON files.stem = p.stem
    """,
)
def rel_retry_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retry log rows: updated only if the log's own data file is there and has the id; some retries end in an error."""
    number = F.col("patch_no")
    tried = patch_candidates(spark, sf_dir).select(
        "*",
        (number % 50).alias("stem"),
        F.concat(F.lit("https://us.example.com/"), number.cast("string")).alias("url"),
        F.when(F.col("fields_after") < 20, "").otherwise("no_lineups").alias("status"),
        F.when(number % 11 == 3, F.repeat(F.lit("failed "), F.lit(30))).alias("error"),
        F.lit("x_match_data.csv").alias("file_name"),
        F.lit("low_fields").alias("retry_trigger"),
    )
    stem = F.col("doc_id") % 50
    stems = table(spark, sf_dir, "labels").where(stem < 35).select(stem.alias("stem"))
    known = base_rows(spark, sf_dir).withColumn("stem", F.col("line_no") % 50)
    rows = retry.retry_log(retry.with_data_flag(tried, stems), known)
    return rows.select(
        "url", "success", "reason", "non_empty_fields", "file_name", "fields_before", "fields_after", "row_updated",
        "retry_trigger", "data_csv_found",
    )


RETRY_JOB_LOG_SQL = f"""
    WITH l AS (SELECT *, CASE WHEN line_no % 2 = 0 THEN 'a' ELSE 'b' END AS stem FROM ({EVENT_LOG_SQL}) AS e),
    q AS (
        SELECT *, row_number() OVER (PARTITION BY stem, url ORDER BY line_no) AS n FROM l
        WHERE lower(trim(reason)) IN ('no_stats', 'no_lineups')
           OR (regexp_matches(trim(non_empty_fields), '^[0-9]+$') AND TRY_CAST(trim(non_empty_fields) AS INT) < 30)
    ),
    t AS (
        SELECT q.*, c_custkey IS NOT NULL AS found, c_nationkey % 4 = 1 AS lost, c_nationkey * 2 + 20 AS after,
               CASE WHEN regexp_matches(trim(non_empty_fields), '^[0-9]+$') THEN CAST(trim(non_empty_fields) AS INT) END AS before,
               EXISTS (SELECT 1 FROM events WHERE event_id % 2 = 0 AND CAST(user_id AS VARCHAR) = q.url) AS known
        FROM q LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 <> 0) ON q.url = CAST(c_custkey AS VARCHAR) WHERE n = 1
    )
    SELECT stem || '_match_data.csv' AS file_name, url AS match_id, found AND NOT lost AS success,
           CASE WHEN NOT found THEN 'no page' WHEN lost THEN '404' ELSE 'none' END AS reason,
           before AS fields_before, CASE WHEN found THEN CAST(after AS INT) END AS fields_after, stem = 'a' AS data_csv_found,
           COALESCE(found AND NOT lost AND after > COALESCE(before, 0) AND stem = 'a' AND known, false) AS row_updated
    FROM t
"""


def retry_tables(spark: SparkSession, sf_dir: str, fetched: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows of two logs, the new extraction, and the rows of the two data files."""
    stem = F.when(F.col("line_no") % 2 == 0, "a").otherwise("b")
    address = lambda number: F.concat(F.lit("https://us.example.com/game/x/?mid="), number)
    log = event_log(spark, sf_dir).withColumn("file_name", F.concat(stem, F.lit("_scrape_log.csv")))
    log = log.withColumn("url", F.concat(F.lit(" "), address(F.col("url"))))
    collected = table(spark, sf_dir, "customer").where(fetched).select(
        address(F.col("c_custkey").cast("string")).alias("url"),
        F.when(F.col("c_nationkey") % 4 == 1, "404").otherwise("").alias("status"),
        (F.col("c_nationkey") * 2 + 20).alias("non_empty_fields"),
        F.lit("").alias("match_id"),
        F.col("c_name").alias("stadium"),
        F.lit("").alias("scraped_at"),
    )
    base = base_rows(spark, sf_dir).select("match_id", "line_no", stem.alias("stem"), F.col("event_type").alias("stadium"))
    absent = [c for c in retry_plan.MATCH_COLUMNS if c not in base.columns]
    return log, collected, base.select("*", *[F.lit("").alias(c) for c in absent])


def retry_job(spark: SparkSession, sf_dir: str, fetched: Column) -> tuple[DataFrame, DataFrame]:
    """Retry candidates of the logs with their new extraction, and the rows of the data files."""
    log, collected, base = retry_tables(spark, sf_dir, fetched)
    return retry_plan.retried(log, collected), base


def retry_log_digest(rows: DataFrame) -> DataFrame:
    return rows.select(
        "file_name", F.regexp_extract("url", "mid=(.*)$", 1).alias("match_id"), "success", "reason", "fields_before",
        "fields_after", "data_csv_found", "row_updated",
    )


@query("job_retry_log", RETRY_JOB_LOG_SQL)
def job_retry_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of the retry job: a row for each candidate, also for those without a page; only one data file is there."""
    tried, base = retry_job(spark, sf_dir, F.col("c_custkey") % 3 != 0)
    return retry_log_digest(retry_plan.retry_log_rows(base, tried, spark.createDataFrame([("a",)], "stem string")))


RETRY_JOB_SQL = f"""
    WITH l AS (SELECT *, CASE WHEN line_no % 2 = 0 THEN 'a' ELSE 'b' END AS stem FROM ({EVENT_LOG_SQL}) AS e),
    q AS (
        SELECT *, row_number() OVER (PARTITION BY stem, url ORDER BY line_no) AS n FROM l
        WHERE lower(trim(reason)) IN ('no_stats', 'no_lineups')
           OR (regexp_matches(trim(non_empty_fields), '^[0-9]+$') AND TRY_CAST(trim(non_empty_fields) AS INT) < 30)
    ),
    patch AS (
        SELECT q.stem, q.url AS match_id, c_name FROM q JOIN customer ON q.url = CAST(c_custkey AS VARCHAR)
        WHERE n = 1 AND c_nationkey % 4 <> 1 AND c_nationkey * 2 + 20 >
              CASE WHEN regexp_matches(trim(non_empty_fields), '^[0-9]+$') THEN CAST(trim(non_empty_fields) AS INT) ELSE 0 END
    ),
    b AS (
        SELECT event_id AS line_no, CASE WHEN event_id % 2 = 0 THEN 'a' ELSE 'b' END AS stem,
               CAST(user_id AS VARCHAR) AS match_id, event_type FROM events
    ),
    first AS (SELECT stem, match_id, min(line_no) AS line_no FROM b GROUP BY stem, match_id)
    SELECT b.line_no, b.stem, b.match_id, coalesce(patch.c_name, b.event_type) AS stadium, patch.c_name IS NOT NULL AS patched
    FROM b LEFT JOIN first ON first.line_no = b.line_no
    LEFT JOIN patch ON patch.stem = first.stem AND patch.match_id = first.match_id
"""


@query("job_retry", RETRY_JOB_SQL)
def job_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The retry job over the logs of two data files that hold the same ids; each log patches its own file."""
    tried, base = retry_job(spark, sf_dir, F.lit(True))
    return retry_plan.patched_table(base, tried, "line_no").select("line_no", "stem", "match_id", "stadium", "patched")


@query(
    "table_write_back",
    f"""
    WITH q AS (SELECT *, CASE patch_no % 3 WHEN 0 THEN 's3' WHEN 1 THEN 's7' ELSE 's99' END AS stem FROM ({QUALIFYING_SQL}) AS c),
    one AS (
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY stem, match_id ORDER BY patch_no DESC) AS n FROM q) WHERE n = 1
    ),
    b AS (
        SELECT 's' || event_id % 20 AS stem, event_id AS line_no, CAST(user_id AS VARCHAR) AS match_id, event_type, props,
               row_number() OVER (PARTITION BY event_id % 20, user_id ORDER BY event_id) AS n
        FROM events
    ),
    hit AS (SELECT DISTINCT b.stem FROM b JOIN one ON one.stem = b.stem AND one.match_id = b.match_id)
    SELECT b.stem, b.line_no, b.match_id, coalesce(one.event_type, b.event_type) AS event_type,
           CASE WHEN one.match_id IS NULL THEN b.props ELSE one.value END AS value,
           CASE WHEN one.match_id IS NULL THEN b.event_type ELSE '' END AS props,
           b.stem IN (SELECT stem FROM hit) AS written_anew
    FROM b LEFT JOIN one ON one.stem = b.stem AND one.match_id = b.match_id AND b.n = 1
    """,
)
def table_write_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table of twenty stems after patches to two of them; whether a row's file is one that was not there before."""
    path = new_folder(spark, "stored")
    stem = F.concat(F.lit("s"), (F.col("line_no") % 20).cast("string"))
    base = base_rows(spark, sf_dir).withColumn("stem", stem)
    base.write.partitionBy("stem").parquet(path)
    files = lambda: spark.read.schema(base.schema).parquet(path).select("*", F.col("_metadata.file_name").alias("file"))
    before = written(files().select("file").distinct(), "files")
    third = F.col("patch_no") % 3
    named = qualifying(patch_candidates(spark, sf_dir)).withColumn(
        "stem", F.when(third == 0, "s3").when(third == 1, "s7").otherwise("s99")
    )
    patches = retry.patches_to_apply(named, ["stem", "match_id"], [F.col("patch_no")])
    retry_plan.write_back(spark, path, base.schema, patches, "line_no", PATCH_COLUMNS)
    after = files().join(before.withColumn("old", F.lit(True)), "file", "left")
    return after.select("stem", "line_no", "match_id", "event_type", "value", "props", F.col("old").isNull().alias("written_anew"))


@query(
    "agg_count_rollup",
    """
    SELECT coalesce(event_type, 'TOTAL') AS event_type, count(*) AS n_urls FROM events GROUP BY ROLLUP (event_type)
    """,
)
def agg_count_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.counts_with_total(table(spark, sf_dir, "events"), "event_type")


@query(
    "agg_success",
    """
    SELECT user_id, count(*) AS n_rows, count(*) FILTER (WHERE event_type <> 'error') AS n_with_data,
           count(*) FILTER (WHERE event_type IN ('view', 'click') AND value > 30) AS n_success
    FROM events GROUP BY user_id
    """,
)
def agg_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    success = kind.isin("view", "click") & (F.col("value") > 30)
    return logs.success_counts(table(spark, sf_dir, "events"), "user_id", kind != "error", success)


# Stretches of consecutive event ids; each task of a running total sees one stretch of one user.
BAND_ROWS = 1_000_000


@query(
    "win_running_total",
    """
    SELECT event_id, user_id, CAST(sum(CAST(value AS DECIMAL(18, 2))) OVER (PARTITION BY user_id ORDER BY event_id
           ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS cumulative_total_s
    FROM events
    """,
)
def win_running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    seconds = F.col("value").cast("decimal(18,2)")
    band = F.expr(f"event_id div {BAND_ROWS}")
    rows = logs.elapsed_per_file(events, "user_id", [F.col("event_id")], seconds, band, "total")
    return rows.select("event_id", "user_id", F.col("total").cast("double").alias("cumulative_total_s"))


@query(
    "win_running_total_global",
    """
    SELECT event_id, user_id, CAST(sum(CAST(value AS DECIMAL(18, 2))) OVER (ORDER BY user_id, event_id
           ROWS UNBOUNDED PRECEDING) AS DOUBLE) + 30 * (dense_rank() OVER (ORDER BY user_id) - 1) AS cumulative_total_s
    FROM events
    """,
)
def win_running_total_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The running total carried over users in order, with a pause of 30 after each."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    seconds = F.col("value").cast("decimal(18,2)")
    band = F.expr(f"event_id div {BAND_ROWS}")
    pauses = events.select("user_id").distinct().withColumn("pause", F.lit(30))
    rows = logs.elapsed_overall(events, "user_id", [F.col("event_id")], seconds, band, "total", pauses)
    return rows.select("event_id", "user_id", F.col("total").cast("double").alias("cumulative_total_s"))


@query(
    "log_reason",
    """
    SELECT CAST(event_id AS VARCHAR) AS url, strftime(ts, '%Y-%m-%d %H:%M:%S') AS scraped_at,
           event_type = 'view' AS success,
           CASE event_type WHEN 'error' THEN left(repeat(props, 20), 120) WHEN 'view' THEN 'none' ELSE event_type END AS reason,
           CASE WHEN event_type <> 'error' THEN CAST(event_id % 119 AS INT) END AS non_empty_fields,
           CASE WHEN event_type <> 'error' THEN value END AS t_summary_s,
           CASE WHEN event_type <> 'error' THEN CAST(CAST(value AS DECIMAL(18, 2)) + CAST(event_id % 700 AS DECIMAL(18, 2)) / 100
               + 2 AS DOUBLE) END AS t_scrape_only_s,
           CAST(NULL AS DOUBLE) AS sleep_after_stats_s
    FROM events
    """,
)
def log_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    results = table(spark, sf_dir, "events").select(
        F.col("ts").alias("scraped_at"),
        F.col("event_id").cast("string").alias("url"),
        F.when(kind == "view", "").otherwise(kind).alias("status"),
        F.when(kind == "error", F.repeat("props", F.lit(20))).alias("error"),
        (F.col("event_id") % 119).alias("non_empty_fields"),
        F.col("value").alias("t_summary_s"),
        (F.col("event_id") % 700 / 100).alias("t_stats_s"),
        F.lit(2.0).alias("t_lineups_s"),
    )
    return status.log_rows(results).select(
        "url",
        F.left(F.col("scraped_at").cast("string"), F.lit(19)).alias("scraped_at"),
        "success",
        "reason",
        "non_empty_fields",
        "t_summary_s",
        "t_scrape_only_s",
        "sleep_after_stats_s",
    )
