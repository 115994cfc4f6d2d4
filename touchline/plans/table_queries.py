"""Queries on sources, sinks, unions and reshaping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline import schemas
from touchline.functions.text import WHITE_SPACE
from touchline.operators import logs, reshape
from touchline.operators.keys import first_per_key
from touchline.operators.retry import with_data_flag
from touchline.plans.combine import combined
from touchline.plans.registry import MATCHES_SQL, order_matches, query, table
from touchline.session import new_folder
from touchline.sources import leagues, lists, sinks, tables


@query(
    "src_list_clean",
    f"""
    WITH l AS (
        SELECT doc_id, unnest(range(len(parts))) AS line_no, unnest(parts) AS line
        FROM (SELECT doc_id, string_split_regex(text, '\\r\\n|\\r|\\n') AS parts FROM documents)
    )
    SELECT doc_id, CAST(line_no AS INT) AS line_no, trim(line, '{WHITE_SPACE}') AS line
    FROM l WHERE trim(line, '{WHITE_SPACE}') <> '' AND NOT starts_with(line, '#')
    """,
)
def src_list_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select(
        "doc_id", F.posexplode(F.split("text", "\r\n|\r|\n")).alias("line_no", "value")
    )
    return lists.clean_lines(lines, "value", "line")


@query(
    "src_list_files",
    """
    SELECT lower(o_orderpriority[1:1]) || '_' || year(o_orderdate) AS stem, count(*) AS n_urls,
           count(DISTINCT o_orderkey) AS n_distinct, min('https://us.example.com/' || o_orderkey) AS first_url
    FROM orders GROUP BY 1
    """,
)
def src_list_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists written to text files per stem, and found and read again."""
    stem = F.concat_ws("_", F.lower(F.left("o_orderpriority", F.lit(1))), F.year("o_orderdate").cast("string"))
    orders = table(spark, sf_dir, "orders").select(
        stem.alias("stem"), F.concat(F.lit("https://us.example.com/"), F.col("o_orderkey").cast("string")).alias("url")
    )
    folder = new_folder(spark, "lists")
    sinks.write_lists(orders, folder)
    return lists.read_lists(spark, folder).groupBy("stem").agg(
        F.count(F.lit(1)).alias("n_urls"),
        F.countDistinct(F.regexp_extract("url", r"(\d+)$", 1)).alias("n_distinct"),
        F.min("url").alias("first_url"),
    )


MATCH_TEXT_SQL = f"""
    SELECT CAST(match_key AS VARCHAR) AS match_id, strftime(day, '%Y-%m-%d') AS day, match_key % 2 = 0 AS has_crowd,
           match_key % 50000 AS crowd, lpad(CAST(match_key % 12 + 1 AS VARCHAR), 2, '0') AS hour,
           'team_' || home_key AS home_team, 'team_' || away_key AS away_team,
           CAST(home_goals AS INT) AS home_goals, CAST(away_goals AS INT) AS away_goals,
           CASE WHEN home_goals > away_goals THEN 'H' WHEN home_goals < away_goals THEN 'A' ELSE 'D' END AS result,
           home_xg_hundredths / 100.0 AS home_xg
    FROM ({MATCHES_SQL})
"""


def match_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All match columns as stored text, made from orders; blank where orders give nothing."""
    key = F.col("match_id")
    hour = F.lpad((key % 12 + 1).cast("string"), 2, "0")
    rows = order_matches(spark, sf_dir).select(
        key.cast("string").alias("match_id"),
        F.date_format("kickoff_ts", "MMMM dd, yyyy").alias("date"),
        F.concat(hour, F.lit(":30 PM")).alias("kickoff_time"),
        F.when(key % 2 == 0, (key % 50000).cast("string")).alias("attendance"),
        F.lit('The "Old" Ground, North').alias("stadium"),
        "home_team",
        "away_team",
        F.col("home_goals").cast("string").alias("home_goals"),
        F.col("away_goals").cast("string").alias("away_goals"),
        "result",
        F.col("home_xg").cast("string").alias("home_xg"),
        F.col("away_xg").cast("string").alias("away_xg"),
    )
    return tables.conform(rows, schemas.all_strings(schemas.MATCH))


CSV = {"header": "true", "quote": '"', "escape": '"'}


def write_season_files(spark: SparkSession, sf_dir: str) -> list[str]:
    """Match files in three folders: under a stem's name; in another order with quoted names and line breaks; without some ids."""
    rows = match_text(spark, sf_dir)
    part = F.col("match_id").cast("bigint") % 3
    named, turned, holes = (new_folder(spark, "season") + end for end in ("", "-cup_2026", "-other"))
    sinks.write_season_files(rows.where(part == 0).withColumn("stem", F.lit("cup_2024-2025")), named)
    names = [f.name for f in schemas.MATCH.fields]
    broken = rows.where(part == 1).withColumn("city", F.lit("North\nSide"))
    broken.select(*reversed(names)).write.options(**CSV, quoteAll="true").csv(f"{turned}/cup_2026")
    missing = F.when(F.col("match_id").cast("bigint") % 7 != 0, F.col("match_id"))
    few = ["round", "match_id", "date", "kickoff_time", "attendance", "stadium", "home_team", "away_team", "home_goals",
           "away_goals", "result", "home_xg"]
    rows.where(part == 2).withColumn("match_id", missing).select(*few).write.options(**CSV).csv(f"{holes}/other")
    return [named, f"{turned}/cup_2026", f"{holes}/other"]


@query(
    "src_match_csv",
    f"""
    SELECT match_id, day || ' ' || lpad(CAST(CASE WHEN hour = '12' THEN 12 ELSE CAST(hour AS INT) + 12 END AS VARCHAR), 2, '0')
               || ':30:00' AS kickoff,
           CASE WHEN has_crowd THEN CAST(crowd AS INT) END AS attendance, 'The "Old" Ground, North' AS stadium,
           home_team, away_team, home_goals, away_goals, result, CAST(home_xg AS DOUBLE) AS home_xg,
           CASE WHEN CAST(match_id AS BIGINT) % 3 = 1 THEN 'North' || chr(10) || 'Side' END AS city, CAST(NULL AS INT) AS home_corners
    FROM ({MATCH_TEXT_SQL}) AS t
    WHERE CAST(match_id AS BIGINT) % 3 <> 2 OR CAST(match_id AS BIGINT) % 7 <> 0
    """,
)
def src_match_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches of three folders with different headers, read by name in one scan."""
    columns = ["match_id", "date", "kickoff_time", "attendance", "stadium", "home_team", "away_team", "home_goals",
               "away_goals", "result", "home_xg", "city", "home_corners"]
    folders = write_season_files(spark, sf_dir)
    return tables.read_matches(spark, folders, columns=columns).select(
        "match_id",
        F.left(F.col("kickoff_ts").cast("string"), F.lit(19)).alias("kickoff"),
        "attendance",
        "stadium",
        "home_team",
        "away_team",
        "home_goals",
        "away_goals",
        "result",
        F.col("home_xg").cast("double").alias("home_xg"),
        "city",
        "home_corners",
    )


def rename_parts(spark: SparkSession, folder: str, suffix: str) -> None:
    """Give the files that Spark wrote into a folder the ending that the jobs look for."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(path):
        name = status.getPath().getName()
        if name.startswith("part-"):
            new = spark._jvm.org.apache.hadoop.fs.Path(path, name.removesuffix(".csv") + suffix)
            files.rename(status.getPath(), new)


@query(
    "src_log_csv",
    """
    SELECT 'u' || event_id AS url, event_id % 2 = 0 AS success, event_id % 3 <> 0 AS whole,
           CASE WHEN event_id % 3 <> 0 THEN event_type END AS reason,
           CASE WHEN event_id % 3 <> 0 THEN CAST(event_id % 119 AS INT) END AS non_empty_fields
    FROM events WHERE event_id % 5 <> 0
    """,
)
def src_log_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scrape logs, some without columns, read from a folder that holds a retry log too."""
    number = F.col("event_id")
    rows = table(spark, sf_dir, "events").select(
        F.col("ts").alias("scraped_at"),
        F.concat(F.lit("u"), number.cast("string")).alias("url"),
        (number % 2 == 0).alias("success"),
        F.col("event_type").alias("reason"),
        (number % 119).alias("non_empty_fields"),
        "event_id",
    )
    folder = new_folder(spark, "logs")
    columns = ["scraped_at", "url", "success", "reason", "non_empty_fields"]
    parts = {
        "whole_scrape_log.csv": rows.where((number % 5 != 0) & (number % 3 != 0)).select(*columns),
        "short_Scrape_Log.csv": rows.where((number % 5 != 0) & (number % 3 == 0)).select("success", "url"),
        "again_retry_log.csv": rows.where(number % 5 == 0).select(*columns),
    }
    for suffix, part in parts.items():
        part.write.options(**CSV).csv(f"{folder}/{suffix}")
        rename_parts(spark, f"{folder}/{suffix}", suffix)
    read = tables.read_logs(spark, f"{folder}/*")
    return read.select("url", "success", F.col("scraped_at").isNotNull().alias("whole"), "reason", "non_empty_fields")


@query(
    "job_combined",
    f"""
    SELECT CASE WHEN CAST(match_id AS BIGINT) % 3 <> 2 OR CAST(match_id AS BIGINT) % 7 <> 0 THEN match_id END AS match_id,
           home_team, away_team, home_goals,
           CASE WHEN CAST(match_id AS BIGINT) % 3 = 1 THEN 'North' || chr(10) || 'Side' END AS city,
           ['2024-2025', '2026', 'unknown'][CAST(match_id AS BIGINT) % 3 + 1] AS season, 109 AS n_columns
    FROM ({MATCH_TEXT_SQL}) AS t
    """,
)
def job_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The combine job over folders with different headers; rows without id stay."""
    united = combined(spark, write_season_files(spark, sf_dir), add_season=True)
    return united.select("match_id", "home_team", "away_team", "home_goals", "city", "season", F.lit(len(united.columns)).alias("n_columns"))


@query(
    "rel_catalog_filter",
    "SELECT p_partkey, p_name, p_type FROM part WHERE contains(lower(p_type), 'm') AND contains(lower(p_name), 'bolt')",
)
def rel_catalog_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    return leagues.containing(leagues.containing(parts, "p_type", "M"), "p_name", "Bolt")


@query(
    "rel_conform_schema",
    """
    SELECT c_name, CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(NULL AS VARCHAR) AS c_phone, c_acctbal FROM customer
    """,
)
def rel_conform_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed = T.StructType([
        T.StructField("c_name", T.StringType()),
        T.StructField("c_custkey", T.StringType()),
        T.StructField("c_phone", T.StringType()),
        T.StructField("c_acctbal", T.DoubleType()),
    ])
    return tables.conform(table(spark, sf_dir, "customer"), fixed)


@query(
    "sink_append",
    """
    SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS scraped_at, CAST(event_id AS VARCHAR) AS url, event_type AS reason,
           CAST(floor(value) AS INT) AS non_empty_fields, value AS t_total_s, CAST(NULL AS DOUBLE) AS t_stats_s
    FROM events
    """,
)
def sink_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as log rows, appended in two parts under the fixed log schema and read again."""
    events = table(spark, sf_dir, "events").select(
        F.col("ts").alias("scraped_at"),
        F.col("event_id").cast("string").alias("url"),
        F.col("event_type").alias("reason"),
        F.floor("value").cast("int").alias("non_empty_fields"),
        F.col("value").alias("t_total_s"),
        F.col("props").alias("not_in_the_log"),
    )
    folder = new_folder(spark, "log")
    is_view = F.col("reason") == "view"
    sinks.append_rows(events.where(is_view), folder, schemas.LOG)
    sinks.append_rows(events.where(~is_view), folder, schemas.LOG)
    log = spark.read.schema(schemas.LOG).parquet(folder)
    return log.select(
        F.left(F.col("scraped_at").cast("string"), F.lit(19)).alias("scraped_at"),
        "url",
        "reason",
        "non_empty_fields",
        "t_total_s",
        "t_stats_s",
    )


@query(
    "sink_links_by_stem",
    "SELECT regexp_extract(url, '^https?://([^/]+)/', 1) AS stem, url FROM pages",
)
def sink_links_by_stem(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = table(spark, sf_dir, "pages").select(
        F.regexp_extract("url", r"^https?://([^/]+)/", 1).alias("stem"), "url"
    )
    folder = new_folder(spark, "links")
    sinks.write_links(links, folder)
    return spark.read.schema("value string, stem string").text(folder).select("stem", F.col("value").alias("url"))


@query(
    "rel_first_per_key",
    """
    SELECT user_id, event_id, event_type, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n
        FROM events WHERE event_type IN ('error', 'signup')
    ) WHERE n = 1
    """,
)
def rel_first_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    qualifying = events.where(F.col("event_type").isin("error", "signup"))
    return first_per_key(qualifying, ["user_id"], [F.col("event_id")])


@query(
    "rel_stem_join",
    """
    SELECT d.doc_id, d.lang, l.doc_id IS NOT NULL AS data_csv_found
    FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id
    """,
)
def rel_stem_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return with_data_flag(documents, table(spark, sf_dir, "labels"), "doc_id")


@query(
    "rel_union_by_name",
    """
    SELECT c_custkey AS key, c_name AS name, c_acctbal AS acctbal, c_mktsegment AS segment, NULL::INT AS nation
    FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL, s_nationkey FROM supplier
    """,
)
def rel_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS key", "c_name AS name", "c_acctbal AS acctbal", "c_mktsegment AS segment"
    )
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "s_nationkey AS nation", "s_acctbal AS acctbal", "s_name AS name", "s_suppkey AS key"
    )
    return reshape.union_by_name([customers, suppliers])


@query(
    "rel_insert_column",
    """
    SELECT s_suppkey, s_name, CAST(2000 + s_nationkey AS VARCHAR) AS season, s_nationkey, s_acctbal FROM supplier
    """,
)
def rel_insert_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier")
    return reshape.insert_column(suppliers, "season", (F.lit(2000) + F.col("s_nationkey")).cast("string"))


LABEL_MAP = [("ring", "jewel"), ("red", "colour"), ("small", "size"), ("blue", "colour"), ("all", "size"),
             ("eco", "type"), ("economy", "economy"), ("hot", "heat"), ("gear", "part"), ("bolt", "part"),
             ("widget", "gadget")]


def _label_case_sql(text: str) -> str:
    keys = sorted(LABEL_MAP, key=lambda pair: -len(pair[0]))
    whens = " ".join(f"WHEN contains({text}, '{key}') THEN '{value}'" for key, value in keys)
    return f"CASE {whens} END"


@query(
    "rel_label_map",
    f"""
    WITH m AS (SELECT * FROM (VALUES {', '.join(f"({i}, '{k}', '{v}')" for i, (k, v) in enumerate(LABEL_MAP))}) AS t(n, key, col)),
    labels_seen AS (SELECT DISTINCT lower(p_name) AS label FROM part UNION SELECT DISTINCT lower(p_type) FROM part),
    best AS (
        SELECT label, col, row_number() OVER (PARTITION BY label ORDER BY length(key) DESC, n) AS r
        FROM labels_seen JOIN m ON contains(label, key)
    )
    SELECT p_partkey, a.col AS by_name, b.col AS by_type
    FROM part LEFT JOIN best a ON a.label = lower(p_name) AND a.r = 1
    LEFT JOIN best b ON b.label = lower(p_type) AND b.r = 1
    """,
)
def rel_label_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        reshape.mapped_label(F.col("p_name"), LABEL_MAP).alias("by_name"),
        reshape.mapped_label(F.col("p_type"), LABEL_MAP).alias("by_type"),
    )


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def _kept_sql(event_type: str) -> str:
    first = f"min(event_id) FILTER (WHERE event_type = '{event_type}' AND home NOT IN ('', '0'))"
    last = f"max(event_id) FILTER (WHERE event_type = '{event_type}')"
    return f"coalesce({first}, {last}) AS k_{event_type}"


@query(
    "rel_long_to_wide",
    f"""
    WITH e AS (
        SELECT event_id, user_id, event_type,
               CASE WHEN value < 5 THEN '' WHEN value < 30 THEN '0' ELSE CAST(CAST(floor(value) AS INT) AS VARCHAR) END AS home,
               CAST(event_id AS VARCHAR) AS away
        FROM events
    ),
    k AS (SELECT user_id, {', '.join(_kept_sql(t) for t in EVENT_TYPES)} FROM e GROUP BY user_id)
    SELECT k.user_id, {', '.join(f'e_{t}.home AS home_{t}, e_{t}.away AS away_{t}' for t in EVENT_TYPES)}
    FROM k {' '.join(f'LEFT JOIN e e_{t} ON e_{t}.event_id = k_{t}' for t in EVENT_TYPES)}
    """,
)
def rel_long_to_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value")
    home = F.when(value < 5, "").when(value < 30, "0").otherwise(F.floor(value).cast("int").cast("string"))
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", home.alias("home"))
    return reshape.long_to_wide(
        events, ["user_id"], "event_type", F.col("event_id"), F.col("home"), F.col("event_id").cast("string"), EVENT_TYPES
    )


@query(
    "rel_new_files",
    "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels ORDER BY doc_id",
)
def rel_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.new_files(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")


@query(
    "rel_team_rows",
    f"""
    WITH m AS ({MATCHES_SQL})
    SELECT match_key AS match_id, 'home' AS side, 'team_' || home_key AS team, 'team_' || away_key AS opponent,
           CAST(home_goals AS INT) AS goals_for, CAST(away_goals AS INT) AS goals_against FROM m
    UNION ALL
    SELECT match_key, 'away', 'team_' || away_key, 'team_' || home_key, CAST(away_goals AS INT), CAST(home_goals AS INT)
    FROM m
    """,
)
def rel_team_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    sides = {
        "team": ("home_team", "away_team"),
        "opponent": ("away_team", "home_team"),
        "goals_for": ("home_goals", "away_goals"),
        "goals_against": ("away_goals", "home_goals"),
    }
    return reshape.team_rows(order_matches(spark, sf_dir), ["match_id"], sides)


@query(
    "sink_combined",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS match_id, CAST(o_custkey AS VARCHAR) AS league_division,
           CASE WHEN o_orderstatus = 'F' THEN '2024-2025' ELSE 'unknown' END AS season, o_orderpriority AS round,
           CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey % 9 AS INT) END AS home_goals
    FROM orders
    """,
)
def sink_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Season files with different headers united by column name, with the season, written and read again."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("match_id"),
        F.col("o_custkey").cast("string").alias("league_division"),
        F.col("o_orderpriority").alias("round"),
        (F.col("o_custkey") % 9).cast("string").alias("home_goals"),
        "o_orderstatus",
    )
    folder = new_folder(spark, "seasons")
    finished = F.col("o_orderstatus") == "F"
    parts = {
        "cup_2024-2025": orders.where(finished).select("match_id", "home_goals", "round", "league_division"),
        "cup_none": orders.where(~finished).select("match_id", "league_division", "round"),
    }
    for stem, part in parts.items():
        sinks.write_season_files(part.withColumn("stem", F.lit(stem)), folder)
    united = combined(spark, folder, add_season=True).select("match_id", "league_division", "season", "round", "home_goals")
    target = new_folder(spark, "combined")
    sinks.write_combined(united, target, folder)
    return spark.read.parquet(target)
