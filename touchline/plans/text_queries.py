"""Queries on column functions: URLs, names, dates and numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions import dates, names, numbers, urls
from touchline.operators.summary import league_round
from touchline.plans.registry import query, table

AS_OF = "2026-03-15"
# A match-shaped URL for each page: the page's scheme, host and first two path segments.
SHAPED_SQL = r"""
    regexp_extract(url, '^(https?://[^/]+)/', 1) || '/game/'
    || regexp_extract(url, '^https?://[^/]+/([^/?#]+)', 1) || '/' || page_id || '-x/'
    || CASE WHEN page_id % 3 = 0 THEN '?mid=M' || page_id
            WHEN page_id % 3 = 1 THEN '?tab=1&mid=K' || page_id || 'z'
            ELSE 'more/?mid=a-' || page_id END
"""


def shaped_url() -> Column:
    """The same URL as in ``SHAPED_SQL``."""
    number = F.col("page_id").cast("string")
    kind = F.col("page_id") % 3
    ending = (
        F.when(kind == 0, F.concat(F.lit("?mid=M"), number))
        .when(kind == 1, F.concat(F.lit("?tab=1&mid=K"), number, F.lit("z")))
        .otherwise(F.concat(F.lit("more/?mid=a-"), number))
    )
    return F.concat(
        F.regexp_extract("url", r"^(https?://[^/]+)/", 1),
        F.lit("/game/"),
        F.regexp_extract("url", r"^https?://[^/]+/([^/?#]+)", 1),
        F.lit("/"),
        number,
        F.lit("-x/"),
        ending,
    )


def shaped_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", "url", shaped_url().alias("shaped"))


def _base_sql(url: str) -> str:
    path = f"split_part({url}, '?', 1)"
    game = f"regexp_extract({path}, '^(https?://[^/]+/game/[^/]+/[^/]+/)', 1)"
    return f"CASE WHEN {game} <> '' THEN {game} ELSE rtrim({path}, '/') || '/' END"


def _query_sql(url: str) -> str:
    return f"CASE WHEN strpos({url}, '?') > 0 THEN substr({url}, strpos({url}, '?')) ELSE '' END"


@query(
    "url_base_path",
    f"""
    WITH p AS (SELECT page_id, url, {SHAPED_SQL} AS shaped FROM pages)
    SELECT page_id, {_base_sql('url')} AS page_base, {_query_sql('url')} AS page_query,
           {_base_sql('shaped')} AS match_base, {_query_sql('shaped')} AS match_query,
           {_base_sql('shaped')} || 'summary/stats/overall/' || {_query_sql('shaped')} AS stats_url,
           {_base_sql('shaped')} || 'summary/lineups/' || {_query_sql('shaped')} AS lineups_url
    FROM p
    """,
)
def url_base_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    url, shaped = F.col("url"), F.col("shaped")
    return shaped_pages(spark, sf_dir).select(
        "page_id",
        urls.base_path(url).alias("page_base"),
        urls.query_string(url).alias("page_query"),
        urls.base_path(shaped).alias("match_base"),
        urls.query_string(shaped).alias("match_query"),
        urls.stats_url(shaped).alias("stats_url"),
        urls.lineups_url(shaped).alias("lineups_url"),
    )


@query(
    "url_query_id",
    f"""
    SELECT page_id, regexp_extract(url, '[?&]page=([A-Za-z0-9]+)', 1) AS page_number,
           regexp_extract({SHAPED_SQL}, '[?&]mid=([A-Za-z0-9]+)', 1) AS match_id
    FROM pages
    """,
)
def url_query_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaped_pages(spark, sf_dir).select(
        "page_id",
        urls.match_id(F.col("url"), "page").alias("page_number"),
        urls.match_id(F.col("shaped")).alias("match_id"),
    )


@query(
    "url_valid",
    f"""
    SELECT page_id,
           regexp_matches(upper(shaped), 'HTTPS?://[A-Z.]*EXAMPLE\\.COM/GAME/') AS upper_case_valid,
           regexp_matches(lower(shaped), 'https?://[a-z.]*example\\.com/game/') AS valid,
           regexp_matches(url, '^https?://[a-z.]*example\\.com/game/') AS page_valid,
           regexp_matches(shaped, '^https?://[^/]+/game/[^/]+/[^/]+/\\?mid=[A-Za-z0-9]+$') AS strictly_valid
    FROM (SELECT page_id, url, {SHAPED_SQL} AS shaped FROM pages)
    """,
)
def url_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    shaped, domain = F.col("shaped"), "example.com"
    return shaped_pages(spark, sf_dir).select(
        "page_id",
        urls.is_match_url(F.upper(shaped), domain).alias("upper_case_valid"),
        urls.is_match_url(shaped, domain).alias("valid"),
        urls.is_match_url(F.col("url"), domain).alias("page_valid"),
        urls.is_strict_match_url(shaped).alias("strictly_valid"),
    )


@query(
    "url_normalise",
    r"""
    WITH p AS (SELECT page_id, url, regexp_extract(url, '^https?://[^/]+(/.*)$', 1) AS path FROM pages)
    SELECT page_id, 'https://us.example.com' || path AS from_path,
           'https://us.example.com' || path AS from_www, 'https://us.example.com' || path AS from_bare,
           regexp_replace(url, '^https?://(www\.)?example\.com', 'https://us.example.com') AS from_page
    FROM p
    """,
)
def url_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.regexp_extract("url", r"^https?://[^/]+(/.*)$", 1)
    normal = lambda href: urls.absolute_url(href, "us.example.com", "example.com")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        normal(F.concat(F.lit("  "), path, F.lit("\n"))).alias("from_path"),
        normal(F.concat(F.lit("http://www.example.com"), path)).alias("from_www"),
        normal(F.concat(F.lit("https://example.com"), path)).alias("from_bare"),
        normal(F.col("url")).alias("from_page"),
    )


@query(
    "url_derive_name",
    r"""
    WITH p AS (
        SELECT page_id, regexp_extract(url, '^https?://([^/]+)/', 1) AS host,
               regexp_extract(url, '^https?://[^/]+/([^/?#]+)', 1) AS lang, 1990 + page_id % 30 AS y
        FROM pages
    )
    SELECT page_id, CASE page_id % 6
        WHEN 0 THEN replace(host, '-', '_') || '_' || lang || '_' || y || '-' || (y + 1)
        WHEN 1 THEN lang || '_cup_n' || page_id || '_' || y || '-' || (y + 1)
        WHEN 2 THEN lang || '_league_' || y
        WHEN 3 THEN lang || '_league_n' || page_id || '_2025-2026'
        WHEN 4 THEN lang || '_2025-2026'
        ELSE 'unknown_' || y || '-' || (y + 1) END || '.txt' AS file_name
    FROM p
    """,
)
def url_derive_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    site = F.lit("https://us.example.com/")
    lang = F.regexp_extract("url", r"^https?://[^/]+/([^/?#]+)", 1)
    host = F.regexp_extract("url", r"^https?://([^/]+)/", 1)
    number = F.col("page_id").cast("string")
    year = F.lit(1990) + F.col("page_id") % 30
    season = F.concat_ws("-", year.cast("string"), (year + 1).cast("string"))
    kind = F.col("page_id") % 6
    results = (
        F.when(kind == 0, F.concat(site, host, F.lit("/"), lang, F.lit("/"), season, F.lit("/results/")))
        .when(kind == 1, F.concat(site, lang, F.lit("/cup-n"), number, F.lit("-"), season, F.lit("/results/")))
        .when(kind == 2, F.concat(site, lang, F.lit("/league-"), year.cast("string"), F.lit("/results")))
        .when(kind == 3, F.concat(site, lang, F.lit("/league-n"), number, F.lit("/")))
        .when(kind == 4, F.concat(site, lang))
        .otherwise(F.concat(site, season, F.lit("/results/")))
    )
    as_of = F.lit(AS_OF).cast("date")
    return table(spark, sf_dir, "pages").select(
        "page_id", names.list_name_from_url(results, "us.example.com", as_of).alias("file_name")
    )


@query(
    "name_season",
    """
    WITH n AS (
        SELECT o_orderkey, year(o_orderdate) AS y, CASE o_orderkey % 4
            WHEN 0 THEN 'x_cup_' || year(o_orderdate) || '-' || (year(o_orderdate) + 1) || '_match_data.csv'
            WHEN 1 THEN 'x_' || year(o_orderdate) || '_match_data.csv'
            WHEN 2 THEN 'league ' || year(o_orderdate) || '/' || (year(o_orderdate) + 1) || ' table'
            ELSE 'no_digits_at_all.csv' END AS name
        FROM orders
    )
    SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN y || '-' || (y + 1) WHEN 1 THEN '' || y
               WHEN 2 THEN '' || y ELSE 'unknown' END AS season,
           CASE WHEN o_orderkey % 4 IN (0, 2) THEN y || '-' || (y + 1) END AS label
    FROM n
    """,
)
def name_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    year = F.year("o_orderdate")
    this, following = year.cast("string"), (year + 1).cast("string")
    kind = F.col("o_orderkey") % 4
    name = (
        F.when(kind == 0, F.concat(F.lit("x_cup_"), this, F.lit("-"), following, F.lit("_match_data.csv")))
        .when(kind == 1, F.concat(F.lit("x_"), this, F.lit("_match_data.csv")))
        .when(kind == 2, F.concat(F.lit("league "), this, F.lit("/"), following, F.lit(" table")))
        .otherwise(F.lit("no_digits_at_all.csv"))
    )
    named = table(spark, sf_dir, "orders").select("o_orderkey", name.alias("name"))
    return named.select(
        "o_orderkey",
        names.season_from_name(F.col("name")).alias("season"),
        names.season_label(F.col("name")).alias("label"),
    )


@query(
    "name_stem",
    """
    WITH s AS (SELECT o_orderkey, lower(o_orderstatus) || '_cup_' || year(o_orderdate) || '.b' || o_custkey AS stem FROM orders)
    SELECT o_orderkey, stem AS log_stem, 'scraped_data/' || stem || '_match_data.csv' AS data_path, stem AS list_stem,
           'scraped_logs/' || stem || '_scrape_log.csv' AS log_path
    FROM s
    """,
)
def name_stem(spark: SparkSession, sf_dir: str) -> DataFrame:
    stem = F.concat(
        F.lower("o_orderstatus"),
        F.lit("_cup_"),
        F.year("o_orderdate").cast("string"),
        F.lit(".b"),
        F.col("o_custkey").cast("string"),
    )
    suffix = F.when(F.col("o_orderkey") % 2 == 0, "_scrape_log.csv").otherwise("_RETRY_LOG_2.CSV")
    made = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        names.log_stem(F.concat(F.lit("/data/logs/"), stem, suffix)).alias("log_stem"),
        names.list_stem(F.concat(F.lit("/data/links/"), stem, F.lit(".txt"))).alias("list_stem"),
    )
    return made.select(
        "o_orderkey",
        "log_stem",
        names.data_path(F.col("log_stem")).alias("data_path"),
        "list_stem",
        names.log_path(F.col("list_stem")).alias("log_path"),
    )


def _season_sql(day: str, first_month: int) -> str:
    start = f"(year({day}) - CASE WHEN month({day}) >= {first_month} THEN 0 ELSE 1 END)"
    return f"{start} || '-' || ({start} + 1)"


@query(
    "date_season",
    f"""
    SELECT o_orderkey, {_season_sql('o_orderdate', 7)} AS season,
           CASE o_orderkey % 4 WHEN 0 THEN '2001-2002' WHEN 3 THEN '2025-2026'
                ELSE {_season_sql('o_orderdate', 8)} END AS match_season
    FROM orders
    """,
)
def date_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("o_orderkey") % 4
    url = F.when(kind == 0, F.lit("https://us.example.com/x/cup-2001-2002/?mid=1")).otherwise(
        F.lit("https://us.example.com/x/cup/?mid=1")
    )
    text = F.when(kind == 1, F.date_format("o_orderdate", "dd/MM/yyyy")).when(
        kind.isin(0, 2), F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        dates.season_of(F.col("o_orderdate")).alias("season"),
        dates.match_season(url, text, F.lit(AS_OF).cast("date")).alias("match_season"),
    )


@query(
    "num_result_code",
    """
    SELECT l_orderkey, l_linenumber, l_quantity,
           CASE WHEN l_quantity > l_linenumber * 8 THEN 'H' WHEN l_quantity < l_linenumber * 8 THEN 'A' ELSE 'D' END
               AS result,
           CASE WHEN l_linenumber = 7 THEN '' WHEN l_quantity > 25 THEN 'H' WHEN l_quantity < 25 THEN 'A' ELSE 'D' END
               AS result_with_blanks
    FROM lineitem
    """,
)
def num_result_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.col("l_quantity").cast("int").cast("string")
    spaced = F.when(F.col("l_linenumber") == 7, F.lit("n/a")).otherwise(F.concat(F.lit(" "), whole))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        numbers.result_code(whole, F.col("l_linenumber") * 8).alias("result"),
        numbers.result_code(spaced, F.lit("25")).alias("result_with_blanks"),
    )


LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query(
    "num_clean",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CAST(CAST(l_quantity AS INT) AS VARCHAR) || CAST(l_suppkey AS VARCHAR) || CAST(l_partkey AS VARCHAR) AS digits
    FROM lineitem
    """,
)
def num_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = F.col("l_quantity").cast("int").cast("string")
    text = F.concat(
        F.lit("Attendance: "), quantity, F.lit(" "), F.col("l_suppkey").cast("string"), F.lit(",."),
        F.col("l_partkey").cast("string"), F.lit(" é"),
    )
    return table(spark, sf_dir, "lineitem").select(*LINE_KEY, numbers.clean_number(text).alias("digits"))


@query(
    "num_parse_value",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CASE WHEN l_linenumber = 1 THEN 'n/a'
                ELSE '-' || CAST(l_partkey AS VARCHAR) || '.' || lpad(CAST(CAST(l_quantity AS INT) AS VARCHAR), 2, '0')
           END AS signed_value,
           CAST(CAST(l_quantity AS INT) AS VARCHAR) AS percentage
    FROM lineitem
    """,
)
def num_parse_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = F.col("l_quantity").cast("int").cast("string")
    signed = F.when(F.col("l_linenumber") == 1, F.lit(" n/a ")).otherwise(
        F.concat(F.lit("xG: -"), F.col("l_partkey").cast("string"), F.lit("."), F.lpad(quantity, 2, "0"), F.lit(" exp"))
    )
    percent = F.concat(F.lit("\t"), quantity, F.lit(" % "))
    return table(spark, sf_dir, "lineitem").select(
        *LINE_KEY,
        numbers.parse_value(signed, signed=True).alias("signed_value"),
        numbers.parse_value(percent, signed=False).alias("percentage"),
    )


@query(
    "num_pct_count",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CASE WHEN l_linenumber <= 3 THEN CAST(CAST(l_quantity AS INT) AS VARCHAR) ELSE '' END AS pct,
           CASE WHEN l_linenumber <= 2 THEN CAST(l_suppkey AS VARCHAR) ELSE '' END AS successful,
           CASE WHEN l_linenumber <= 2 THEN CAST(l_partkey AS VARCHAR) ELSE '' END AS total
    FROM lineitem
    """,
)
def num_pct_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = F.col("l_quantity").cast("int").cast("string")
    counts = F.concat(
        F.lit(" ("), F.col("l_suppkey").cast("string"), F.lit("/"), F.col("l_partkey").cast("string"), F.lit(")")
    )
    line = F.col("l_linenumber")
    text = (
        F.when(line == 1, F.concat(quantity, F.lit("%"), counts))
        .when(line == 2, F.concat(quantity, counts))
        .when(line == 3, F.concat(quantity, F.lit(" %")))
        .when(line == 4, quantity)
        .otherwise(F.lit(""))
    )
    return (
        table(spark, sf_dir, "lineitem")
        .select(*LINE_KEY, numbers.pct_count(text).alias("p"))
        .select(*LINE_KEY, "p.pct", "p.successful", "p.total")
    )


@query(
    "num_non_empty",
    """
    SELECT doc_id,
           CASE WHEN text IS NULL OR text = '' THEN 0 ELSE 1 END + CASE WHEN lang = 'en' THEN 0 ELSE 1 END
           + CASE WHEN source IS NULL OR source = '' THEN 0 ELSE 1 END + CASE WHEN n_chars > 500 THEN 1 ELSE 0 END
               AS non_empty_fields
    FROM documents
    """,
)
def num_non_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    blanked = table(spark, sf_dir, "documents").select(
        "doc_id",
        "text",
        F.when(F.col("lang") != "en", F.col("lang")).otherwise(F.lit("")).alias("lang"),
        "source",
        F.when(F.col("n_chars") > 500, F.col("n_chars").cast("string")).alias("n_chars"),
    )
    return blanked.select("doc_id", numbers.non_empty(["text", "lang", "source", "n_chars"]).alias("non_empty_fields"))


@query(
    "num_duration",
    """
    SELECT event_id, CASE WHEN s < 60 THEN printf('%.1f', s) || 's'
        WHEN CAST(floor(s) AS BIGINT) < 3600 THEN (CAST(floor(s) AS BIGINT) // 60) || 'm ' || (CAST(floor(s) AS BIGINT) % 60) || 's'
        ELSE (CAST(floor(s) AS BIGINT) // 3600) || 'h ' || (CAST(floor(s) AS BIGINT) % 3600 // 60) || 'm '
             || (CAST(floor(s) AS BIGINT) % 60) || 's' END AS duration
    FROM (SELECT event_id, CASE WHEN event_type = 'view' THEN value * 60 ELSE value END AS s FROM events)
    """,
)
def num_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.when(F.col("event_type") == "view", F.col("value") * 60).otherwise(F.col("value"))
    return table(spark, sf_dir, "events").select("event_id", numbers.duration_text(seconds).alias("duration"))


@query(
    "html_league_round",
    """
    WITH t AS (
        SELECT p_partkey, p_name AS league, p_size,
               CASE p_partkey % 8 WHEN 4 THEN '1/8-finals' WHEN 5 THEN 'Third place' WHEN 6 THEN 'Final' END AS stage
        FROM part
    )
    SELECT p_partkey, league AS league_division,
           CASE WHEN p_partkey % 8 IN (0, 1, 2, 3) THEN CAST(p_size AS VARCHAR)
                WHEN stage IS NOT NULL THEN stage ELSE '' END AS round
    FROM t
    """,
)
def html_league_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    league, size = F.col("p_name"), F.col("p_size").cast("string")
    kind = F.col("p_partkey") % 8
    text = (
        F.when(kind == 0, F.concat(league, F.lit(" - Round "), size))
        .when(kind == 1, F.concat(league, F.lit(" – matchday "), size, F.lit(" of 60")))
        .when(kind == 2, F.concat(league, F.lit(" "), size))
        .when(kind == 3, F.concat(league, F.lit("·JOURNÉE "), size))
        .when(kind == 4, F.concat(league, F.lit(" - Play Offs - 1/8-finals")))
        .when(kind == 5, F.concat(league, F.lit(" - Play Offs - Third Place")))
        .when(kind == 6, F.concat(league, F.lit("-1/32-finals")))
        .otherwise(league)
    )
    return (
        table(spark, sf_dir, "part")
        .select("p_partkey", league_round(text).alias("r"))
        .select("p_partkey", "r.league_division", "r.round")
    )
