"""Registered queries: each runs an operator over the given tables, with the same result in plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.session import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query function (spark, sf_dir) under a name, with its SQL check if there is one."""

    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Matches made from orders: two of 200 teams, a result and some statistics. Both engines start from
# the same SQL text; it holds plain arithmetic only.
TEAMS = 200
MATCH_COLUMNS_SQL = """
    o_orderkey AS match_key,
    o_orderdate AS day,
    o_custkey % 200 AS home_key,
    (o_orderkey * 7 + 3) % 200 AS away_key,
    CAST(floor(o_totalprice) AS BIGINT) % 5 AS home_goals,
    o_orderkey % 4 AS away_goals,
    CAST(floor(o_totalprice) AS BIGINT) % 300 AS home_xg_hundredths,
    (o_orderkey * 13) % 300 AS away_xg_hundredths,
    CAST(floor(o_totalprice) AS BIGINT) % 23 AS home_shots,
    (o_orderkey * 3) % 17 AS away_shots
"""
MATCHES_SQL = f"SELECT * FROM (SELECT {MATCH_COLUMNS_SQL} FROM orders) AS m WHERE home_key <> away_key"


def order_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed match rows made from orders, one per order whose two teams differ."""
    columns = [c.strip() for c in MATCH_COLUMNS_SQL.strip().split(",\n")]
    raw = table(spark, sf_dir, "orders").selectExpr(*columns).where("home_key <> away_key")
    hundredths = lambda name: (F.col(name) / 100).cast("decimal(6,2)")
    return raw.select(
        F.col("match_key").alias("match_id"),
        F.col("day").cast("timestamp_ntz").alias("kickoff_ts"),
        F.concat(F.lit("team_"), F.col("home_key").cast("string")).alias("home_team"),
        F.concat(F.lit("team_"), F.col("away_key").cast("string")).alias("away_team"),
        F.col("home_goals").cast("int").alias("home_goals"),
        F.col("away_goals").cast("int").alias("away_goals"),
        F.when(F.col("home_goals") > F.col("away_goals"), "H")
        .when(F.col("home_goals") < F.col("away_goals"), "A")
        .otherwise("D")
        .alias("result"),
        hundredths("home_xg_hundredths").alias("home_xg"),
        hundredths("away_xg_hundredths").alias("away_xg"),
        F.col("home_shots").cast("int").alias("home_shots_total"),
        F.col("away_shots").cast("int").alias("away_shots_total"),
    )
