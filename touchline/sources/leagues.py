"""League catalog: a small fixed table, one row per competition."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline import schemas
from touchline.fixed_values import LEAGUES


def leagues(spark: SparkSession, host: str) -> DataFrame:
    """The catalog with listing URLs on the given host."""
    rows = []
    for key, prefix, country, competition, listing in LEAGUES:
        page = f"https://{host}/{country}/{competition}/{listing}/"
        archive, results = (page, None) if listing == "archive" else (None, page)
        rows.append((key, prefix, competition, archive, results))
    return spark.createDataFrame(rows, schemas.LEAGUE)


def containing(catalog: DataFrame, column: str, needle: str) -> DataFrame:
    """Rows whose column contains the text, in any letter case."""
    return catalog.where(F.lower(F.col(column)).contains(needle.lower()))
