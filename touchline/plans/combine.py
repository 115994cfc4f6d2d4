"""Season files united into one table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.names import data_stem, season_from_name
from touchline.operators.reshape import insert_column
from touchline.sources.tables import read_matches


def combined(
    spark: SparkSession, folder: str | Sequence[str], add_season: bool = False, keep_empty: bool = True
) -> DataFrame:
    """All match files of a folder, or of several, under one typed schema; ``season`` comes from the file's name, or from its folder's if Spark named the file.

    Columns that only some files have follow. Rows without a match id stay unless ``keep_empty`` is off.
    """
    rows = read_matches(spark, folder, keep_empty)
    if add_season:
        rows = insert_column(rows, "season", season_from_name(data_stem(F.col("file_name"))))
    return rows.drop("file_name", "kickoff_ts")
