"""Link collection: the league catalog and its fetched pages give one sorted list of match URLs per season."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline import fixed_values as fv
from touchline.functions.names import list_stem
from touchline.operators.links import match_links, season_pages


def match_lists(
    catalog: DataFrame, pages: DataFrame, host: str, domain: str, as_of: Column, previous: str = fv.PREVIOUS_SEASON
) -> DataFrame:
    """(``stem``, ``url``): the match links of every season page of the catalog, once per list.

    ``pages`` holds url and html of archive and results pages. A long page may come in several rows, with a number
    ``part`` from 0; the first part tells the seasons, and each part's links count. A season whose page is absent has no
    links. The result is what ``write_links`` sorts and writes.
    """
    heads = pages.where(F.col("part") == 0).drop("part") if "part" in pages.columns else pages
    seasons = season_pages(catalog, heads, host, as_of, previous).select(
        list_stem(F.col("file_name")).alias("stem"), F.col("url").alias("page_url")
    )
    listed = pages.select(F.col("url").alias("page_url"), "html").join(seasons, "page_url").select("stem", "html")
    return match_links(listed, host, domain).select("stem", "url").distinct()
