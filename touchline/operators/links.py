"""Match links of listing pages, and season links of archive pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline import fixed_values as fv
from touchline.functions.dates import season_of
from touchline.functions.names import list_name, season_label
from touchline.functions.urls import (
    absolute_url,
    is_strict_match_url,
    linked_results_url,
    results_url,
    season_results_url,
)
from touchline.operators.elements import (
    Test,
    both,
    first,
    inside,
    joined_text,
    page_nodes,
    select,
    select_inside,
    with_attr,
    with_class,
    with_tag,
)

LINK = both(with_tag("a"), with_attr("href"))
MATCH_ROW = both(with_tag("div"), with_class(fv.MATCH_ROW_CLASS))


def links_inside(pages: DataFrame, container: Test, host: str, domain: str) -> DataFrame:
    """Distinct absolute links inside the containers of each page; all other page columns are kept.

    A narrow job: a page is one row, so its repeats are dropped without a shuffle.
    """
    kept = [c for c in pages.columns if c != "html"]
    hits = select_inside(F.col("nodes"), container, LINK)
    found = F.transform(hits, lambda a: absolute_url(a["attrs"]["href"], host, domain))
    links = page_nodes(pages).select(*kept, F.explode(F.array_distinct(found)).alias("url"))
    return links.where(F.col("url") != "")


def match_links(pages: DataFrame, host: str, domain: str) -> DataFrame:
    """Distinct match URLs inside the match rows of each listing page."""
    return links_inside(pages, MATCH_ROW, host, domain).where(is_strict_match_url(F.col("url")))


def archive_seasons(
    archives: DataFrame, host: str, as_of: Column, previous: str = fv.PREVIOUS_SEASON
) -> DataFrame:
    """``current_season`` and ``previous_url`` of each archive page.

    The current season is that of the first link whose text starts with one, else that of ``as_of``.
    The previous season's page is the first link with the season in text or href, else it is built
    from the archive URL.
    """
    kept = [c for c in archives.columns if c != "html"]
    nodes = F.col("nodes")
    links = F.transform(
        select(nodes, LINK),
        lambda a: F.struct(joined_text(inside(nodes, a), "").alias("text"), a["attrs"]["href"].alias("href")),
    )
    found = page_nodes(archives).select(*kept, links.alias("links"))
    dated = first(F.filter("links", lambda a: a["text"].rlike(r"(?U)^\d{4}[-/]\d{4}")))
    older = first(F.filter("links", lambda a: a["text"].contains(previous) | a["href"].contains(previous)))
    return found.select(
        *kept,
        F.coalesce(F.replace(dated["text"], F.lit("/"), F.lit("-")), season_of(as_of)).alias("current_season"),
        F.coalesce(
            linked_results_url(older["href"], host), season_results_url(F.col("archive_url"), F.lit(previous))
        ).alias("previous_url"),
    )


def results_season(pages: DataFrame) -> DataFrame:
    """``current_season`` of a competition that has only a results page: first season text, else ``current``."""
    kept = [c for c in pages.columns if c != "html"]
    texts = F.filter(F.col("nodes"), lambda n: n["tag"].startswith("#") & n["text"].rlike(r"(?U)\d{4}[-/]\d{4}"))
    label = season_label(first(texts)["text"])
    return page_nodes(pages).select(*kept, F.coalesce(label, F.lit("current")).alias("current_season"))


def season_pages(
    leagues: DataFrame, pages: DataFrame, host: str, as_of: Column, previous: str = fv.PREVIOUS_SEASON
) -> DataFrame:
    """Seasons to load per league: prefix, key, season, results URL and list file name.

    A league with an archive gives its current season, and the previous one if that differs. A
    league with only a results page gives one row. Leagues whose page is absent use ``as_of``. The
    page table is filtered to the listed pages first, so no other page is moved.
    """
    listing = F.coalesce("archive_url", "results_url").alias("url")
    listed = pages.join(leagues.select(listing), "url", "left_semi").select("url", "html")
    with_archive = leagues.where(F.col("results_url").isNull())
    archives = with_archive.join(
        listed.withColumnRenamed("url", "archive_url"), "archive_url", "left"
    ).select("prefix", "key", "archive_url", "html")
    seasons = archive_seasons(archives, host, as_of, previous).select(
        "prefix",
        "key",
        F.explode(
            F.filter(
                F.array(
                    F.struct(
                        F.col("current_season").alias("season"), results_url(F.col("archive_url")).alias("url")
                    ),
                    F.when(
                        F.col("current_season") != previous,
                        F.struct(F.lit(previous).alias("season"), F.col("previous_url").alias("url")),
                    ),
                ),
                lambda s: s.isNotNull(),
            )
        ).alias("s"),
    ).select("prefix", "key", "s.season", "s.url")
    results_only = leagues.where(F.col("results_url").isNotNull()).join(
        listed.withColumnRenamed("url", "results_url"), "results_url", "left"
    )
    single = results_season(results_only.select("prefix", "key", "results_url", "html")).select(
        "prefix", "key", F.col("current_season").alias("season"), F.col("results_url").alias("url")
    )
    return seasons.unionByName(single).withColumn(
        "file_name", list_name(F.col("prefix"), F.col("key"), F.col("season"))
    )
