"""File names and stems. A stem, ``<prefix><key>_<season>``, joins list, data and log files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline import fixed_values as fv
from touchline.functions.dates import season_of
from touchline.functions.text import first_match, quoted


def list_name(prefix: Column, key: Column, season: Column) -> Column:
    return F.concat(prefix, key, F.lit("_"), season, F.lit(".txt"))


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def shown_name(path: Column) -> Column:
    """The name that tells what a file is: its own, or its folder's if Spark named the file.

    A folder ``stem=x`` counts as ``x``. Names come decoded, as paths of files that were read are encoded.
    """
    own = F.substring_index(path, "/", -1)
    folder = F.regexp_replace(F.substring_index(F.substring_index(path, "/", -2), "/", 1), "^[^=]*=", "")
    name = F.when(own.rlike("^part-[0-9]{5,}-"), folder).otherwise(own)
    return F.coalesce(F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), name)


def list_name_from_url(url: Column, host: str, as_of: Column) -> Column:
    """List file name of a results page.

    The first path segment that is, or ends in, a season gives the season; the last two other
    segments give prefix and key. Without a season the one of ``as_of`` is used.
    """
    segments = F.filter(
        F.split(F.rtrim(url, F.lit("/")), "/"), lambda p: ~p.isin("", "https:", host, "results")
    )
    is_season = lambda p: p.rlike(r"^\d{4}-\d{4}$")
    has_season = lambda p: is_season(p) | p.rlike(r"-\d{4}$")
    at = F.array_position(F.transform(segments, has_season), F.lit(True))
    bearer = F.try_element_at(segments, at.cast("int"))
    season = F.when(is_season(bearer), bearer).otherwise(
        F.regexp_extract(bearer, r"-(\d{4}-\d{4}|\d{4})$", 1)
    )
    names = F.filter(
        F.transform(
            segments,
            lambda p, i: F.when(i + 1 != at, p).when(
                ~is_season(p), F.regexp_replace(p, r"-(?:\d{4}-\d{4}|\d{4})$", "")
            ),
        ),
        lambda p: p.isNotNull(),
    )
    underscored = F.transform(names, lambda p: F.replace(p, F.lit("-"), F.lit("_")))
    key = F.coalesce(F.get(underscored, F.size(underscored) - 1), F.lit("unknown"))
    prefix = F.coalesce(
        F.concat(F.get(underscored, F.size(underscored) - 2), F.lit("_")), F.lit("")
    )
    return list_name(prefix, key, F.when(at > 0, season).otherwise(season_of(as_of)))


def season_from_name(name: Column) -> Column:
    """First ``YYYY`` or ``YYYY-YYYY`` in a file name, else ``unknown``."""
    return F.coalesce(first_match(name, r"(?U)(\d{4}(?:-\d{4})?)"), F.lit("unknown"))


def season_label(text: Column) -> Column:
    """First ``YYYY-YYYY`` or ``YYYY/YYYY`` in a text, with a dash; NULL without one."""
    return F.replace(first_match(text, r"(?U)(\d{4}[-/]\d{4})"), F.lit("/"), F.lit("-"))


def log_stem(path: Column) -> Column:
    return F.regexp_replace(base_name(path), r"(?i)_(scrape|retry)_log.*\.csv$", "")


def list_stem(path: Column) -> Column:
    """File name without its last extension, and without the number of a part before it."""
    return F.regexp_replace(base_name(path), r"(?<=[^.])(\.part-\d+)?\.[^.]*$", "")


def data_stem(name: Column) -> Column:
    """Name of a match file without its suffix and number, or the name as it is."""
    ending = fv.DATA_SUFFIX.removesuffix(".csv")
    return F.regexp_replace(name, rf"({quoted(ending)})?(\.part-\d+)?\.csv$", "")


def data_path(stem: Column, folder: str = "scraped_data") -> Column:
    return F.concat(F.lit(f"{folder}/"), stem, F.lit(fv.DATA_SUFFIX))


def log_path(stem: Column, folder: str = "scraped_logs") -> Column:
    return F.concat(F.lit(f"{folder}/"), stem, F.lit(fv.LOG_SUFFIX))
