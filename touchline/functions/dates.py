"""Seasons and match dates. The current day is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline import fixed_values as fv
from touchline.functions.text import first_match


def season_of(day: Column, first_month: int = fv.SEASON_FIRST_MONTH) -> Column:
    """``Y-(Y+1)`` from ``first_month`` on, else ``(Y-1)-Y``."""
    start = F.year(day) - F.when(F.month(day) >= first_month, 0).otherwise(1)
    return F.concat_ws("-", start.cast("string"), (start + 1).cast("string"))


def match_season(url: Column, match_date: Column, as_of: Column) -> Column:
    """Season in the URL, else of the match date (``dd/mm/yyyy`` or ``yyyy-mm-dd`` in text), else of ``as_of``."""
    slashed = r"(?U)(\d{2})/(\d{2})/(\d{4})"
    dashed = r"(?U)(\d{4})-(\d{2})-(\d{2})"

    def season(year: Column, month: Column) -> Column:
        y, m = year.try_cast("int"), month.try_cast("int")
        start = y - F.when(m.between(fv.MATCH_SEASON_FIRST_MONTH, 12), 0).otherwise(1)
        return F.when(y.isNotNull(), F.concat_ws("-", start.cast("string"), (start + 1).cast("string")))

    return F.coalesce(
        first_match(url, r"(?U)(\d{4}-\d{4})"),
        season(first_match(match_date, slashed, 3), first_match(match_date, slashed, 2)),
        season(first_match(match_date, dashed, 1), first_match(match_date, dashed, 2)),
        season_of(as_of, fv.MATCH_SEASON_FIRST_MONTH),
    )


def kickoff_ts(date: Column, kickoff_time: Column) -> Column:
    """Date text and time text as one timestamp; midnight when only the date can be read."""
    day = F.coalesce(*[F.try_to_date(date, day_format) for day_format in fv.DATE_FORMATS])
    part = lambda group: first_match(kickoff_time, fv.KICKOFF_TIME_PATTERN, group)
    hour, minute, half = part(1).try_cast("int"), part(2).try_cast("int"), F.lower(part(3))
    hour = F.when(half == "pm", hour % 12 + 12).when(half == "am", hour % 12).otherwise(hour)
    stamp = lambda h, m: F.try_make_timestamp_ntz(F.year(day), F.month(day), F.day(day), h, m, F.lit(0))
    return F.coalesce(stamp(hour, minute), stamp(F.lit(0), F.lit(0)))
