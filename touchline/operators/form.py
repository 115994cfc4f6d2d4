"""Form of both teams before each match."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.operators.keys import first_per_key, rolling_last
from touchline.operators.reshape import team_rows

LAST_MATCHES = 5


def points(goals_for: Column, goals_against: Column) -> Column:
    return F.when(goals_for > goals_against, 3).when(goals_for == goals_against, 1).when(
        goals_for < goals_against, 0
    )


def each_match(matches: DataFrame, match_id: str, kickoff: str, own: str) -> DataFrame:
    """Every match once, and a column that tells matches without id apart: their values, and a number for equal ones.

    Equal rows are counted in the tasks they lie in before they are shuffled, as are rows of equal id.
    """
    values = [c for c in matches.columns if c not in (match_id, kickoff)]
    named = F.coalesce(F.col(match_id).cast("string"), F.lit("")) != ""
    once = first_per_key(
        matches.where(named), [match_id], [F.col(kickoff).isNull(), F.col(kickoff), *[F.col(c) for c in values]]
    )
    nameless = matches.where(~named).groupBy(*matches.columns).agg(F.count(F.lit(1)).alias("_n"))
    numbered = nameless.select(*matches.columns, F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))).alias("_copy"))
    identity = F.struct(*values, "_copy")
    apart = numbered.select(*matches.columns, identity.alias(own))
    kind = apart.schema[own].dataType
    return once.withColumn(own, F.lit(None).cast(kind)).unionByName(apart)


def form_features(
    matches: DataFrame,
    measures: Sequence[str] = ("xg", "shots_total"),
    band_unit: str = "month",
    last: int = LAST_MATCHES,
    kept: Sequence[str] = ("result",),
) -> DataFrame:
    """Per match, the means of each team's previous matches: points, goals for and against, ``measures``.

    Needs match_id, kickoff_ts, home_team, away_team, home_goals, away_goals and the home and away
    column of each measure. Nothing of the match itself, or of later matches, enters. ``form_matches``
    says over how many matches the means go; a team's first match has 0 and NULL means.

    A match that is stored more than once counts once: the row with the earliest known kickoff, and of
    equal ones the one with the smallest values, column by column. Rows without an id (NULL or blank) are
    matches of their own, each of them. Without a known kickoff a match has no place in time: it has 0 and
    NULL means, and is part of no other match's form. Matches of a team at the same time go by id, those
    without one first, by their values.

    A team's history is cut into ``band_unit`` bands, each its own group, so that one team with very
    many matches is spread over tasks; the last matches before a band are carried into it. Choose the
    unit so that one team's matches in one unit fit a task.
    """
    sides = {
        "team": ("home_team", "away_team"),
        "goals_for": ("home_goals", "away_goals"),
        "goals_against": ("away_goals", "home_goals"),
        **{m: (f"home_{m}", f"away_{m}") for m in measures},
    }
    match = ["match_id", "kickoff_ts", "home_team", "away_team", *kept]
    used = list(dict.fromkeys([*match, *[c for pair in sides.values() for c in pair]]))
    once = each_match(matches.select(*used), "match_id", "kickoff_ts", "_own")
    match = [*match, "_own"]
    rows = team_rows(once, match, sides).withColumn("points", points(F.col("goals_for"), F.col("goals_against")))
    averaged = ["points", "goals_for", "goals_against", *measures]
    features = {f"form_{c}": F.avg(c) for c in averaged}
    features["form_matches"] = F.count(F.lit(1))
    known = rows.where(F.col("kickoff_ts").isNotNull())
    rolled = rolling_last(
        known, ["team"], ["kickoff_ts", "match_id", "_own"], last, features, F.date_trunc(band_unit, F.col("kickoff_ts"))
    )
    timeless = rows.where(F.col("kickoff_ts").isNull()).select(
        *rows.columns,
        *[F.lit(0 if c == "form_matches" else None).cast(rolled.schema[c].dataType).alias(c) for c in features],
    )
    # a match has one row of each side; numbers (unlike structs) are aggregated by hash, without sorting all rows
    of_side = lambda side, c: F.max(F.when(F.col("side") == side, F.col(c))).alias(f"{side}_{c}")
    wide = rolled.unionByName(timeless).groupBy(*match).agg(*[of_side(s, c) for c in features for s in ("home", "away")])
    return wide.drop("_own")
