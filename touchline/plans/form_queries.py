"""Queries on team form and outcome models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.operators import models
from touchline.operators.form import form_features
from touchline.plans.registry import MATCHES_SQL, order_matches, query, table

FORM = ["points", "goals_for", "goals_against", "xg", "shots_total"]


# Some matches have no kickoff, some no id, and some are stored again, a day later and with a goal more.
FORM_MATCHES_SQL = f"""
    SELECT * EXCLUDE (n), match_key AS row_key, CASE WHEN match_key % 29 <> 0 THEN match_key END AS match_id FROM (
        SELECT *, row_number() OVER (PARTITION BY match_key ORDER BY day NULLS LAST, home_goals) AS n FROM (
            SELECT * REPLACE (CASE WHEN match_key % 41 <> 0 THEN day END AS day) FROM ({MATCHES_SQL})
            UNION ALL
            SELECT * REPLACE (CASE WHEN match_key % 5 <> 0 THEN CAST(day + INTERVAL 1 DAY AS TIMESTAMP) END AS day,
                              home_goals + 1 AS home_goals)
            FROM ({MATCHES_SQL}) WHERE match_key % 37 = 0 OR match_key % 82 = 0
        )
    ) WHERE n = 1 OR match_key % 29 = 0
"""


def form_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matches with faults: some without kickoff, some without id, some stored twice."""
    key, kickoff = F.col("match_id"), F.col("kickoff_ts")
    matches = order_matches(spark, sf_dir)
    again = matches.where((key % 37 == 0) | (key % 82 == 0)).withColumns({
        "kickoff_ts": F.when(key % 5 != 0, kickoff + F.expr("INTERVAL 1 DAY")),
        "home_goals": F.col("home_goals") + 1,
    })
    faulty = matches.withColumn("kickoff_ts", F.when(key % 41 != 0, kickoff)).unionByName(again)
    return faulty.withColumn("match_id", F.when(key % 29 != 0, key))


def _form_sql() -> str:
    averages = ", ".join(f"avg({c}) OVER w AS form_{c}" for c in FORM)
    nothing = ", ".join("NULL" for _ in FORM)
    picked = ", ".join(
        [f"round(CAST({side}.form_{c} AS DOUBLE), 4) AS {side}_form_{c}" for c in FORM for side in ("h", "a")]
        + [f"{side}.form_matches AS {side}_form_matches" for side in ("h", "a")]
    ).replace(" AS h_", " AS home_").replace(" AS a_", " AS away_")
    return f"""
    WITH m AS (
        SELECT *, row_key || '/' || home_goals AS row_id, [home_goals, away_goals, home_xg_hundredths, away_xg_hundredths, home_shots, away_shots] AS numbers,
               'team_' || home_key AS home, 'team_' || away_key AS away,
               CASE WHEN home_goals > away_goals THEN 'H' WHEN home_goals < away_goals THEN 'A' ELSE 'D' END AS shown
        FROM ({FORM_MATCHES_SQL})
    ),
    t AS (
        SELECT row_id, match_id, day, home, away, shown, numbers, 'home' AS side, home_key AS team, home_goals AS goals_for,
               away_goals AS goals_against, home_xg_hundredths / 100.0 AS xg, home_shots AS shots_total FROM m
        UNION ALL
        SELECT row_id, match_id, day, home, away, shown, numbers, 'away', away_key, away_goals, home_goals,
               away_xg_hundredths / 100.0, away_shots FROM m
    ),
    p AS (SELECT *, CASE WHEN goals_for > goals_against THEN 3 WHEN goals_for = goals_against THEN 1 ELSE 0 END AS points FROM t),
    f AS (
        SELECT row_id, match_id, day, side, team, {averages}, count(*) OVER w AS form_matches
        FROM p WHERE day IS NOT NULL
        WINDOW w AS (PARTITION BY team ORDER BY day, match_id NULLS FIRST, home, away, shown, numbers ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)
        UNION ALL SELECT row_id, match_id, day, side, team, {nothing}, 0 FROM p WHERE day IS NULL
    )
    SELECT h.match_id, strftime(h.day, '%Y-%m-%d') AS day, 'team_' || h.team AS home_team,
           'team_' || a.team AS away_team, {picked}
    FROM f h JOIN f a ON h.row_id = a.row_id WHERE h.side = 'home' AND a.side = 'away'
    """


@query("win_form_last5", _form_sql())
def win_form_last5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form of both teams before each match, over their previous five matches; some matches are faulty."""
    features = form_features(form_matches(spark, sf_dir))
    sides = ("home", "away")
    return features.select(
        "match_id",
        F.col("kickoff_ts").cast("date").cast("string").alias("day"),
        "home_team",
        "away_team",
        *[F.round(F.col(f"{s}_form_{c}").cast("double"), 4).alias(f"{s}_form_{c}") for c in FORM for s in sides],
        *[f"{s}_form_matches" for s in sides],
    )


@query(
    "ml_f1_per_class",
    f"""
    WITH m AS ({MATCHES_SQL}),
    p AS (
        SELECT CASE WHEN home_goals > away_goals THEN 'home_win' WHEN home_goals = away_goals THEN 'draw' ELSE 'away_win' END AS actual,
               CASE WHEN home_shots > away_shots THEN 'home_win' WHEN home_shots = away_shots THEN 'draw' ELSE 'away_win' END AS guess
        FROM m
    ),
    c AS (SELECT unnest(['home_win', 'draw', 'away_win', 'abandoned']) AS class),
    n AS (
        SELECT class, (SELECT count(*) FROM p WHERE actual = class AND guess = class) AS hits,
               (SELECT count(*) FROM p WHERE guess = class) AS predicted, (SELECT count(*) FROM p WHERE actual = class) AS support
        FROM c
    )
    SELECT class, support, round(CASE WHEN predicted > 0 THEN hits / predicted ELSE 0.0 END, 6) AS precision,
           round(CASE WHEN support > 0 THEN hits / support ELSE 0.0 END, 6) AS recall,
           round(CASE WHEN predicted + support > 0 THEN 2 * hits / (predicted + support) ELSE 0.0 END, 6) AS f1
    FROM n
    """,
)
def ml_f1_per_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 of a fixed guess (more shots wins) against the result; one class has no rows."""
    matches = order_matches(spark, sf_dir)
    home, away = F.col("home_shots_total"), F.col("away_shots_total")
    guess = F.when(home > away, 0.0).when(home == away, 1.0).otherwise(2.0)
    predictions = matches.select(models.outcome_label(F.col("result")).alias("label"), guess.alias("prediction"))
    classes = [(0.0, "home_win"), (1.0, "draw"), (2.0, "away_win"), (3.0, "abandoned")]
    scores = models.f1_per_class(predictions, classes=classes)
    return scores.select("class", "support", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query("ml_compare")
def ml_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 per class of every classifier on the form features of all matches, tested on the latest fifth."""
    features = form_features(order_matches(spark, sf_dir))
    return models.compare(features, models.classifiers())
