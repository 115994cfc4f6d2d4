from __future__ import annotations

import random
import threading
from datetime import datetime, timedelta

from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from touchline.operators import models
from touchline.operators.form import form_features


def feature_rows(spark, rows):
    return spark.createDataFrame(rows, "match_id long, kickoff_ts timestamp_ntz, result string, home_form_a double, away_form_a double").coalesce(1)


def test_scores_do_not_hang_on_the_order_in_which_rows_arrive(spark):
    random.seed(3)
    rows = []
    for i in range(400):
        home, away = random.random(), random.random()
        result = "H" if home > away + random.random() / 2 else "A" if away > home + random.random() / 2 else "D"
        rows.append((i, datetime(2020, 1, 1) + timedelta(days=i // 4), result, home, away))
    mixed = random.sample(rows, len(rows))
    forest = {"forest": RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=3, maxDepth=4, seed=5)}
    scores = [sorted(map(tuple, models.compare(feature_rows(spark, r), forest).collect())) for r in (rows, mixed)]
    assert scores[0] == scores[1]


def test_two_models_are_fitted_at_once_and_no_more(spark):
    both, running, most, lock = threading.Barrier(2, timeout=30), [0], [0], threading.Lock()

    class Model:
        def __init__(self, name):
            self.name = name

        def fit(self, rows):
            with lock:
                running[0] += 1
                most[0] = max(most[0], running[0])
            both.wait()  # ends only if another model is fitted meanwhile
            with lock:
                running[0] -= 1
            return self.name, rows.count()

    names = ["a", "b", "c", "d"]
    assert models.fit_all({n: Model(n) for n in names}, spark.range(3)) == {n: (n, 3) for n in names}
    assert most[0] == 2


def test_classes_of_a_model_are_fitted_one_after_the_other():
    compared = models.classifiers()
    assert [compared[n].getParallelism() for n in ("linear_svm", "boosted_trees")] == [1, 1]


def test_sides_of_a_match_meet_without_sorting_all_rows(spark):
    columns = "match_id long, kickoff_ts timestamp_ntz, home_team string, away_team string, home_goals int, away_goals int, result string"
    matches = spark.createDataFrame(
        [(1, datetime(2020, 1, 1), "x", "y", 2, 0, "H"), (2, datetime(2020, 2, 1), "y", "x", 1, 1, "D"), (3, None, "x", "y", 0, 0, "D"),
         (None, datetime(2020, 3, 1), "x", "z", 0, 1, "A"), (None, datetime(2020, 3, 1), "x", "z", 0, 1, "A")],
        columns,
    )
    found = form_features(matches, measures=())
    got = found.select("match_id", "home_form_points", "away_form_points", "home_form_matches", "away_form_matches")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, None, None, 0, 0), (2, 0.0, 3.0, 1, 1), (3, None, None, 0, 0), (None, 2.0, None, 2, 0), (None, 4 / 3, 3.0, 3, 1)], key=str
    )
    top = found._jdf.queryExecution().executedPlan().toString().split("Union")[0]
    assert "HashAggregate" in top and "SortAggregate" not in top
