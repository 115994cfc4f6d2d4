"""Match outcome classifiers on form features, compared by F1 per class."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.operators.reshape import union_by_name
from touchline.session import written

# Class order, as label index 0, 1, 2.
OUTCOMES = [("H", "home_win"), ("D", "draw"), ("A", "away_win")]


def outcome_label(result: Column) -> Column:
    """0 home win, 1 draw, 2 away win; NULL without a result."""
    codes = [code for code, _ in OUTCOMES]
    return F.when(result.isin(codes), F.array_position(F.array(*[F.lit(c) for c in codes]), result) - 1).cast("double")


def f1_per_class(
    predictions: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
    classes: Sequence[tuple[float, str]] = tuple((float(i), name) for i, (_, name) in enumerate(OUTCOMES)),
) -> DataFrame:
    """Precision, recall and F1 of each class, 0 where undefined; classes without rows are listed too.

    The rows are counted into a table of labels by predictions first; all else works on that.
    """
    counts = predictions.groupBy(*by, label, prediction).agg(F.count(F.lit(1)).alias("n"))
    actual = lambda c: F.col(label) == c
    guessed = lambda c: F.col(prediction) == c
    total = lambda test: F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0))
    rows = [
        F.struct(
            F.lit(name).alias("class"),
            total(actual(c) & guessed(c)).alias("hits"),
            total(guessed(c)).alias("predicted"),
            total(actual(c)).alias("support"),
        )
        for c, name in classes
    ]
    per_class = counts.groupBy(*by).agg(F.array(*rows).alias("_rows")).select(*by, F.inline("_rows"))
    share = lambda part, whole: F.when(whole > 0, part / whole).otherwise(F.lit(0.0))
    hits = F.col("hits")
    return per_class.select(
        *by,
        "class",
        "support",
        share(hits, F.col("predicted")).alias("precision"),
        share(hits, F.col("support")).alias("recall"),
        share(hits * 2, F.col("predicted") + F.col("support")).alias("f1"),
    )


def classifiers(iterations: int = 20, trees: int = 20, depth: int = 5, seed: int = 7) -> dict:
    """The compared models, shorter ones first; two-class learners run one against the rest.

    Their classes come one after the other, as each keeps its own copy of the training rows in memory.
    """
    columns = {"featuresCol": "features", "labelCol": "label"}
    svm = LinearSVC(maxIter=iterations, **columns)
    boosted = GBTClassifier(maxIter=iterations, maxDepth=depth, seed=seed, **columns)
    return {
        "logistic_regression": LogisticRegression(maxIter=iterations, **columns),
        "random_forest": RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, **columns),
        "linear_svm": OneVsRest(classifier=svm, parallelism=1, **columns),
        "boosted_trees": OneVsRest(classifier=boosted, parallelism=1, **columns),
    }


def split_by_time(features: DataFrame, share: float = 0.8, time: str = "kickoff_ts") -> tuple[DataFrame, DataFrame]:
    """Earlier matches to train on and later ones to test on.

    The border is the first day on which at least ``share`` of all matches with a known time have been
    played: matches per day are counted and summed up, so it is exact. Matches without a time are in neither part.
    """
    day = F.to_date(time)
    days = features.where(F.col(time).isNotNull()).groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n"))
    so_far, total = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy()
    summed = days.select("day", F.sum("n").over(so_far).alias("so_far"), F.sum("n").over(total).alias("total"))
    cut = F.lit(summed.where(F.col("so_far") >= share * F.col("total")).agg(F.min("day")).first()[0]).cast("date")
    return features.where(day < cut), features.where(day >= cut)


def fit_all(models: dict, rows: DataFrame, at_once: int = 2) -> dict:
    """The fitted models. A few at once fill the cores between the short stages of each; the last named start first."""
    spark = rows.sparkSession
    with ThreadPoolExecutor(at_once) as pool:
        started = {name: pool.submit(inheritable_thread_target(spark)(model.fit), rows) for name, model in reversed(models.items())}
        return {name: started[name].result() for name in models}


def compare(features: DataFrame, models: dict, share: float = 0.8) -> DataFrame:
    """F1 per class of each model, trained on earlier and tested on later matches.

    The features are written once, so that training does not compute the form windows again at
    every pass over the data. They are put in order within their partitions, since forests draw
    rows by their place.
    """
    inputs = [c for c in features.columns if c.startswith(("home_form_", "away_form_"))]
    prepared = written(
        features.sortWithinPartitions(*features.columns)
        .withColumn("label", outcome_label(F.col("result")))
        .where(F.col("label").isNotNull())
        .select("kickoff_ts", "label", *[F.col(c).cast("double").alias(c) for c in inputs]),
        "features",
    )
    train, test = split_by_time(prepared, share)
    filled = [f"{c}_filled" for c in inputs]
    preparation = Pipeline(
        stages=[
            Imputer(inputCols=inputs, outputCols=filled),
            VectorAssembler(inputCols=filled, outputCol="raw_features"),
            StandardScaler(inputCol="raw_features", outputCol="features"),
        ]
    ).fit(train)
    ready = written(preparation.transform(train).select("label", "features"), "train")
    later = preparation.transform(test).select("label", "features")
    predictions = [
        model.transform(later).select(F.lit(name).alias("model"), "label", "prediction")
        for name, model in fit_all(models, ready).items()
    ]
    return f1_per_class(union_by_name(predictions), by=["model"])
