"""Per-key operators against plain loops, with one key holding most rows and many bands per key."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from touchline.operators import form, logs
from touchline.operators.keys import (
    first_per_key,
    last_per_key,
    range_bands,
    rolling_last,
    running_total,
    totals_before,
)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    names = ["hot"] * 5 + ["a", "b", "c"]
    return [(rng.choice(names), n, Decimal(rng.randrange(0, 500)) / 100) for n in rng.sample(range(3000), 600)] + [
        ("single", 5000, Decimal("1.25"))
    ]


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, "k string, n int, v decimal(18,2)").repartition(7)


def test_first_and_last(table, rows):
    first = {r["k"]: r["n"] for r in first_per_key(table, ["k"], [F.col("n")]).collect()}
    last = {r["k"]: r["n"] for r in last_per_key(table, ["k"], [F.col("n")]).collect()}
    assert first == {k: min(n for k2, n, _ in rows if k2 == k) for k in {r[0] for r in rows}}
    assert last == {k: max(n for k2, n, _ in rows if k2 == k) for k in {r[0] for r in rows}}


@pytest.mark.parametrize("width", [1, 37, 10_000])
def test_running_total(table, rows, width):
    got = running_total(table, ["k"], [F.col("n")], F.col("v"), "t", F.floor(F.col("n") / width)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["t"] == sum(v for k, n, v in rows if k == r["k"] and n <= r["n"])


def test_rows_of_a_running_total_are_shuffled_once(spark, table, tmp_path):
    table.write.parquet(str(tmp_path / "t"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        totals = running_total(spark.read.parquet(str(tmp_path / "t")), ["k"], [F.col("n")], F.col("v"), "t", F.floor(F.col("n") / 37))
        plan = totals._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    rows = [line for line in plan.splitlines() if line.strip().startswith(":")]  # the left side of the join
    assert "SortMergeJoin" in plan and sum("Exchange" in line for line in rows) == 1
    assert plan.count("Exchange hashpartitioning") == 4  # the other three move sums of bands


def test_rows_without_a_key_stay(spark):
    rows = spark.createDataFrame([(None, 1, Decimal(2)), (None, 2, Decimal(3)), ("a", 1, Decimal(5))], "k string, n int, v decimal(18,2)")
    nowhere = running_total(rows, ["k"], [F.col("n")], F.col("v"), "t", F.when(F.col("n") > 1, F.col("n"))).collect()
    assert {(r["k"], r["n"]): r["t"] for r in nowhere} == {(None, 1): 2, (None, 2): 5, ("a", 1): 5}
    totals = running_total(rows, ["k"], [F.col("n")], F.col("v"), "t", F.lit(0)).collect()
    assert {(r["k"], r["n"]): r["t"] for r in totals} == {(None, 1): 2, (None, 2): 5, ("a", 1): 5}
    overall = logs.elapsed_overall(rows, "k", [F.col("n")], F.col("v"), F.lit(0), "t").collect()
    assert {(r["k"], r["n"]): r["t"] for r in overall} == {(None, 1): 2, (None, 2): 5, ("a", 1): 10}


@pytest.mark.parametrize("parts", [1, 3, 64])
def test_running_total_over_files(spark, table, rows, parts):
    pauses = spark.createDataFrame([("a", 30), ("hot", 5)], "k string, pause int")
    got = logs.elapsed_overall(
        table, "k", [F.col("n")], F.col("v"), F.floor(F.col("n") / 100), "t", pauses, parts
    ).collect()
    assert len(got) == len(rows)
    pause = {"a": 30, "hot": 5}
    for r in got:
        before = sum(v for k, _, v in rows if k < r["k"]) + sum(p for k, p in pause.items() if k < r["k"])
        assert r["t"] == before + sum(v for k, n, v in rows if k == r["k"] and n <= r["n"])


def test_range_bands_split_a_hot_key(table, rows):
    banded = range_bands(table, ["k"], ["n"], 6)
    sizes = {(r["k"], r["band"]): r["count"] for r in banded.groupBy("k", "band").count().collect()}
    assert len([1 for k, _ in sizes if k == "hot"]) > 1 and sum(sizes.values()) == len(rows)
    got = running_total(banded, ["k"], [F.col("n")], F.col("v"), "t", F.col("band")).collect()
    assert {(r["k"], r["n"]): r["t"] for r in got} == {
        (k, n): sum(v for k2, n2, v in rows if k2 == k and n2 <= n) for k, n, _ in rows
    }


def test_totals_before(spark):
    totals = spark.createDataFrame([(f"f{i:03d}", Decimal(i)) for i in range(100)], "f string, v decimal(18,2)")
    got = {r["f"]: r["s"] for r in totals_before(totals, "f", "v", "s", 7).collect()}
    assert got == {f"f{i:03d}": Decimal(sum(range(i))) for i in range(100)}


@pytest.mark.parametrize("width", [1, 4, 50, 10_000])
def test_rolling_last(table, rows, width):
    measures = {"s": F.sum("v"), "c": F.count(F.lit(1)), "ids": F.collect_list("n")}
    got = rolling_last(table, ["k"], ["n"], 5, measures, F.floor(F.col("n") / width)).collect()
    assert len(got) == len(rows)
    for r in got:
        earlier = sorted((n, v) for k, n, v in rows if k == r["k"] and n < r["n"])[-5:]
        assert r["ids"] == [n for n, _ in earlier] and r["c"] == len(earlier)
        assert r["s"] == (sum(v for _, v in earlier) if earlier else None)


def form_by_loop(matches, measure):
    out = {}
    for m in matches:
        for side, other in (("home", "away"), ("away", "home")):
            team = m[f"{side}_team"]
            earlier = []
            for e in matches:
                if (e["kickoff_ts"], e["match_id"]) < (m["kickoff_ts"], m["match_id"]):
                    for s, o in (("home", "away"), ("away", "home")):
                        if e[f"{s}_team"] == team:
                            earlier.append((e["kickoff_ts"], e["match_id"], e[f"{s}_{measure}"], e[f"{s}_goals"], e[f"{o}_goals"]))
            last = sorted(earlier)[-5:]
            pts = [3 if f > a else 1 if f == a else 0 for _, _, _, f, a in last]
            mean = lambda xs: sum(xs) / len(xs) if xs else None
            out[m["match_id"], side] = (len(last), mean(pts), mean([x[2] for x in last]))
    return out


@pytest.mark.parametrize("unit", ["day", "month", "year"])
def test_form_never_sees_the_match_or_later_ones(spark, unit):
    rng = random.Random(2)
    teams = ["hot"] * 4 + ["a", "b", "c"]
    matches = []
    for n in range(120):
        home, away = rng.choice(teams), rng.choice(["x", "y", "z"])
        day = datetime(2024, 1, 1) + timedelta(days=rng.randrange(0, 400) // 3 * 3)
        matches.append({
            "match_id": n, "kickoff_ts": day, "home_team": home, "away_team": away, "result": "H",
            "home_goals": rng.randrange(4), "away_goals": rng.randrange(4),
            "home_shots_total": rng.randrange(20), "away_shots_total": rng.randrange(20),
        })
    schema = (
        "match_id int, kickoff_ts timestamp_ntz, home_team string, away_team string, result string, home_goals int,"
        "away_goals int, home_shots_total int, away_shots_total int"
    )
    df = spark.createDataFrame(matches, schema)
    got = form.form_features(df, ["shots_total"], unit).collect()
    expected = form_by_loop(matches, "shots_total")
    assert len(got) == len(matches)
    for r in got:
        for side in ("home", "away"):
            count, points, shots = expected[r["match_id"], side]
            assert r[f"{side}_form_matches"] == count
            assert r[f"{side}_form_points"] == (pytest.approx(points) if points is not None else None)
            assert r[f"{side}_form_shots_total"] == (pytest.approx(shots) if shots is not None else None)
