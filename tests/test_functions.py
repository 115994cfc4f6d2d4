from __future__ import annotations

import random

from pyspark.sql import functions as F

from touchline.functions import dates, names, numbers, urls
from touchline.functions.text import strip, to_int
from touchline.operators.reshape import mapped_label
from touchline.operators.summary import labelled_number, league_round, score, title_teams

A, B, C = F.col("a"), F.col("b"), F.col("c")
AS_OF = F.lit("2026-03-15").cast("date")


def test_strip_takes_all_white_space(values):
    texts = ["\t a b\r\n", " x　", "\x1cx\x85", "", "x"]
    assert values(strip(A), texts) == [t.strip() for t in texts]


def test_to_int(values):
    assert values(to_int(A), ["29", " 17 ", "17.0", "", "x", None, "-3"]) == [29, 17, None, None, None, None, -3]


def test_to_int_casts_no_text_without_a_digit(spark):
    texts = spark.createDataFrame([("",), (" x ",), ("+",), (" +7 ",)], "a string")
    whole = texts.select(to_int(A).alias("n"))
    assert [r["n"] for r in whole.collect()] == [None, None, None, 7]
    # a failing cast makes an exception for each row
    assert "CASE WHEN RLIKE(a" in whole._jdf.queryExecution().optimizedPlan().toString()


def test_base_path_and_query(values):
    rows = [
        "https://us.x.com/game/a-1/b-2/?mid=X",
        "https://us.x.com/game/a-1/b-2/summary/?a=1?b=2",
        "https://us.x.com/other/path//",
        "https://us.x.com/game/a-1/b-2",
    ]
    assert values(urls.base_path(A), rows) == [
        "https://us.x.com/game/a-1/b-2/",
        "https://us.x.com/game/a-1/b-2/",
        "https://us.x.com/other/path/",
        "https://us.x.com/game/a-1/b-2/",
    ]
    assert values(urls.query_string(A), rows) == ["?mid=X", "?a=1?b=2", "", ""]
    assert values(urls.stats_url(A), rows[:1]) == ["https://us.x.com/game/a-1/b-2/summary/stats/overall/?mid=X"]
    assert values(urls.lineups_url(A), rows[:1]) == ["https://us.x.com/game/a-1/b-2/summary/lineups/?mid=X"]


def test_match_id(values):
    rows = ["https://x/?mid=M1w8", "https://x/?a=1&mid=Z", "https://x/?mid=a-b", "https://x/", "https://x/?amid=1"]
    assert values(urls.match_id(A), rows) == ["M1w8", "Z", "a", "", ""]


def test_url_tests(values):
    rows = [
        "https://us.site.com/game/a/b/?mid=1",
        "HTTPS://US.SITE.COM/GAME/a/b/",
        "see https://site.com/game/",
        "https://9.site.com/game/a/b/?mid=1",
        "https://us.sitexcom/game/a/b/?mid=1",
        None,
    ]
    assert values(urls.is_match_url(A, "site.com"), rows) == [True, True, True, False, False, False]
    assert values(urls.is_strict_match_url(A), rows) == [True, False, False, True, True, False]


def test_absolute_url(values):
    rows = [" /game/a/b/?mid=1 ", "http://www.site.com/x", "https://site.com/x", "https://de.site.com/x", "x.html"]
    assert values(urls.absolute_url(A, "us.site.com", "site.com"), rows) == [
        "https://us.site.com/game/a/b/?mid=1",
        "https://us.site.com/x",
        "https://us.site.com/x",
        "https://de.site.com/x",
        "x.html",
    ]


def test_list_name_from_url(values):
    rows = [
        "https://h.com/qatar/qsl/2024-2025/results/",
        "https://h.com/germany/2-bundesliga-2024-2025/results/",
        "https://h.com/usa/mls-2025/results",
        "https://h.com/south-america/copa/results/",
        "https://h.com/copa/",
        "https://h.com/",
        "https://h.com/2024-2025/",
        "https://h.com/cup-2023/league-2024/results/",
        "https://h.com/x/cup/2025/results/",
    ]
    assert values(names.list_name_from_url(A, "h.com", AS_OF), rows) == [
        "qatar_qsl_2024-2025.txt",
        "germany_2_bundesliga_2024-2025.txt",
        "usa_mls_2025.txt",
        "south_america_copa_2025-2026.txt",
        "copa_2025-2026.txt",
        "unknown_2025-2026.txt",
        "unknown_2024-2025.txt",
        "cup_league_2024_2023.txt",
        "cup_2025_2025-2026.txt",
    ]


def test_names(values):
    rows = ["x_2026_scrape_log.csv", "/p/x_2024-2025_Retry_LOG_old.CSV", "plain.csv"]
    assert values(names.season_from_name(A), rows) == ["2026", "2024-2025", "unknown"]
    assert values(names.log_stem(A), rows) == ["x_2026", "x_2024-2025", "plain.csv"]
    assert values(names.list_stem(A), ["a/b.c.txt", "x", "d/.txt"]) == ["b.c", "x", ".txt"]
    assert values(names.season_label(A), ["2024/2025", "in 2024-2025.", "2024"]) == ["2024-2025", "2024-2025", None]


def test_seasons(values):
    days = ["2025-06-30", "2025-07-01", "2025-08-01"]
    assert values(dates.season_of(A.cast("date")), days) == ["2024-2025", "2025-2026", "2025-2026"]
    assert values(dates.season_of(A.cast("date"), 8), days) == ["2024-2025", "2024-2025", "2025-2026"]
    rows = [("x-2001-2002/", "01/02/2020"), ("x", "25/09/2023"), ("x", "2024-03-15"), ("x", ""), ("x", None)]
    assert values(dates.match_season(A, B, AS_OF), rows, "a string, b string") == [
        "2001-2002", "2023-2024", "2023-2024", "2025-2026", "2025-2026",
    ]


def test_kickoff_ts(values):
    rows = [("January 09, 2025", "02:30 PM"), ("28/05/2023", "19:45"), ("28/05/2023", ""), ("x", "y"), (None, None)]
    found = values(dates.kickoff_ts(A, B).cast("string"), rows, "a string, b string")
    assert found == ["2025-01-09 14:30:00", "2023-05-28 19:45:00", "2023-05-28 00:00:00", None, None]


def test_result_code(values):
    rows = [("2", "1"), ("1", "2"), (" 1 ", "1"), ("", "1"), ("x", "1"), (None, "1"), ("1.0", "1")]
    assert values(numbers.result_code(A, B), rows, "a string, b string") == ["H", "A", "D", "", "", "", ""]


def test_statistic_values(values):
    assert values(numbers.clean_number(A), ["60 201", "7.000,5", "n/a", "٣4"]) == ["60201", "70005", "", "٣4"]
    assert values(numbers.parse_value(A, True), ["-0.42", " xG 1.5 ", "n/a", "", None]) == ["-0.42", "1.5", "n/a", "", ""]
    assert values(numbers.parse_value(A, False), ["65%", " 7 ", "5.5 %"]) == ["65", "7", "5.5"]
    rows = ["87% (541/623)", "87 (541/623)", "87%", "541", "", None, "(1/2)"]
    got = values(numbers.pct_count(A), rows)
    assert [tuple(r) for r in got] == [
        ("87", "541", "623"), ("87", "541", "623"), ("87", "", ""), ("", "", ""), ("", "", ""), ("", "", ""), ("", "", ""),
    ]


def test_duration_text(values):
    def expected(seconds):
        if seconds < 60:
            return f"{seconds:.1f}s"
        m, s = divmod(int(seconds), 60)
        h, m = divmod(m, 60)
        return f"{h}h {m}m {s}s" if h else f"{m}m {s}s"

    rng = random.Random(3)
    cases = [0.0, 0.05, 0.15, 0.25, 0.35, 6.55, 59.95, 59.949999, 60.0, 61.9, 3599.9, 3600.0, 7325.0]
    cases += [rng.randrange(0, 6000) / 100 for _ in range(400)] + [rng.uniform(0, 9000) for _ in range(200)]
    assert values(numbers.duration_text(A), cases, "a double") == [expected(c) for c in cases]


def test_mapped_label(values):
    rows = ["xGOT faced", "xGOT", "Expected goals (xG)", "Accurate Passes", " Passes in final third ", "Attacks", None]
    assert values(mapped_label(A), rows) == [
        "xgot_faced", "xg", "xg", "accurate_passes", "passes_final_third", None, None,
    ]


def test_league_round(values):
    rows = [
        "Premier League - Round 30",
        "Liga - JORNADA 4 x",
        "Conference League - Play Offs - 1/8-finals",
        "Cup - 1/32-finals",
        "Cup - Third place",
        "Premier League 30",
        "Plain",
        "",
        None,
    ]
    assert [tuple(r) for r in values(league_round(A), rows)] == [
        ("Premier League", "30"),
        ("Liga", "4"),
        ("Conference League", "1/8-finals"),
        ("Cup", "Final"),
        ("Cup", "Third place"),
        ("Premier League", "30"),
        ("Plain", ""),
        ("", ""),
        ("", ""),
    ]


def test_title_and_score(values):
    rows = ["Arsenal v Wolves 28/05/2023 - X", "A v B | x", "A V B Lineups", "A vs B", "A v B"]
    assert [tuple(r) for r in values(title_teams(A), rows)] == [
        ("Arsenal", "Wolves"), ("A", "B"), ("A", "B"), ("", ""), ("", ""),
    ]
    rows = [("5 - 0 (2 - 0)", "1:1"), ("5", "A 1 : 2 B"), (None, "x"), ("50", "3-2")]
    assert [tuple(r) for r in values(score(A, B), rows, "a string, b string")] == [
        ("5", "0"), ("1", "2"), ("", ""), ("3", "2"),
    ]
    rows = ["x attendance: 60 201 of", "Attendance:\n7\n8", "Attendance 5.500,", "none"]
    assert values(labelled_number(A, "Attendance"), rows) == ["60201", "7", "5500", ""]
