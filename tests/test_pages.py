from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from touchline import schemas
from touchline.functions.numbers import non_empty, pct_count
from touchline.operators import elements as elements_module
from touchline.operators import stats
from touchline.operators.elements import elements
from touchline.operators.lineups import parse_lineups
from touchline.operators.links import archive_seasons, match_links, results_season
from touchline.operators.reshape import kept_pairs, long_to_wide, mapped_label, stored_value
from touchline.operators.stats import parse_stats, stat_rows
from touchline.operators.status import any_value
from touchline.operators.summary import parse_summary
from touchline.plans import page_queries
from touchline.plans.collect import collect_matches, match_table
from touchline.plans.links import match_lists
from touchline.sources.tables import typed


@pytest.fixture(scope="module")
def parse(spark):
    def run(function, *pages):
        df = spark.createDataFrame(list(enumerate(pages)), "n int, html string")
        return [r.asDict() for r in function(df).orderBy("n").collect()]

    return run


def test_elements_keep_order_and_nesting(parse):
    page = "<!doctype html><div class='a  b' id=x>one<br>two<!-- c -->three<p>four</div>five<script>if (a<b) {}</script>"
    rows = parse(elements, page)
    got = [(r["pos"], r["end_pos"], r["parent"], r["depth"], r["tag"], r["text"]) for r in rows]
    assert got == [
        (0, 6, -1, 0, "div", None),
        (1, 1, 0, 1, "#text", "one"),
        (2, 2, 0, 1, "br", None),
        (3, 3, 0, 1, "#text", "two"),
        (4, 4, 0, 1, "#text", "three"),
        (5, 6, 0, 1, "p", None),
        (6, 6, 5, 2, "#text", "four"),
        (7, 7, -1, 0, "#text", "five"),
        (8, 9, -1, 0, "script", None),
        (9, 9, 8, 1, "#raw", "if (a<b) {}"),
    ]
    assert rows[0]["attrs"] == {"class": "a  b", "id": "x"} and rows[0]["class"] == "a b"


def test_elements_tolerate_bad_markup(parse):
    assert parse(elements, "") == []
    tags = [r["tag"] for r in parse(elements, "</b><i>x</b>y<i/>&amp;&lt;  \n <b")]
    assert tags[:2] == ["i", "#text"]
    blanks = [r["text"] for r in parse(elements, "<p> \n </p><pre> \n </pre>") if r["tag"] == "#text"]
    assert blanks == ["\n", " \n "]


def test_match_links_only_inside_match_rows(spark):
    page = """
    <div class="x event__match--row"><a href=" /game/b/c/?mid=2 ">1</a><a href="/game/b/c/">2</a>
      <div class="event__match"><a href="https://www.site.com/game/a/b/?mid=1">3</a></div></div>
    <span class="event__match"><a href="/game/z/z/?mid=9">4</a></span><a href="/game/y/y/?mid=8">5</a>
    <div class="event__match"><a>no href</a><a href="/game/b/c/?mid=2">again</a></div>"""
    pages = spark.createDataFrame([(1, page)], "n int, html string")
    found = sorted(r["url"] for r in match_links(pages, "us.site.com", "site.com").collect())
    assert found == ["https://us.site.com/game/a/b/?mid=1", "https://us.site.com/game/b/c/?mid=2"]


def test_archive_seasons(spark):
    rows = [
        ("https://h/l/archive/", "<a href='/x'>Home</a><a href='/l/'> <b>2025</b>/2026</a><a href='/l-2024-2025/'>2024/2025</a>"),
        ("https://h/m/archive/", "<a href='http://h/q/results/'>Season 2024-2025</a>"),
        ("https://h/n/archive/", "<p>none</p>"),
    ]
    pages = spark.createDataFrame(rows, "archive_url string, html string")
    got = archive_seasons(pages, "h", F.lit("2026-02-01").cast("date")).orderBy("archive_url").collect()
    assert [(r["current_season"], r["previous_url"]) for r in got] == [
        ("2025-2026", "https://h/l-2024-2025/results/"),
        ("2025-2026", "http://h/q/results/"),
        ("2025-2026", "https://h/n-2024-2025/results/"),
    ]
    single = spark.createDataFrame([("<p>x</p><b>World 2026/2027 cup</b>",), ("<p>x</p>",)], "html string")
    assert sorted(r["current_season"] for r in results_season(single).collect()) == ["2026-2027", "current"]


SUMMARY = """<html><head><title> Arsenal v Wolves 28/05/2023 - X </title></head><body>
<nav data-testid="other"><ol><li><a><span>no</span></a></li></ol></nav>
<nav data-testid="wcl-breadcrumbs"><ol><li><a><span>England</span></a></li><li><a><span> Cup - Play Offs - Quarter-Finals</span></a></li></ol></nav>
<div class="duelParticipant__startTime">soon</div><div class="event__time">02:30 PM, January 09, 2025</div>
<div class="duelParticipant__home x"><a class="participant__participantName">Arsenal <b>FC</b></a></div>
<div class="duelParticipant__away"><a class="participant__participantNames">nobody</a></div>
<div class="current-result">5 - 0</div>
<div data-testid="wcl-summaryMatchInformation">
 <div><div class="wcl-infoLabelWrapper_x">Referee</div></div><div class="wcl-infoValue_z"><span>R</span></div>
 <div><div class="wcl-infoLabelWrapper_x"><span>Venue</span>:</div></div>
 <div class="wcl-infoValue_z"><b><span>inner</span></b><span>Big Arena</span><span> (Athens)</span></div>
 <div>Attendance: 60 201</div><div>Capacity: 70,000</div></div></body></html>"""


def test_summary(parse):
    row = parse(parse_summary, SUMMARY)[0]
    expected = {
        "league_division": "Cup", "round": "Quarter-finals", "date": "January 09, 2025", "kickoff_time": "02:30 PM",
        "attendance": "60201", "capacity": "70000", "stadium": "Big Arena", "city": "Athens",
        "home_team": "Arsenal FC", "away_team": "Wolves", "home_goals": "5", "away_goals": "0", "result": "H",
        "round_raw": "Cup - Play Offs - Quarter-Finals",
    }
    assert {k: row[k] for k in expected} == expected


def test_summary_fallbacks(parse):
    page = "<title>A v B 2:1 - x</title><p>May 05, 2024 at 9:15</p><p>Venue: Old Park (Rome)</p>"
    row = parse(parse_summary, page)[0]
    assert (row["date"], row["kickoff_time"]) == ("May 05, 2024", "9:15")
    assert (row["stadium"], row["city"]) == ("Old Park", "Rome")
    assert (row["home_team"], row["away_team"], row["result"]) == ("A", "B 2:1", "H")
    empty = parse(parse_summary, "<p>nothing</p>")[0]
    assert all(empty[c] == "" for c in ("league_division", "date", "stadium", "home_team", "home_goals", "result"))


def test_summary_pages_in_one_batch_stay_apart(parse, spark):
    label = lambda text: f'<div><div class="wcl-infoLabelWrapper_x">{text}</div></div>'
    value = lambda text, name="wcl-infoValue_z": f'<div class="{name}"><b><span>no</span></b><span>{text}</span></div>'
    information = lambda *parts: f'<div data-testid="wcl-summaryMatchInformation">{"".join(parts)}</div>'
    pages = [
        SUMMARY,
        None,
        information(label("Referee"), value("R"), label("Venue")) + information(value("x"), value("y")),
        information(label("Venue"), value("a", "x wcl-infoValue_z"), label("Venue"), value("One"), label("Venue"), value("Two")),
        '<div class="home-team"><b class="team-name"> </b></div><p class="HomeTeam"><p class="name">H</p></p><div class="kickoff">8:00</div>',
        '<div class="kickoff">7:00, May 05, 2024</div><div class="match-time">late</div><div class="scoreBox">1 - 2</div>',
    ]
    rows = parse(lambda df: parse_summary(df.coalesce(1)), *pages)
    found = [(r["stadium"], r["home_team"], r["kickoff_time"], r["date"], r["home_goals"]) for r in rows]
    assert found == [
        ("Big Arena", "Arsenal FC", "02:30 PM", "January 09, 2025", "5"),
        ("", "", "", "", ""),
        ("", "", "", "", ""),
        ("One", "", "", "", ""),
        ("", "H", "8:00", "", ""),
        ("", "", "7:00", "May 05, 2024", "1"),
    ]
    plan = parse_summary(spark.createDataFrame([(SUMMARY,)], "html string"))._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan.lower()  # rules on nodes work on batches of pages


def stat_row(home, label, away):
    return (
        f'<div class="wcl-category_1"><div class="wcl-value wcl-homeValue_1">{home}</div>'
        f'<div class="wcl-category_6z">{label}</div><div class="wcl-awayValue_1">{away}</div></div>'
    )


def test_stats_keep_rule_and_values(parse):
    page = (
        stat_row("0", "Corner kicks", "3") + stat_row("5", "Corners", "0") + stat_row("7", "Corners", "9")
        + stat_row("0.00", "xG", "1") + stat_row("1.2", "xG", "2") + stat_row("0", "Fouls", "1") + stat_row(" ", "Fouls", "2")
        + stat_row("<b>87%</b> <i>(541/623)</i>", "Passes", "76% (1/2)") + stat_row("1", "Unknown", "2")
    )
    row = parse(parse_stats, page)[0]
    assert (row["home_corners"], row["away_corners"]) == ("5", "0")
    assert (row["home_xg"], row["away_xg"]) == ("0.00", "1")
    assert (row["home_fouls_committed"], row["away_fouls_committed"]) == ("", "2")
    assert (row["home_passes"], row["home_passes_pct"], row["home_passes_successful"], row["home_passes_total"]) == (
        "87", "87", "541", "623")
    assert (row["home_red_cards"], row["home_offsides"]) == ("0", "")
    assert len(row) - 1 == 2 * len(schemas.STATS) + 30


def test_stats_strategies(parse):
    table = "<table><tr><td>4</td><th>Offsides</th><td>2</td></tr><tr><td>1</td><td>x</td></tr></table>"
    lines = "<p>12</p><p>Fouls</p><p>7%</p><p>x</p><p>3</p><p>Corners</p>"
    other = '<div class="stat-row"><i>1</i><i>(2/3)</i><i>Fouls</i><i>4</i><i>(5/6)</i></div>'
    pages = [
        table, lines, other,
        stat_row("0", "Corners", "0") + table,          # nothing real in the first strategy: the table counts
        stat_row("1", "Red cards", "0") + table,        # a card is a real value: the table does not count
        stat_row("0", "Corners", "0"),                  # nothing real anywhere
        '<div class="stat-row">only one</div><li class="stat"><i>1a</i><i>Fouls</i><i>2</i></li>',
        stat_row("1a", "Fouls", "2").replace("wcl-homeValue_1", "x"),
    ]
    rows = {r["n"]: r for r in parse(parse_stats, *pages)}
    assert (rows[0]["home_offsides"], rows[0]["away_offsides"]) == ("4", "2")
    assert (rows[1]["home_fouls_committed"], rows[1]["away_fouls_committed"], rows[1]["home_corners"]) == ("12", "7", "")
    assert (rows[2]["home_fouls_committed"], rows[2]["away_fouls_committed"]) == ("1 (2/3)", "4 (5/6)")
    assert (rows[3]["home_corners"], rows[3]["home_offsides"]) == ("0", "4")
    assert (rows[4]["home_red_cards"], rows[4]["home_offsides"]) == ("1", "")
    assert (rows[5]["home_corners"], rows[5]["home_offsides"]) == ("0", "")
    for n in (6, 7):
        assert {c for c, v in rows[n].items() if v != "" and c != "n"} == {
            "home_yellow_cards", "away_yellow_cards", "home_red_cards", "away_red_cards"}


def test_statistics_are_read_for_many_pages_at_once(spark):
    """The rules on values are no expressions on one page's arrays, and give what the column functions give."""
    plan = parse_stats(spark.createDataFrame([("x",)], "html string"))._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan.lower()
    texts = ["", "0", "-1.5", " 7 ", "12%%", "% 3 %", "1.", "\u0663%", "\u0663 (\u0661/\u0662)", "87% (541/623)", "76 %  ( 1/2)", "8%\xa0(1/2)",
             "9 9 %", "5% (1/2) 6% (3/4)", "1\x1c%", "12 (5/x) 3%", "a -3. b", "--3", "x", "1\n2"]
    raw = stats.pa.array(texts)
    for stat in ("passes", "xg", "fouls_committed"):
        rows = spark.createDataFrame(list(enumerate(texts)), "n int, raw string")
        read = pct_count(F.col("raw"))
        expected = rows.select(stored_value(F.lit(stat), F.col("raw")), read["pct"], read["successful"], read["total"]).collect()
        stored, counted, parts = stats.stored_values(stats.np.full(len(texts), stats.STAT_NUMBER[stat]), raw)
        assert stored.to_pylist() == [r[0] for r in expected]
        if stat == "passes":
            assert list(zip(*[p.to_pylist() for p in parts])) == [tuple(r)[1:] for r in expected] and len(counted) == len(texts)
    labels = [" CORNERS", "Expected goals (xG)", "Big\u212a duels won x", "", "Accurate passes!", "shots", "Throw\xa0ins", "xG\xa0"]
    rows = spark.createDataFrame([(label,) for label in labels], "label string")
    expected = [r[0] for r in rows.select(mapped_label(F.col("label"))).collect()]
    names = [*schemas.STATS, None]  # -1 is the last
    assert [names[n] for n in stats.label_statistics(stats.pa.array(labels))] == expected


def test_a_later_strategy_counts_only_on_pages_without_a_real_value(parse):
    table = "<table><tr><td>4</td><th>Passes</th><td>2% (3/4)</td></tr></table>"
    pages = [stat_row("87% (541/623)", "Passes", "1%") + table, stat_row("0", "Corners", "0") + table, table + "<p>5</p><p>Fouls</p><p>6</p>"]
    names = ["home_passes", "home_passes_total", "away_passes", "away_passes_total", "home_corners", "home_fouls_committed"]
    got = [[row[name] for name in names] for row in parse(parse_stats, *pages)]
    assert got == [["87", "623", "1", "", "", ""], ["", "", "2", "4", "0", ""], ["", "", "2", "4", "", ""]]


def test_strategy_rows_are_numbered(parse, spark):
    pages = spark.createDataFrame([(0, stat_row("1", "Fouls", "2"))], "n int, html string")
    assert [tuple(r) for r in stat_rows(pages).where("strategy = 1").collect()] == [(0, 1, 0, "1", "Fouls", "2")]


def test_kept_pairs_equal_a_plain_loop(spark):
    rng = random.Random(5)
    rows = [
        (g, rng.choice("xy"), p, rng.choice(["", "0", None, "0.0", "3", "7"]), rng.choice(["", "0", "2"]))
        for g in range(150) for p in range(rng.randrange(1, 8))
    ]
    expected = {}
    for g, stat, _, home, away in rows:
        if expected.get((g, stat), ("",))[0] in ("", None, "0"):
            expected[(g, stat)] = (home, away)
    df = spark.createDataFrame(rows, "g int, stat string, p int, home string, away string").repartition(5)
    pairs = kept_pairs(df, ["g"], "stat", F.col("p"), F.col("home"), F.col("away")).collect()
    assert {(r["g"], r["stat"]): (r["pair"]["home"], r["pair"]["away"]) for r in pairs} == expected
    wide = long_to_wide(df, ["g"], "stat", F.col("p"), F.col("home"), F.col("away"), ["x", "y"]).collect()
    assert {r["g"]: (r["home_x"], r["away_y"]) for r in wide} == {
        g: (expected.get((g, "x"), (None, None))[0], expected.get((g, "y"), (None, None))[1])
        for g in {k[0] for k in expected}
    }


def test_lineups(parse):
    pages = [
        '<div class="formation">4 - 3 - 3</div><div class="Formation">x 3-4-2-1</div><b class="rating">7.2</b><b class="team-rating">6.1</b>',
        '<div class="formation">4-3-3</div><p>4-3-3</p><p>Rating: 7.2 - 5.5</p><p>AVERAGE 6.1</p>',
        "<p>4-3-3 5.5 5.5 9.9 10.2 4.9</p>",
        '<div class="ratings"><i class="rating">7.2</i></div>',
        "<p>12-3-4 and 2020-11-12</p>",
    ]
    got = [
        (r["home_formation"], r["away_formation"], r["home_team_rating"], r["away_team_rating"])
        for r in parse(parse_lineups, *pages)
    ]
    assert got == [
        ("4-3-3", "3-4-2-1", "7.2", "6.1"),
        ("4-3-3", "4-3-3", "7.2", "6.1"),
        ("4-3-3", "", "5.5", "9.9"),
        ("", "", "7.2", "7.2"),
        ("", "", "", ""),
    ]


def test_lineup_texts_and_field_counts_are_no_expressions_on_nodes(spark):
    pages = spark.createDataFrame([("u", "<p>x</p>")], "url string, html string")
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "nodes" not in plan(parse_lineups(pages)) and "rating_texts" in plan(parse_lineups(pages))
    texts = spark.createDataFrame([("", None, "0"), ("x", " ", "0"), (None, "", "")], "a string, b string, c string")
    counts = texts.select(non_empty(["a", "b", "c"]), any_value(["a", "b"]), any_value(["a", "c"], ("", "0")), any_value(["c"]))
    assert "lambdafunction" not in plan(counts)
    assert [tuple(r) for r in counts.collect()] == [(1, False, False, True), (3, True, True, True), (0, False, False, False)]


def test_texts_are_stripped_once_before_they_are_typed(spark):
    names = [f.name for f in schemas.MATCH.fields if f.dataType.typeName() != "string"]
    rows = spark.createDataFrame([(" 7\xa0",), ("1.6",), (" ",), ("x",), (None,)], "v string")
    table = typed(rows.select(*[F.col("v").alias(c) for c in names]), schemas.MATCH)
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("trim(") <= len(names)
    assert [r["home_corners"] for r in table.collect()] == [7, 2, None, None, None]


def test_collection_status_and_fields(spark):
    url = lambda n: f"https://us.site.com/game/a/b{n}/?mid=M{n}"
    title = "<title>A v B - x</title>"
    rows = [
        (url(1), "summary", SUMMARY), (url(1), "stats", stat_row("87% (541/623)", "Passes", "76% (1/2)")),
        (url(1), "lineups", "<p>4-3-3 3-4-3</p>"),
        (url(2), "summary", "<title>404</title>"), (url(3), "summary", title + "<p>Not Found</p>"),
        (url(4), "summary", title + "Forbidden"), (url(5), "summary", "<title>x</title>"),
        (url(6), "summary", title), (url(6), "stats", stat_row("2", "Yellow cards", "1")), (url(6), "lineups", "<p>4-3-3</p>"),
        (url(7), "summary", title), (url(7), "stats", stat_row("2", "Corners", "1")), (url(7), "lineups", "<p>none</p>"),
        (url(8), "summary", title), ("https://else.com/x", "summary", title),
    ]
    pages = spark.createDataFrame(rows, "url string, tab string, html string")
    collected = collect_matches(pages, "site.com")
    got = {r["url"]: r for r in collected.collect()}
    status = {n: got[url(n)]["status"] for n in range(1, 9)}
    assert status == {1: "", 2: "404", 3: "404", 4: "403", 5: "no_data", 6: "no_stats", 7: "no_lineups", 8: "no_stats"}
    assert got["https://else.com/x"]["status"] == "false"
    # match id + 13 summary fields + 4 cards + 8 passing fields + 2 formations
    assert got[url(1)]["non_empty_fields"] == 28
    assert [got[url(n)]["non_empty_fields"] for n in (2, 5, 6, 7, 8)] == [0, 1, 7, 9, 7]
    assert got[url(6)]["home_formation"] is None and got[url(6)]["home_yellow_cards"] == "2"
    assert got[url(2)]["match_id"] is None and got[url(8)]["home_yellow_cards"] == "0"
    table = match_table(collected)
    assert [f.name for f in table.schema.fields] == [f.name for f in schemas.MATCH.fields]
    assert table.count() == 5 and match_table(collected, keep_empty=True).count() == 9
    first = table.where("match_id = 'M1'").first()
    assert (first["home_passes_total"], first["attendance"], first["home_corners"]) == (623, 60201, None)


def test_plain_pages_are_read_at_once_as_the_parser_reads_them():
    row = stat_row("1", "Corners", "2")
    plain = ["<p>a<br>b</p>", f"<title>x &amp; y</title>{row}", "<div>\n <b class='x'>q</b></div>", "<!-- c -->t<!doctype html>u",
             "<script>if (a<b) '<i>c</i>'</script>&lt;<style></style>"]
    others = ["<p>a<p>b", "<b><i>x</b></i>", "a < b", "<title><b>x</b></title>", "<pre> \n </pre>", "<br/>", "<script src=\"x\">a</script>", "</p>", None, ""]
    tags = elements_module._PlainTags()
    parser = elements_module._Nodes()
    for page in plain + others:
        parser.add_page(page)
    assert elements_module._nodes_of(tags, plain + others).to_pylist() == parser.to_array().to_pylist()
    read = [tags.pieces(page) is not None for page in plain]
    assert read == [True, True, False, True, True]  # the third has single quotes


def test_pages_of_all_kinds_are_cut_at_their_bytes_or_by_the_parser():
    pages = ["a > b<p>x</p>", "<p>&lt;\xa0&nbsp;</p><i>\t</i>", "<script>'<p>'</script><b>y</b>", "<p>open", "z\0<b></b>", None, "<title>t</title>", "<title><b>t</b></title>",
             "</i><p></p>", "<b><i>\n \n</b></i>", "<p", "<TITLE>q</TITLE>", ">", "<!-- c --><hr>", ""]
    parser = elements_module._Nodes()
    for page in pages:
        parser.add_page(page)
    tags = elements_module._PlainTags()
    html = elements_module.pa.array(["<u>", *pages, "</u>"])[1:-1]
    assert elements_module._nodes_of(tags, html).to_pylist() == parser.to_array().to_pylist()
    cut = elements_module._cut_at_tags(tags, elements_module.pc.fill_null(html, ""))
    assert cut.places.tolist() == [0, 1, 3, 5, 6, 8, 9, 12, 13, 14]
    groups = elements_module._groups_of(tags, elements_module.pc.fill_null(html, ""))
    assert [places.tolist() for places, _ in groups] == [[0, 1, 5, 6, 12, 13, 14, 2], [3, 4, 7, 8, 9, 10, 11]]


def test_rows_of_pages_in_one_batch_stay_apart():
    table = "<table><tr><td>1</td><td>Fouls</td><td>2</td></tr></table>"
    pages = [stat_row("1", "Corners", "2"), None, f"<div class='statRow'>3<b>Fouls</b>4</div>{table}", "<p>5</p>", "<p>Fouls</p><p>6</p>",
             "<p>7</p><p>xG\n8</p>", "<div class='stat-row'>1<b>A</b>2<div class='statRow'>x</div></div>"]
    usual, others = stats._found_rows(elements_module._nodes_of(elements_module._PlainTags(), pages))
    found = [[tuple(r.values()) for r in a + b] for a, b in zip(usual.to_pylist(), others.to_pylist())]
    assert found == [
        [(1, 0, "1", "Corners", "2"), (4, 0, "1", "Corners", "2")],
        [],
        [(2, 0, "3", "Fouls", "4"), (3, 0, "1", "Fouls", "2"), (4, 0, "3", "Fouls", "4"), (4, 1, "1", "Fouls", "2")],
        [],
        [],
        [(4, 0, "7", "xG", "8")],
        [(4, 0, "1", "A", "2")],
    ]


def test_a_listing_page_may_come_in_parts(spark):
    leagues = spark.createDataFrame(
        [("k", "p_", None, "https://us.site.com/k/results/")], "key string, prefix string, archive_url string, results_url string"
    )
    row = lambda n: f'<div class="event__match"><a href="/game/a/b/?mid={n}">x</a></div>'
    texts = [(0, f"<p>Season 2019/2020</p>{row(1)}"), (1, row(2) + row(1)), (2, f"<p>2001/2002</p>{row(3)}")]
    pages = spark.createDataFrame([("https://us.site.com/k/results/", n, t) for n, t in texts], "url string, part int, html string")
    as_of = F.lit("2025-09-01").cast("date")
    found = match_lists(leagues, pages, "us.site.com", "site.com", as_of)
    whole = spark.createDataFrame([("https://us.site.com/k/results/", "".join(t for _, t in texts))], "url string, html string")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, match_lists(leagues, whole, "us.site.com", "site.com", as_of).collect()))
    assert found.count() == 3 and "2019" in found.first()["stem"]


def test_listing_pages_of_the_query_are_bounded(spark, tmp_path, monkeypatch):
    keys = spark.range(1, 20_000).select(F.col("id").alias("o_orderkey"))
    keys.write.parquet(str(tmp_path / "orders.parquet"))
    sizes = []

    def seen(catalog, pages, *rest):
        sizes.append(pages.agg(F.max(F.length("html"))).first()[0])
        return match_lists(catalog, pages, *rest)

    monkeypatch.setattr(page_queries, "match_lists", seen)
    assert page_queries.job_links(spark, str(tmp_path)).count() > 10_000
    assert sizes[0] < 60 * 300


def test_tags_of_links_are_not_kept_for_ever(monkeypatch):
    made = []

    class Seen(elements_module._PlainTags):
        def __init__(self):
            made.append(self)
            super().__init__()

    monkeypatch.setattr(elements_module, "_PlainTags", Seen)
    page = lambda n: "".join(f'<a href="/{n}/{i}">x</a>' for i in range(20_000))
    pages = [page(n) for n in range(4)]
    batch = elements_module.pa.RecordBatch.from_pydict({"n": list(range(4)), "html": pages})
    out = [b for b in elements_module._tokenise(iter([batch]))]
    assert [len(nodes) for b in out for nodes in b.column(1)] == [40_000] * 4
    assert max(len(tags.kind) for tags in made) <= 41_000
