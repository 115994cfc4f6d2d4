from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from touchline import schemas
from touchline.operators import logs, models, reshape, status
from touchline.plans.combine import combined
from touchline.session import drop_written, new_folder, shared_folder, written
from touchline.sources import leagues, lists, sinks, tables


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_lists(spark, tmp_path):
    write(tmp_path / "x_cup_2025.txt", "https://a  \n\n#x\n #x\n\thttps://b\t\n")
    write(tmp_path / "UPPER.TXT", "https://c")
    write(tmp_path / "no.csv", "https://d")
    rows = lists.read_lists(spark, str(tmp_path)).collect()
    assert sorted((r["url"], r["stem"]) for r in rows) == [
        ("#x", "x_cup_2025"), ("https://a", "x_cup_2025"), ("https://b", "x_cup_2025"), ("https://c", "UPPER"),
    ]
    found = lists.list_files(spark, str(tmp_path)).collect()
    assert sorted(r["path"].rsplit("/", 1)[1] for r in found) == ["UPPER.TXT", "x_cup_2025.txt"]


def test_first_paths(spark):
    paths = spark.createDataFrame([(3, "a"), (1, "b"), (2, "a")], "n int, path string")
    got = lists.first_paths(paths, "path", F.col("n")).orderBy("n").collect()
    assert [(r["n"], r["path"]) for r in got] == [(1, "b"), (2, "a")]


def test_match_csv_by_header_name(spark, tmp_path):
    write(tmp_path / "a_2024-2025_match_data.csv",
          'match_id,date,kickoff_time,attendance,home_xg,stadium\nA1,"January 09, 2025",02:30 PM,60201,1.25,"The ""Old"" One"\n,,,,,\n')
    write(tmp_path / "b_2026_match_data.csv", "match_id,attendance,date,kickoff_time,extra\nB1,,28/05/2023,19:45,z\nB2,x,,,\n")
    rows = {r["match_id"]: r for r in tables.read_matches(spark, str(tmp_path)).collect()}
    assert set(rows) == {"A1", "B1", "B2"}
    assert (rows["A1"]["attendance"], str(rows["A1"]["home_xg"]), rows["A1"]["stadium"]) == (60201, "1.25", 'The "Old" One')
    assert str(rows["A1"]["kickoff_ts"]) == "2025-01-09 14:30:00" and str(rows["B1"]["kickoff_ts"]) == "2023-05-28 19:45:00"
    assert rows["B1"]["attendance"] is None and rows["B2"]["attendance"] is None and rows["B1"]["extra"] == "z"
    assert tables.read_matches(spark, str(tmp_path), keep_empty=True).count() == 4
    assert tables.read_match_text(spark, str(tmp_path)).where("match_id = 'B1'").first()["stadium"] == ""
    assert combined(spark, str(tmp_path)).count() == 4
    united = combined(spark, str(tmp_path), add_season=True, keep_empty=False)
    assert united.columns[:4] == ["match_id", "date", "season", "kickoff_time"]
    assert {r["match_id"]: r["season"] for r in united.collect()} == {"A1": "2024-2025", "B1": "2026", "B2": "2026"}


def csv_folder(tmp_path):
    write(tmp_path / "a_match_data.csv", "match_id,round,city\n1,r1,x\n,r2,no id\n")
    write(tmp_path / "b_match_data.csv", "round,match_id,city\nr3,2,y\n")
    write(tmp_path / "c_match_data.csv", '\ufeff"match_id","round", city ,city\n3,r4,z,twice\n')
    write(tmp_path / "d_match_data.csv", "round\nr5\n")
    write(tmp_path / "e_match_data.csv", "match_id,round,city\n")
    write(tmp_path / "f_match_data.csv", "")
    return str(tmp_path)


@pytest.mark.parametrize("multi_line", [True, False])
@pytest.mark.parametrize("columns", [None, ["match_id", "city", "absent"]])
def test_any_first_record_is_a_header(spark, tmp_path, multi_line, columns):
    rows = tables.read_csv_text(spark, csv_folder(tmp_path), columns, multi_line=multi_line)
    names = columns or ["match_id", "round", "city"]
    assert rows.columns == [*names, "file_name"]
    want = {("1", "x"), (None, "no id"), ("2", "y"), ("3", "z"), (None, None)}
    assert {(r["match_id"], r["city"]) for r in rows.collect()} == want and rows.count() == 5


def test_line_breaks_in_quotes_survive_and_wide_records_are_errors(spark, tmp_path):
    write(tmp_path / "a.csv", 'city,match_id\n"two\nlines",1\nplain,2\n')
    assert {r["city"] for r in tables.read_matches(spark, str(tmp_path)).collect()} == {"two\nlines", "plain"}
    write(tmp_path / "b.csv", "match_id" + ",x" * 20 + "\n1" + ",y" * 20 + "\n")
    with pytest.raises(Exception, match="more than 5 columns"):
        tables.read_csv_text(spark, str(tmp_path), ["match_id"], max_columns=5).collect()


def test_combined_needs_a_free_season_column(spark, tmp_path):
    write(tmp_path / "a_match_data.csv", "match_id,date,season\nA1,x,y\n")
    with pytest.raises(ValueError):
        combined(spark, str(tmp_path), add_season=True)
    one = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError):
        reshape.insert_column(one, "season", F.lit("x"))
    with pytest.raises(ValueError):
        sinks.write_combined(one, str(tmp_path / "out"), str(tmp_path))


def test_logs_tolerate_missing_columns(spark, tmp_path):
    write(tmp_path / "a_scrape_log.csv", "scraped_at,url,success,reason,non_empty_fields\n2026-04-17 19:00:12,u,True,none,118\n")
    write(tmp_path / "b_SCRAPE_LOG.csv", "scraped_at,url\n2026-04-17 19:00:13,v\n")
    write(tmp_path / "a_retry_log.csv", "scraped_at,url\n2026-04-17 19:00:13,w\n")
    text = {r["url"]: r for r in tables.read_log_text(spark, str(tmp_path)).collect()}
    assert set(text) == {"u", "v"} and text["v"]["reason"] == "" and text["v"]["t_total_s"] == ""
    typed = {r["url"]: r for r in tables.read_logs(spark, str(tmp_path)).collect()}
    assert typed["u"]["success"] is True and typed["u"]["non_empty_fields"] == 118
    assert str(typed["u"]["scraped_at"]) == "2026-04-17 19:00:12" and typed["v"]["non_empty_fields"] is None


def test_conform_and_append(spark, tmp_path):
    rows = spark.createDataFrame([("u", "x", 3)], "url string, other string, non_empty_fields long")
    for file_format in ("parquet", "csv"):
        path = str(tmp_path / file_format)
        for _ in range(2):
            sinks.append_rows(rows, path, schemas.LOG, file_format)
        read = spark.read.schema(schemas.LOG).options(header="true").format(file_format).load(path)
        assert read.columns == [f.name for f in schemas.LOG.fields] and read.count() == 2
        assert [r["non_empty_fields"] for r in read.collect()] == [3, 3]


def test_links_are_sorted_per_stem(spark, tmp_path):
    links = spark.createDataFrame([("s1", f"u{i:04d}") for i in range(500)] + [("s2", "x")], "stem string, url string")
    sinks.write_links(links.repartition(5), str(tmp_path / "out"))
    for stem, count in (("s1", 500), ("s2", 1)):
        files = sorted((tmp_path / "out" / f"stem={stem}").glob("part-*"))
        urls = [u for f in files for u in f.read_text().split()]
        assert len(urls) == count and urls == sorted(urls)


def test_catalog(spark):
    catalog = leagues.leagues(spark, "us.site.com")
    assert catalog.count() == 28 and catalog.where("results_url is not null").count() == 1
    assert sorted(r["key"] for r in leagues.containing(catalog, "key", "BUNDESLIGA").collect()) == ["2_bundesliga", "bundesliga"]
    assert leagues.containing(catalog, "prefix", "egypt").count() == 2
    first = catalog.where("prefix = 'egypt_' and key = 'egypt_cup'").first()
    assert first["archive_url"] == "https://us.site.com/egypt/egypt-cup/archive/" and first["base_slug"] == "egypt-cup"


def test_union_insert_and_new_files(spark):
    a = spark.createDataFrame([(1, 2)], "a int, b int")
    b = spark.createDataFrame([(3, 4)], "c int, a int")
    united = reshape.union_by_name([a, b])
    assert united.columns == ["a", "b", "c"] and {tuple(r) for r in united.collect()} == {(1, 2, None), (4, None, 3)}
    assert reshape.insert_column(united, "season", F.lit("s")).columns == ["a", "b", "season", "c"]
    names = lambda xs: spark.createDataFrame([(x,) for x in xs], "f string")
    assert [r["f"] for r in logs.new_files(names("cbad"), names("bx"), "f").collect()] == ["a", "c", "d"]


def test_counts(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 0), (None, 1)], "f string, ok int")
    got = {(r["f"], r["n_urls"]) for r in logs.counts_with_total(rows, "f").collect()}
    assert got == {("a", 2), (None, 1), ("TOTAL", 3)}


def test_log_rows(spark):
    rows = spark.createDataFrame(
        [("u", "", None, 1.111, 2.0, 3.0, 9), ("v", "no_stats", None, 1.0, 2.0, 0.0, 9), ("w", "", "x" * 300, 1.0, 2.0, 0.0, 9)],
        "url string, status string, error string, t_summary_s double, t_stats_s double, t_lineups_s double, non_empty_fields int",
    )
    got = {r["url"]: r for r in status.log_rows(rows).collect()}
    assert (got["u"]["success"], got["u"]["reason"], got["u"]["t_scrape_only_s"]) == (True, "none", 6.11)
    assert (got["v"]["success"], got["v"]["reason"]) == (False, "no_stats")
    assert (got["w"]["success"], got["w"]["reason"], got["w"]["non_empty_fields"]) == (False, "x" * 120, None)


def test_f1_of_a_class_without_rows(spark):
    rows = [(0.0, 0.0)] * 3 + [(0.0, 2.0)] + [(2.0, 0.0)]
    predictions = spark.createDataFrame(rows, "label double, prediction double")
    got = {r["class"]: r for r in models.f1_per_class(predictions).collect()}
    assert got["home_win"]["f1"] == pytest.approx(0.75) and got["home_win"]["support"] == 4
    assert got["draw"]["f1"] == 0.0 and got["draw"]["support"] == 0 and got["away_win"]["f1"] == 0.0


def test_shared_folder_stays_the_same(spark):
    assert shared_folder(spark) == shared_folder(spark)


def test_written_tables_go_when_asked(spark, tmp_path):
    drop_written(spark)
    kept = written(spark.range(3), "kept")
    assert kept.count() == 3 and not drop_written(spark.newSession()) == 0
    new_folder(spark, "never-written")
    assert drop_written(spark) == 0
    with pytest.raises(Exception):
        kept.count()
