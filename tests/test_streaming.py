from __future__ import annotations

from pyspark.sql import functions as F

from tests.test_pages import SUMMARY, stat_row
from touchline import schemas
from touchline.plans.collect import collect_matches, match_table
from touchline.operators.status import log_rows
from touchline.plans import retry as plan
from touchline.streaming import ingest, retry, waiting


def test_lists_are_taken_in_once_and_archived(spark, tmp_path):
    incoming, out, state, archive = (str(tmp_path / n) for n in ("in", "out", "state", "archive"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a_2025.txt").write_text("https://a\n#no\n\n")

    def run():
        stream = ingest.stream_lists(spark, incoming, archive)
        ingest.append_stream(stream, out, state).awaitTermination()
        return sorted((r["url"], r["stem"]) for r in spark.read.parquet(out).collect())

    assert run() == [("https://a", "a_2025")]
    assert run() == [("https://a", "a_2025")]
    (tmp_path / "in" / "b_2025.txt").write_text("https://b")
    assert run() == [("https://a", "a_2025"), ("https://b", "b_2025")]
    (tmp_path / "in" / "c_2025.txt").write_text("https://c")
    assert len(run()) == 3
    assert any(p.name == "a_2025.txt" for p in (tmp_path / "archive").rglob("*"))


def test_streamed_collection_equals_the_batch_job(spark, tmp_path):
    url = lambda n: f"https://us.site.com/game/a/b{n}/?mid=M{n}"
    pages = spark.createDataFrame(
        [(url(n), "summary", SUMMARY) for n in range(3)] + [(url(1), "stats", stat_row("1", "Corners", "2"))],
        "url string, tab string, html string",
    )
    incoming, matches, logs, state = (str(tmp_path / n) for n in ("in", "matches", "logs", "state"))
    (tmp_path / "in").mkdir()
    for n in range(3):
        (tmp_path / "in" / f"l{n}.txt").write_text(url(n))
        stream = ingest.stream_lists(spark, incoming)
        ingest.collect_stream(stream, pages, "site.com", matches, logs, state).awaitTermination()
    batch = collect_matches(pages, "site.com")
    columns = [f.name for f in schemas.MATCH.fields]
    got = spark.read.parquet(matches).select(columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, match_table(batch).collect()))
    saved = spark.read.parquet(logs).select("url", "reason", "non_empty_fields")
    wanted = log_rows(batch).select("url", "reason", "non_empty_fields")
    assert sorted(map(tuple, saved.collect())) == sorted(map(tuple, wanted.collect()))


def test_a_page_may_come_after_its_list(spark, tmp_path):
    url = lambda n: f"https://us.site.com/game/a/b{n}/?mid=M{n}"
    incoming, matches, logs, state, pages = (str(tmp_path / n) for n in ("in", "matches", "logs", "state", "pages"))
    (tmp_path / "in").mkdir()
    add = lambda n: spark.createDataFrame([(url(n), "summary", SUMMARY)], "url string, tab string, html string").write.mode(
        "append").parquet(pages)

    def run(name, *numbers):
        (tmp_path / "in" / name).write_text("\n".join(map(url, numbers)))
        stream = ingest.stream_lists(spark, incoming)
        table = spark.read.schema("url string, tab string, html string").parquet(pages)
        ingest.collect_stream(stream, table, "site.com", matches, logs, state).awaitTermination()
        return sorted(r["url"] for r in spark.read.parquet(logs).collect())

    add(0)
    assert run("a.txt", 0, 1, 2) == [url(0)]
    add(1)
    assert run("b.txt", 3) == [url(0), url(1)]
    add(2)
    add(3)
    assert run("c.txt", 4) == [url(0), url(1), url(2), url(3)]


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    rows = spark.range(3)
    for _ in range(2):
        ingest.write_batch(rows, str(tmp_path / "t"), 0)
    ingest.write_batch(rows, str(tmp_path / "t"), 1)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 6


LOG = "line_no bigint, file_name string, url string, reason string, non_empty_fields string"


def log_lot(spark, path, rows):
    spark.createDataFrame(rows, LOG).repartition(2).write.mode("append").parquet(path)


def test_the_first_log_row_of_a_url_counts_over_batches(spark, tmp_path):
    arriving, state, out = (str(tmp_path / n) for n in ("in", "state", "out"))

    def run(rows, memory_ms=retry.DAY_MS):
        log_lot(spark, arriving, rows)
        logs = ingest.stream_table(spark, arriving, spark.createDataFrame([], LOG).schema)
        found = retry.first_candidates(logs, memory_ms)
        ingest.per_batch(found, lambda batch, n: ingest.write_batch(batch, out, n), state).awaitTermination()
        return sorted(map(str, (tuple(r)[:4] for r in spark.read.parquet(out).collect())))

    row = lambda *values: str(values)
    lot = [
        (7, "a_scrape_log.csv", "u1", "none", "9"),
        (3, "a_scrape_log.csv", " u1 ", "no_stats", "5"),
        (1, "a_scrape_log.csv", "u1", "none", "99"),  # asks for no retry
        (4, "b_scrape_log.csv", "u1", "none", "4"),
        (None, "b_scrape_log.csv", "u2", "none", "7"),
        (2, "b_scrape_log.csv", "u2", "none", "8"),
        (5, None, None, "no_lineups", None),
    ]
    first = [row("a", "u1", "no_stats", "5"), row("b", "u1", "low_fields", "4"), row("b", "u2", "low_fields", "7"), row(None, None, "no_lineups", None)]
    assert run(lot) == sorted(first)
    later = run([(8, "a_scrape_log.csv", "u1", "none", "1"), (9, "a_scrape_log.csv", "u3", "none", "2")])
    assert later == sorted([*first, row("a", "u3", "low_fields", "2")])
    again = run([(10, "a_scrape_log.csv", "u1", "none", "3")], memory_ms=1)  # tried longer ago than that
    assert again == sorted([*first, row("a", "u3", "low_fields", "2"), row("a", "u1", "low_fields", "3")])


def test_the_retry_stream_remembers_urls_without_python_for_each_of_them(spark, tmp_path, monkeypatch):
    arriving, state, patches, log = (str(tmp_path / n) for n in ("in", "state", "patches", "log"))
    address = lambda n: f"https://us.site.com/game/x/?mid={n}"
    collected = spark.createDataFrame(
        [(address(n), "", 50, "", "", "new") for n in (1, 2, 3)],
        "url string, status string, non_empty_fields int, match_id string, scraped_at string, stadium string",
    )
    base = spark.createDataFrame([("a", str(n)) for n in (1, 2)], "stem string, match_id string")
    stems = spark.createDataFrame([("a",)], "stem string")
    streams = []

    def per_batch(rows, step, checkpoint):
        streams.append(rows._jdf.queryExecution().analyzed().toString())
        return ingest.per_batch(rows, lambda batch, n: (step(batch, n), step(batch, n)), checkpoint)  # each batch comes twice

    monkeypatch.setattr(retry, "per_batch", per_batch)

    def run(rows, memory_ms=retry.DAY_MS):
        log_lot(spark, arriving, rows)
        logs = ingest.stream_table(spark, arriving, spark.createDataFrame([], LOG).schema)
        retry.retry_stream(logs, collected, base, stems, patches, log, state, memory_ms).awaitTermination()
        rows = spark.read.parquet(log).select("file_name", F.regexp_extract("url", "mid=(.*)$", 1).alias("mid"), "fields_before", "row_updated")
        return sorted(map(str, map(tuple, rows.collect())))

    row = lambda *values: str(values)
    name = lambda stem: f"{stem}_match_data.csv"
    first = [row(name("a"), "1", 5, True), row(name("b"), "1", 4, False), row(name("b"), "2", 7, False), row(None, None, None, False)]
    got = run([
        (7, "a_scrape_log.csv", address(1), "none", "9"),
        (3, "a_scrape_log.csv", f" {address(1)} ", "no_stats", "5"),
        (1, "a_scrape_log.csv", address(1), "none", "99"),
        (4, "b_scrape_log.csv", address(1), "none", "4"),
        (None, "b_scrape_log.csv", address(2), "none", "7"),
        (2, "b_scrape_log.csv", address(2), "none", "8"),
        (5, None, None, "no_lineups", None),
    ])
    assert got == sorted(first)
    later = run([(8, "a_scrape_log.csv", address(1), "none", "1"), (9, "a_scrape_log.csv", address(3), "none", "2"), (6, None, None, "no_stats", None)])
    assert later == sorted([*first, row(name("a"), "3", 2, False)])
    again = run([(10, "a_scrape_log.csv", address(1), "none", "3")], memory_ms=1)  # tried longer ago than that
    assert again == sorted([*later, row(name("a"), "1", 3, True)])
    assert not any("InPandas" in s for s in streams)


def test_write_back_leaves_other_stems_alone(spark, tmp_path):
    path = str(tmp_path / "stored")
    rows = [(s, n, str(n % 3), f"v{n}", "x") for s in ("a", "b", "c") for n in range(9)] + [("a", 9, None, "no id", "x"), ("a", 10, "", "blank", "x")]
    base = spark.createDataFrame(rows, "stem string, line int, match_id string, v string, w string")
    base.write.partitionBy("stem").parquet(path)
    files = lambda: {str(p.relative_to(tmp_path)): p.read_bytes() for p in tmp_path.rglob("*.parquet")}
    before = files()
    patches = spark.createDataFrame(
        [("a", "1", "new"), ("b", "7", "id not there"), ("d", "1", "no such stem"), (None, "1", "no stem"), ("a", "", "blank id")],
        "stem string, match_id string, v string",
    )
    assert plan.write_back(spark, path, base.schema, patches, "line", ["v", "w"]) == ["a"]
    after = files()
    assert {f for f in before if "stem=a" not in f} == {f for f in after if "stem=a" not in f}
    assert all(after[f] == data for f, data in before.items() if "stem=a" not in f)
    expected = {(s, n, i, "new" if (s, n) == ("a", 1) else v, "" if (s, n) == ("a", 1) else w) for s, n, i, v, w in rows}
    assert {tuple(r) for r in spark.read.schema(base.schema).parquet(path).select(base.columns).collect()} == expected
    assert plan.write_back(spark, path, base.schema, patches.where("stem = 'd'"), "line", ["v", "w"]) == []
    assert files() == after


def test_urls_wait_without_python_for_each_of_them(spark, tmp_path):
    lists, pages, state, out = (str(tmp_path / n) for n in ("lists", "pages", "state", "out"))
    found = []

    def step(batch, batch_id):
        touched = batch.persist()
        ready = {r["url"] for r in touched.where("ready").collect()}
        found.append((ready, *({r["url"] for r in part.collect()} for part in waiting.waiting_and_late(touched, out, batch_id))))

    def run(listed, arrived, patience_ms):
        for path, urls in ((lists, listed), (pages, arrived)):
            spark.createDataFrame([(u,) for u in urls], "url string").write.mode("append").parquet(path)
        schema = spark.createDataFrame([], "url string").schema
        streams = [ingest.stream_table(spark, path, schema) for path in (lists, pages)]
        rows = waiting.waiting(*streams, patience_ms)
        assert "InPandasWithState" not in rows._jdf.queryExecution().analyzed().toString()
        ingest.per_batch(rows, step, state, "update").awaitTermination()
        return found[-1]

    hour = 3_600_000
    assert run(["a", "a", "b", "c"], ["a", "x"], hour) == ({"a"}, {"b", "c"}, set())
    assert run(["d", "a", "x"], ["b", "a"], 1) == ({"b", "x"}, {"c", "d"}, set())
    assert run(["c"], [None], 1) == (set(), {"c"}, {"d"})  # c waits anew, and not for long
    assert run(["d", "e"], [], hour) == (set(), {"e"}, {"c"})  # late only once
    assert run(["c"], ["d", "c"], hour) == ({"c", "d"}, {"e"}, set())
    assert run(["a"], ["c", "x"], hour) == (set(), {"e"}, set())
    assert len(found) == 6


def test_urls_of_a_wide_table_are_not_broadcast(spark, tmp_path):
    urls = spark.range(50).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("url"))
    empty = [F.lit(None).cast("string").alias(f"c{i}") for i in range(120)]
    urls.where("url < 'u3'").select("url", *empty).write.parquet(str(tmp_path / "saved"))
    rest = ingest.without_page(urls, str(tmp_path / "saved"))
    rows = rest.collect()
    assert "Broadcast" not in rest._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["url"] for r in rows) == sorted(f"u{i}" for i in range(50) if f"u{i}" >= "u3")
