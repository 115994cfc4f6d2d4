from __future__ import annotations

import csv
import io
import random
import re

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from touchline import schemas
from touchline.plans.combine import combined
from touchline.sources import lists, records, sinks, tables


TEXT = st.text(alphabet='a,"', max_size=5)
PLAIN = st.text(alphabet='a"', max_size=5).filter(lambda v: not v.startswith('"'))


@settings(max_examples=2000, deadline=None)
@given(st.lists(st.tuples(st.booleans(), TEXT, PLAIN), max_size=5), TEXT, st.booleans(), st.booleans())
def test_open_values_of_lines_from_whole_and_open_values(fields, text, inside, opens):
    doubled = lambda v: v.replace('"', '""')
    made = [f'"{doubled(t)}"' if quoted else plain for quoted, t, plain in fields]
    made = [f'{doubled(text)}"', *made] if inside else made
    if opens:
        made.append('"' + doubled(text))
    assert records.ends_inside(",".join(made), inside) == opens
    assert records.ends_inside(doubled(text), True)


LINES = st.lists(st.text(alphabet='a,"\r', max_size=12), min_size=1, max_size=8)


@settings(max_examples=2000, deadline=None)
@given(LINES, st.booleans())
def test_open_values_of_many_lines_at_once(lines, inside):
    states = [inside]
    for line in lines:
        states.append(records.ends_inside(line, states[-1]))
    assert records.open_values(pa.array(lines, pa.string()), inside).tolist() == states


def values(n, seed):
    random.seed(seed)
    bits = ["x", "", "a,b", 'say "hi"', "two\nlines", "\n", "three\n\nlines, \"quoted\"\n", "é", "long " * 20, '5"', "\"\n\""]
    return [[str(i), *[random.choice(bits) for _ in range(3)]] for i in range(n)]


def as_csv(rows, end="\n", quoting=csv.QUOTE_MINIMAL):
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator=end, quoting=quoting).writerows(rows)
    return out.getvalue()


@pytest.fixture
def small_parts(spark):
    def set_to(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield set_to
    for name in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{name}")


@pytest.mark.parametrize("size", [40, 97, 333, 5000])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_files_cut_anywhere_give_the_records_of_the_csv_module(spark, tmp_path, small_parts, size, end):
    header = ["match_id", "round", "city", "stadium"]
    plain, turned = values(60, 1), values(45, 2)
    (tmp_path / "a.csv").write_text(as_csv([header, *plain], end), encoding="utf-8", newline="")
    (tmp_path / "b.csv").write_text(as_csv([header[::-1], *[r[::-1] for r in turned]], end, csv.QUOTE_ALL), encoding="utf-8", newline="")
    small_parts(size)
    read = tables.read_csv_text(spark, str(tmp_path), header)
    if size < 400:
        assert read.rdd.getNumPartitions() > 8
    got = sorted((r["file_name"], *[r[c] or "" for c in header]) for r in read.collect())
    assert got == sorted([("a.csv", *r) for r in plain] + [("b.csv", *r) for r in turned])


def test_a_value_over_many_parts_and_one_that_is_never_closed(spark, tmp_path, small_parts):
    long = "\n".join(f"line {i}" for i in range(300))
    (tmp_path / "a.csv").write_text(f'match_id,city\n1,"{long}"\n2,x\n3,"open\nto the end', encoding="utf-8")
    small_parts(100)
    got = {r["match_id"]: r["city"] for r in tables.read_csv_text(spark, str(tmp_path), ["match_id", "city"]).collect()}
    assert got["1"] == long and got["2"] == "x" and set(got) == {"1", "2", "3"}
    small_parts(1 << 20)
    assert tables.read_csv_text(spark, str(tmp_path), ["match_id"]).count() == 3


def test_quotes_inside_of_unquoted_values_are_characters(spark, tmp_path):
    (tmp_path / "a.csv").write_text('match_id,city,round\n1,5" pipe,r\n2,x"y"z,r\n3,"a ""b"" c",r\n', encoding="utf-8")
    got = {r["match_id"]: r["city"] for r in tables.read_csv_text(spark, str(tmp_path), ["match_id", "city"]).collect()}
    assert got == {"1": '5" pipe', "2": 'x"y"z', "3": 'a "b" c'}


def test_records_are_read_by_the_width_of_their_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("match_id,city,round,stadium\n1,x,r,s\n2,y\n3,z,r,s,more\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("city,match_id\nv,4\nw\nu,5,more\n", encoding="utf-8")
    read = tables.read_csv_text(spark, str(tmp_path), ["match_id", "city", "stadium", "venue"])
    got = sorted((r["city"], r["match_id"], r["stadium"], r["venue"], r["file_name"]) for r in read.collect())
    assert got == [("u", "5", None, None, "b.csv"), ("v", "4", None, None, "b.csv"), ("w", None, None, None, "b.csv"),
                   ("x", "1", "s", None, "a.csv"), ("y", "2", None, None, "a.csv"), ("z", "3", "s", None, "a.csv")]
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    widths = {schema.count("StructField(") for schema in re.findall(r"from_csv\((.*?)\(quote", plan)}
    assert widths == {2, 4}, plan


def test_no_files_give_no_rows(spark, tmp_path):
    assert tables.read_csv_text(spark, str(tmp_path), ["match_id"]).collect() == []
    assert tables.read_csv_text(spark, str(tmp_path)).columns == ["file_name"]


def test_lists_are_named_by_their_stem(spark, tmp_path):
    rows = [("x_cup_2024-2025", f"u{i:04d}") for i in range(900)] + [("y_current", "v")]
    links = spark.createDataFrame(rows, "stem string, url string").repartition(4)
    folder = str(tmp_path / "lists")
    for _ in range(2):  # the second time replaces the first
        names = sinks.write_lists(links, folder)
        assert sorted(names) == sorted(p.name for p in (tmp_path / "lists").iterdir() if not p.name.startswith("."))
        got = [(r["stem"], r["url"]) for r in lists.read_lists(spark, folder).collect()]
        assert sorted(got) == sorted(rows)
    numbered = [n for n in names if n.startswith("x_cup")]
    urls = [u for n in sorted(numbered, key=lambda n: (len(n), n)) for u in (tmp_path / "lists" / n).read_text().split()]
    assert urls == sorted(urls)
    sinks.write_lists(spark.createDataFrame([("x_cup_2024-2025", "only")], "stem string, url string"), folder)
    assert {(r["stem"], r["url"]) for r in lists.read_lists(spark, folder).collect()} == {("x_cup_2024-2025", "only"), ("y_current", "v")}
    sinks.write_links(links, str(tmp_path / "by_folder"))
    assert sorted((r["stem"], r["url"]) for r in lists.read_lists(spark, str(tmp_path / "by_folder")).collect()) == sorted(rows)


def test_season_comes_from_files_that_were_written_here(spark, tmp_path):
    rows = spark.createDataFrame([("m1", "cup_2024-2025"), ("m2", "cup_2026"), ("m3", "cup")], "match_id string, stem string")
    text = tables.conform(rows, schemas.all_strings(schemas.MATCH)).drop("x")
    sinks.write_matches(text.where("match_id = 'm1'"), str(tmp_path / "cup_2024-2025"), schemas.all_strings(schemas.MATCH))
    by_folder = combined(spark, str(tmp_path / "cup_2024-2025"), add_season=True)
    assert [(r["match_id"], r["season"]) for r in by_folder.collect()] == [("m1", "2024-2025")]
    sinks.write_season_files(rows.withColumn("city", F.lit("a\nb")).repartition(3), str(tmp_path / "named"))
    got = combined(spark, str(tmp_path / "named"), add_season=True)
    assert sorted((r["match_id"], r["season"], r["city"]) for r in got.collect()) == [("m1", "2024-2025", "a\nb"), ("m2", "2026", "a\nb"), ("m3", "unknown", "a\nb")]
