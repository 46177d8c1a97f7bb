from __future__ import annotations

import datetime
import json

from compare import rows
from pyspark.sql import functions as F

from tagloom import schemas
from tagloom.operators.labels import build_vocabulary
from tagloom.sources import monthly, records, sinks

ARTICLES = [
    {"journal": "J1", "meshMajor": ["Alpine Flora", "Glaciers"], "year": "1987", "abstractText": "aé", "title": "t1", "pmid": "1"},
    {"journal": "J2", "meshMajor": ["Tides"], "year": 1987, "abstractText": "b", "pmid": "2", "title": "t2"},
]


def test_articles_load_text_and_number_years(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text("\n".join(json.dumps(a) for a in ARTICLES))
    good, bad = records.read_articles(spark, str(path))
    got = good.orderBy("pmid").collect()
    assert bad.count() == 0
    assert [r.year for r in got] == ["1987", "1987"]
    assert [r.meshMajor for r in got] == [["Alpine Flora", "Glaciers"], ["Tides"]]


def wrapped(tmp_path, *lines, encoding="latin-1"):
    path = tmp_path / "w.json"
    path.write_bytes("\n".join(['{"articles":[', *lines]).encode(encoding))
    return str(path)


def test_wrapped_articles(spark, tmp_path):
    one, two = (json.dumps(a, ensure_ascii=False) for a in ARTICLES)
    path = wrapped(tmp_path, one + ",", '{"broken": ,', two + ",", "")
    good, bad = records.read_articles_wrapped(spark, path)
    assert rows(good, "pmid", "abstractText") == [("1", "aé"), ("2", "b")]
    assert rows(bad) == [('{"broken": ,',)]


def test_wrapped_articles_end_in_any_way(spark, tmp_path):
    one, two = (json.dumps(a) for a in ARTICLES)
    for end in ("", ",", "]}", "]"):
        good, bad = records.read_articles_wrapped(spark, wrapped(tmp_path, one + ",", two + end))
        assert good.count() == 2 and bad.count() == 0, end
    good, bad = records.read_articles_wrapped(spark, wrapped(tmp_path, one + ",", two, "]}"))
    assert good.count() == 2 and bad.count() == 0


def test_wrapped_articles_are_filtered(spark, tmp_path):
    path = wrapped(tmp_path, *[json.dumps(a) + "," for a in ARTICLES])
    assert rows(records.read_articles_wrapped(spark, path, tags=["Tides"])[0], "pmid") == [("2",)]
    assert records.read_articles_wrapped(spark, path, years=["1990"])[0].count() == 0


def test_wrapped_articles_in_utf8(spark, tmp_path):
    path = wrapped(tmp_path, json.dumps(ARTICLES[0], ensure_ascii=False) + ",", encoding="utf-8")
    good, _ = records.read_articles_wrapped(spark, path, encoding="UTF-8")
    assert good.first().abstractText == "aé"


def test_odd_characters_survive(spark, tmp_path):
    odd = dict(ARTICLES[0], abstractText='say "x", \\ tab\t end; #hash', title="  pad  ")
    good, bad = records.read_articles_wrapped(spark, wrapped(tmp_path, json.dumps(odd) + ","))
    row = good.first()
    assert (row.abstractText, row.title) == (odd["abstractText"], odd["title"]) and bad.count() == 0


def test_tagged_text_with_any_meta(spark, tmp_path):
    path = tmp_path / "t.jsonl"
    data = [
        {"text": "a", "tags": ["x"], "meta": {"g": "1", "n": 2}},
        {"text": "b", "tags": [], "meta": ""},
        {"text": "c", "tags": ["y"], "meta": {}},
    ]
    path.write_text("\n".join(json.dumps(r) for r in data))
    got, bad = records.read_tagged_text(spark, str(path))
    assert bad.count() == 0
    assert [(r.text, r.meta) for r in got.orderBy("text").collect()] == [
        ("a", {"g": "1", "n": "2"}), ("b", {}), ("c", {}),
    ]
    assert rows(records.flatten_meta(got, ["g"])) == sorted([("1", "a"), (None, "b"), (None, "c")], key=repr)
    vocabulary = spark.createDataFrame([(0, "x"), (1, "y")], "label_id int, label string")
    assert rows(records.tags(got, vocabulary)) == [([0, 0],), ([0, 1],), ([1, 0],)]
    sparse = [tuple(r.tags) for r in records.tags(got, vocabulary, dense=False).collect()]
    assert sorted(sparse) == [(2, []), (2, [0]), (2, [1])]
    assert records.texts(got).columns == ["text"]


def test_parquet_subset(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(80).repartition(8).write.parquet(path)
    part = records.read_parquet_subset(spark, path, 3, ["id"])
    again = records.read_parquet_subset(spark, path, 3, ["id"])
    assert rows(part) == rows(again) and len(part.inputFiles()) == 3
    assert records.read_parquet_subset(spark, path, 99).count() == 80
    assert records.read_parquet_subset(spark, path, 2, seed=None).count() < 80


def test_csv_by_name(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text('name,category_id,other\n"a, ""b""\nc",7,x\n')
    assert rows(records.read_csv(spark, str(path), schemas.CATEGORY)[0]) == [("7", 'a, "b"\nc')]


def test_taxonomy_xml(spark, tmp_path):
    path = tmp_path / "d.xml"
    path.write_text(
        """<DescriptorRecordSet>
        <DescriptorRecord><DescriptorUI>D1</DescriptorUI><DescriptorName><String>One</String></DescriptorName>
          <Annotation>general: Do not use</Annotation>
          <TreeNumberList><TreeNumber>A01.1</TreeNumber><TreeNumber>B02</TreeNumber></TreeNumberList></DescriptorRecord>
        <DescriptorRecord><DescriptorUI>D2</DescriptorUI><DescriptorName><String>Two</String></DescriptorName></DescriptorRecord>
        </DescriptorRecordSet>"""
    )
    got = [tuple(r) for r in records.read_taxonomy(spark, str(path)).orderBy("ui").collect()]
    assert got == [
        ("D1", "One", "general: Do not use", "A01.1", ["A01.1", "B02"]),
        ("D2", "Two", None, None, None),
    ]


def test_terms(spark, tmp_path):
    path = tmp_path / "t.txt"
    path.write_text("a \n\n b\nc\n")
    assert rows(records.read_terms(spark, str(path))) == [("a",), ("b",), ("c",)]
    assert rows(records.read_terms(spark, str(path), trim=False)) == [(" b",), ("a ",), ("c",)]


def test_publications_as_one_array(spark, tmp_path):
    path = tmp_path / "pubs.json"
    path.write_text(json.dumps([{"title": "t", "abstract": "x", "mesh_terms": ["A/b*"]}] * 3))
    good, bad = records.read_publications(spark, str(path))
    assert good.count() == 3 and bad.count() == 0


def test_malformed_publications_are_quarantined_whole(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"title": "t"}]))
    (tmp_path / "b.json").write_text('[{"title": "é"')
    good, bad = records.read_publications(spark, str(tmp_path))
    assert rows(good, "title") == [("t",)] and rows(bad) == [('[{"title": "é"',)]
    (tmp_path / "c.txt").write_text('{"title": "t"}\n{"title": \n\n')
    good, bad = records.read_publications(spark, str(tmp_path / "c.txt"), "lines")
    assert rows(good, "title") == [("t",)] and rows(bad) == [('{"title": ',)]


def test_malformed_lines_are_quarantined_whole(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    lines = [json.dumps(ARTICLES[0]), "{broken é", "[1]", "7", "", json.dumps(ARTICLES[1])]
    path.write_bytes("\n".join(lines).encode("latin-1"))
    good, bad = records.read_articles(spark, str(path), encoding="ISO-8859-1")
    assert rows(good, "pmid") == [("1",), ("2",)]
    assert {"{broken é", "7"} <= {r.line for r in bad.collect()} and good.count() + bad.count() == 5
    good, bad = records.read_articles(spark, str(path), encoding="ISO-8859-1", max_rows=2)
    assert rows(good, "pmid") == [("1",)] and bad.count() == 1
    (tmp_path / "t.jsonl").write_text('{"text": "a"}\n{"text": \n')
    good, bad = records.read_tagged_text(spark, str(tmp_path / "t.jsonl"))
    assert good.count() == 1 and rows(bad) == [('{"text": ',)]


def test_control_characters_do_not_cut_lines(spark, tmp_path):
    odd = dict(ARTICLES[0], title="a\u0001b")
    good, bad = records.read_articles_wrapped(spark, wrapped(tmp_path, json.dumps(odd) + ",", "x\u0001y,"))
    assert good.first().title == "a\u0001b" and rows(bad) == [("x\u0001y,",)]


def test_dataset_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [("1", ["a"], "train"), ("2", ["b"], "test")], "pmid string, meshMajor array<string>, split string"
    )
    sinks.write_dataset(df, build_vocabulary(df), str(tmp_path / "d"))
    train, vocabulary = sinks.read_dataset(spark, str(tmp_path / "d"))
    assert rows(train, "pmid") == [("1",)] and rows(vocabulary) == [(0, "a"), (1, "b")]
    plan = train._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    assert sinks.read_dataset(spark, str(tmp_path / "d"), split=None)[0].count() == 2


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"])], "id int, t array<string>")
    sinks.write_report(df, str(tmp_path / "c"), "csv")
    assert records.read_csv(spark, str(tmp_path / "c"), "id int, t string")[0].first().t == '["a","b"]'
    sinks.write_sample(df.withColumn("n", F.lit(None).cast("string")), str(tmp_path / "j"))
    assert '"n":null' in spark.read.text(str(tmp_path / "j")).first().value


def days(spark, *dates):
    return spark.createDataFrame([(d, d) for d in dates], "item string, d string").withColumn(
        "d", F.to_date("d")
    )


def test_a_year_gives_twelve_months(spark, tmp_path):
    path = str(tmp_path / "m")
    all_months = days(spark, *[f"2020-{m:02d}-1{m % 3}" for m in range(1, 13)], "2021-01-01")
    assert monthly.ingest_monthly(all_months, "d", path, year=2020).count() == 12
    assert monthly.read_months(spark, path).select("year", "month").distinct().count() == 12


def test_finished_months_stay_and_unfinished_are_redone(spark, tmp_path):
    path = str(tmp_path / "m")
    monthly.ingest_monthly(days(spark, "2020-01-05"), "d", path)
    # Left behind by a run that died before it could report February as finished.
    monthly.with_month(days(spark, "2020-02-28"), "d").write.mode("append").partitionBy(
        "year", "month"
    ).parquet(path + "/data")
    assert rows(monthly.read_months(spark, path), "item") == [("2020-01-05",)]
    todo = monthly.ingest_monthly(days(spark, "2020-01-31", "2020-02-01"), "d", path)
    assert rows(todo) == [(2020, 2)]
    assert rows(monthly.read_months(spark, path), "item") == [("2020-01-05",), ("2020-02-01",)]
    assert monthly.ingest_monthly(days(spark, "2020-01-31", "2020-02-01"), "d", path).count() == 0
    assert rows(monthly.read_months(spark, path), "item") == [("2020-01-05",), ("2020-02-01",)]


def test_undated_rows_of_all_runs_are_kept_once(spark, tmp_path):
    path = str(tmp_path)
    table = lambda *r: spark.createDataFrame(list(r), "item string, d date")
    day = datetime.date(2020, 1, 5)
    monthly.ingest_monthly(table(("a", None), ("a", None), ("b", day)), "d", path)
    monthly.ingest_monthly(table(("a", None), ("c", None)), "d", path)
    monthly.ingest_monthly(table(("e", day)), "d", path)
    assert rows(monthly.read_undated(spark, path), "item") == [("a",), ("a",), ("c",)]
    assert rows(monthly.read_months(spark, path), "item") == [("b",)]
