"""Whole jobs and the streaming twins, batch against stream."""

from __future__ import annotations

import json

import pandas as pd
import pytest
from compare import rows
from pyspark.sql import functions as F

from tagloom.operators.predictions import pandas_scorer, score_batch
from tagloom.plans import jobs
from tagloom.sources import records, sinks
from tagloom.streaming import jobs as streams

ARTICLES = [
    ("J", ["Alpine Flora", "Glaciers"], "1987", "meadows below the ice", "t1", "1"),
    ("J", ["Tides"], "1987", "the tides of a bay", "t2", "2"),
]


def word_scorer(*words):
    """Scores a label by whether its name occurs in the text."""

    def score(model, batch):
        out = [(d, w, 0.9) for d, t in zip(batch.doc_id, batch.text) for w in model if w.lower() in t]
        return pd.DataFrame(out, columns=["doc_id", "label", "score"])

    return pandas_scorer(lambda: list(words), score)


def test_preprocess_splits_in_half(spark, tmp_path):
    from tagloom import schemas

    df = spark.createDataFrame(ARTICLES, schemas.ARTICLE)
    out = jobs.preprocess(df, str(tmp_path / "d"), test_size=0.5, length=6)
    assert sorted(r.split for r in out.rows.collect()) == ["test", "train"]
    assert out.labels.count() == 3
    saved, vocabulary = sinks.read_dataset(spark, str(tmp_path / "d"), split=None)
    assert saved.count() == 2 and vocabulary.count() == 3
    assert set(saved.columns) == {
        "year", "meshMajor", "abstractText", "input_ids", "attention_mask", "label_ids", "split",
    }
    assert all(len(r.input_ids) == 6 for r in saved.collect())


def test_preprocess_keeps_rows_of_equal_and_null_key(spark):
    from tagloom import schemas

    data = [("J", ["a", "b"], "1990", "one two", "t", "1"), ("J", ["c"], "1990", "three", "t", "1")]
    data += [("J", ["a"], "1990", "two", "t", None), ("J", [], "1990", None, "t", None)]
    out = jobs.preprocess(spark.createDataFrame(data, schemas.ARTICLE), test_size=0.5, length=3).rows
    got = sorted((r.abstractText or "", r.meshMajor, len(r.label_ids), sum(r.attention_mask)) for r in out.collect())
    assert got == [("", [], 0, 0), ("one two", ["a", "b"], 2, 2), ("three", ["c"], 1, 1), ("two", ["a"], 1, 1)]


def test_preprocess_takes_the_first_rows(spark):
    from tagloom import schemas

    data = [("J", [f"T{i}"], "1990", f"text {i}", "t", str(100 - i)) for i in range(30)]
    df = spark.createDataFrame(data, schemas.ARTICLE).coalesce(1)
    out = jobs.preprocess(df, test_size=0.5, max_rows=7, length=3).rows.collect()
    assert sorted(r.abstractText for r in out) == [f"text {i}" for i in range(7)]


def test_preprocess_by_year_and_tag(spark):
    data = [("J", [f"T{i % 3}", "X"], str(2018 + i % 4), f"text {i}", "t", str(i)) for i in range(40)]
    from tagloom import schemas

    df = spark.createDataFrame(data, schemas.ARTICLE)
    out = jobs.preprocess(df, train_years=["2018"], test_years=[2020], tags=["T0", "T1"]).rows.collect()
    assert {(r.year, r.split) for r in out} == {("2018", "train"), ("2020", "test")}
    assert all("T2" not in r.meshMajor for r in out)
    with pytest.raises(ValueError):
        jobs.preprocess(df, train_years=["2018"])


def labelled(spark, n=60):
    words = ["malaria", "cholera", "dengue"]
    docs = [(i, f"about {words[i % 3]}" + (" and cholera" if i % 5 == 0 else "")) for i in range(n)]
    truth = [(i, words[i % 3].title()) for i in range(n)]
    return (
        spark.createDataFrame(docs, "doc_id int, text string"),
        spark.createDataFrame(truth, "doc_id int, label string"),
        spark.createDataFrame([(w.title(),) for w in words], "label string"),
    )


def test_evaluate(spark):
    docs, truth, vocabulary = labelled(spark)
    scorer = word_scorer("Malaria", "Cholera", "Dengue")
    out = jobs.evaluate(docs, truth, scorer, vocabulary, [0, 1, 0.5, 0.9], split_data=False)
    got = {r.threshold: (r.precision, r.recall) for r in out.results.collect()}
    assert len(got) == 4 and got[0.5][1] == 1.0 and got[0.9] == (0, 0)
    assert got[0.5][0] == pytest.approx(60 / 68)
    held_out = jobs.evaluate(docs, truth, scorer, vocabulary).report
    assert held_out.filter("name = 'micro avg'").first().support == 15


def test_tune(spark, tmp_path):
    docs, truth, vocabulary = labelled(spark)
    limits, result = jobs.tune(
        docs, truth, word_scorer("Malaria", "Cholera", "Dengue"), vocabulary, path=str(tmp_path / "t")
    )
    assert limits.count() == 3 and spark.read.parquet(str(tmp_path / "t")).count() == 3
    assert result.first().tuned_f1 > 0.8


def test_augment_writes_counts(spark, tmp_path):
    from tagloom import schemas

    df = spark.createDataFrame(ARTICLES, schemas.ARTICLE)
    requests = jobs.augment(df, str(tmp_path / "c"), min_examples=2, examples=2)
    assert requests.count() == 3 and spark.read.json(str(tmp_path / "c")).count() == 3


def test_sample_grants(spark, tmp_path):
    path = str(tmp_path / "g")
    spark.range(200).select(
        F.col("id").alias("grant_id"), F.lit("t").alias("title"), F.lit("on malaria").alias("abstract"),
        F.concat(F.lit("s"), F.col("id") % 3).alias("for_first_level_name"),
    ).repartition(4).write.parquet(path)
    out = jobs.sample_grants(spark, path, 4, 5, scorer=word_scorer("Malaria"))
    assert out.count() == 15 and {tuple(r.mesh_terms) for r in out.collect()} == {("Malaria",)}


def test_sample_publications(spark):
    data = [(i, [("c1" if i % 2 else "c9", "for"), ("c1", "sdg")]) for i in range(30)]
    pubs = spark.createDataFrame(data, "id int, categories array<struct<id: string, category_type: string>>")
    names = spark.createDataFrame([("c1", "One")], "category_id string, name string")
    out = jobs.sample_publications(pubs, names, ["for"], 20, "id")
    assert rows(out.groupBy("category_name").count()) == [("One", 20), ("unknown c9", 20)]


def test_compare_taggers(spark, tmp_path):
    grants = spark.createDataFrame(
        [(1, "malaria and dengue", "s"), (2, "cholera", "s"), (3, None, "s")],
        "doc_id int, abstract string, for_first_level_name string",
    )
    active = spark.createDataFrame([(10, "malaria again"), (11, None)], "doc_id int, Synopsis string")
    descriptors = spark.createDataFrame(
        [("D1", "Fevers", "C1", ["C1"]), ("D2", "Malaria", "C1.2", ["C1.2"]), ("D3", "Cholera", "C2", ["C2"])],
        "ui string, name string, tree_number string, tree_numbers array<string>",
    )
    terms = spark.createDataFrame([("Fevers",)], "name string")
    out = jobs.compare_taggers(
        grants, active, word_scorer("Malaria", "Dengue", "Cholera"), word_scorer("Malaria", "Cholera"),
        descriptors, terms, path=str(tmp_path / "x"),
    )
    assert rows(out, "doc_id", "active_portfolio", "common_terms", "a_only", "b_only") == [
        (1, 0, ["Malaria"], ["Dengue"], []), (10, 1, ["Malaria"], [], []),
    ]


def write_lines(folder, name, *articles):
    lines = ['{"articles":['] + [json.dumps(a, ensure_ascii=False) + "," if isinstance(a, dict) else a for a in articles]
    (folder / name).write_bytes("\n".join(lines).encode("latin-1"))


def test_convert_articles(spark, tmp_path):
    articles = [{"pmid": str(i), "year": str(2019 + i % 3), "meshMajor": ["Größe" if i % 2 else "Form"]} for i in range(12)]
    write_lines(tmp_path, "a.json", *articles, "brokén,")
    bad = jobs.convert_articles(spark, str(tmp_path / "a.json"), str(tmp_path / "out"), ["Größe"], [2019])
    got = records.read_articles(spark, str(tmp_path / "out"))[0]
    assert rows(got, "pmid", "year", "meshMajor") == [("3", "2019", ["Größe"]), ("9", "2019", ["Größe"])]
    assert rows(bad) == [("brokén,",)]


def test_convert_publications(spark, tmp_path):
    pubs = [{"title": "t", "abstract": "a", "mesh_terms": ["Tides"]}, {"title": "u", "abstract": "b", "mesh_terms": []}]
    (tmp_path / "p.json").write_text(json.dumps(pubs))
    (tmp_path / "q.json").write_text("[{")
    bad = jobs.convert_publications(spark, str(tmp_path / "[pq].json"), str(tmp_path / "out"))
    got = records.read_tagged_text(spark, str(tmp_path / "out"))[0].collect()
    assert [(r.text, r.tags, r.meta) for r in got] == [("a", ["Tides"], {"title": "t"})]
    assert rows(bad) == [("[{",)]


def test_descriptor_lists(spark, tmp_path):
    described = [("D1", "Fevers", "C1", ""), ("D2", "Murrain", "C22.1", ""), ("D3", "Gloom", "F03.2", "x: Do not use"), ("D4", "Tides", "G1", "")]
    body = "".join(
        f"<DescriptorRecord><DescriptorUI>{u}</DescriptorUI><DescriptorName><String>{n}</String></DescriptorName>"
        f"<Annotation>{a}</Annotation><TreeNumberList><TreeNumber>{t}</TreeNumber></TreeNumberList></DescriptorRecord>"
        for u, n, t, a in described
    )
    (tmp_path / "d.xml").write_text(f"<DescriptorRecordSet>{body}</DescriptorRecordSet>")
    (tmp_path / "x.csv").write_text("DescriptorName\nTides\n")
    source = str(tmp_path / "d.xml")
    jobs.list_usable_descriptors(spark, source, str(tmp_path / "x.csv"), str(tmp_path / "usable"))
    jobs.list_disease_descriptors(spark, source, str(tmp_path / "diseases"))
    assert rows(records.read_csv(spark, str(tmp_path / "usable"), "DescriptorName STRING")[0]) == [("Fevers",), ("Murrain",)]
    assert rows(records.read_csv(spark, str(tmp_path / "diseases"), "ui STRING, name STRING")[0]) == [("D1", "Fevers"), ("D3", "Gloom")]


def test_split_lines_keeps_every_line(spark, tmp_path):
    lines = [f"zeile ü{i % 40}".encode("latin-1") for i in range(95)]
    (tmp_path / "l.txt").write_bytes(b"\n".join(lines))
    jobs.split_lines(spark, str(tmp_path / "l.txt"), str(tmp_path / "out"), 0.25, buffer_rows=20)
    read = {
        name: [x for f in (tmp_path / "out" / name).glob("part-*") for x in f.read_bytes().split(b"\n") if x]
        for name in ("train", "test")
    }
    assert len(read["test"]) == 4 * 5 + 3
    assert sorted(read["train"] + read["test"]) == sorted(lines)


def test_stream_ingest_equals_batch_and_takes_files_once(spark, tmp_path):
    source, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    source.mkdir()
    articles = [{"pmid": str(i), "year": str(2020 + i % 2), "meshMajor": ["é"]} for i in range(6)]
    write_lines(source, "a.json", *articles[:3], "brokén,")
    write_lines(source, "b.json", *articles[3:5])
    streams.stream_ingest(spark, str(source), out, state, max_files=1).awaitTermination()
    write_lines(source, "c.json", articles[5])
    streams.stream_ingest(spark, str(source), out, state).awaitTermination()
    streams.stream_ingest(spark, str(source), out, state).awaitTermination()
    good, bad = records.read_articles_wrapped(spark, str(source))
    assert bad.first().line == "brokén,"
    taken = spark.read.parquet(out + "/articles").withColumn("year", F.col("year").cast("string"))
    assert rows(taken, "pmid", "year", "meshMajor") == rows(good, "pmid", "year", "meshMajor")
    assert taken.count() == 6
    refused = spark.read.schema("line string").parquet(out + "/quarantine")
    assert rows(refused, "line") == rows(bad) == [("brokén,",)]


def test_stream_score_equals_batch(spark, tmp_path):
    docs, _, _ = labelled(spark)
    scorer = word_scorer("Malaria", "Dengue")
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    docs.repartition(3).write.parquet(source)
    arriving = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(source)
    streams.stream_score(arriving, scorer, out, str(tmp_path / "state")).awaitTermination()
    got = spark.read.parquet(out)
    assert got.select("batch_id").distinct().count() > 1
    assert rows(got, "doc_id", "tags") == rows(score_batch(docs, scorer), "doc_id", "tags")
