from __future__ import annotations

import pytest
from compare import rows
from pyspark.sql import functions as F

from tagloom.operators import joins, labels

DATA = [("1", ["COVID-19", "SARS-CoV-2", "COVID-19"]), ("2", ["Malaria"]), ("3", [])]
SCHEMA = "pmid string, meshMajor array<string>"


def test_vocabulary_is_dense_and_sorted(frame):
    assert rows(labels.build_vocabulary(frame(DATA, SCHEMA))) == [
        (0, "COVID-19"), (1, "Malaria"), (2, "SARS-CoV-2"),
    ]


def test_encoding_keeps_order_repeats_and_empty_rows(frame):
    df = frame(DATA, SCHEMA)
    coded = labels.encode_labels(df, labels.build_vocabulary(df))
    assert rows(coded) == [("1", [0, 2, 0]), ("2", [1]), ("3", [])]
    hot = labels.encode_multi_hot(coded, 3)
    assert rows(hot, "pmid", "multi_hot") == [("1", [1, 0, 1]), ("2", [0, 1, 0]), ("3", [0, 0, 0])]
    named = labels.decode_labels(coded.select("pmid", F.explode("label_ids").alias("label_id")), labels.build_vocabulary(df))
    assert named.filter("label = 'COVID-19'").count() == 2


def test_unknown_labels(frame):
    df = frame(DATA, SCHEMA)
    known = labels.build_vocabulary(df).filter("label <> 'Malaria'")
    assert rows(labels.unknown_labels(df, known)) == [("Malaria", 1)]
    with pytest.raises(Exception, match="unknown label: Malaria"):
        labels.encode_labels(df, known).collect()
    assert rows(labels.encode_labels(df, known, on_unknown="drop")) == [("1", [0, 2, 0]), ("2", []), ("3", [])]
    with pytest.raises(ValueError):
        labels.encode_labels(df, known, on_unknown="keep")


def test_multi_hot_edges(spark):
    df = spark.createDataFrame([([0, 4],), ([],), ([0, 1, 2, 3, 4],), ([9],)], "label_ids array<int>")
    got = [r.multi_hot for r in labels.encode_multi_hot(df, 5).collect()]
    assert got == [[1, 0, 0, 0, 1], [0] * 5, [1] * 5, [0] * 5]


def test_counts_and_rare_tags(frame, spark):
    counts = labels.tag_counts(frame(DATA, SCHEMA))
    assert rows(counts) == [("COVID-19", 2), ("Malaria", 1), ("SARS-CoV-2", 1)]
    assert rows(labels.rare_tags(counts, min_examples=2)) == [("Malaria", 1), ("SARS-CoV-2", 1)]
    wanted = spark.createDataFrame([("Malaria",), ("COVID-19",), ("none",)], "label string")
    assert rows(labels.rare_tags(counts, wanted)) == [("COVID-19", 2), ("Malaria", 1)]
    assert rows(labels.rare_tags(counts, wanted, 2)) == [("Malaria", 1)]
    assert rows(labels.tag_extremes(counts, 1)) == [("biggest", "COVID-19(2)"), ("smallest", "SARS-CoV-2(1)")]


def test_annotation_tasks(spark):
    df = spark.createDataFrame([("x", ["A"], "g1")], "text string, tags array<string>, grant_id string")
    vocabulary = spark.createDataFrame([("A",), ("B",)], "label string")
    train = labels.annotation_tasks(df, vocabulary)
    assert rows(train) == [("x", "A", "accept"), ("x", "B", "reject")]
    teach = labels.annotation_tasks(df, vocabulary, "teach").first()
    assert (teach.text, teach.meta.grant_id) == ("x", "g1")
    with pytest.raises(ValueError):
        labels.annotation_tasks(df, vocabulary, "other")


def test_annotation_labels_in_many_chunks(spark, monkeypatch):
    names = [f"l{i:02d}" for i in range(23)]
    df = spark.createDataFrame([(f"t{i}", names[i : i + 2]) for i in range(9)], "text string, tags array<string>")
    vocabulary = spark.createDataFrame([(n,) for n in names], "label string")
    expected = sorted(
        ((f"t{i}", n, "accept" if n in names[i : i + 2] else "reject") for i in range(9) for n in names), key=repr
    )
    assert rows(labels.annotation_tasks(df, vocabulary, labels_per_chunk=5)) == expected
    monkeypatch.setattr(labels, "BROADCAST_ROWS", 5)
    assert rows(labels.annotation_tasks(df, vocabulary, labels_per_chunk=5)) == expected


@pytest.mark.parametrize("names", [joins.LITERAL_NAMES, 1])
def test_rows_of_equal_or_null_key_keep_their_own_labels(frame, monkeypatch, names):
    data = [("1", ["a", "b"]), ("1", ["c"]), (None, ["a"]), (None, None), ("2", ["b", None, "b"]), ("3", [])]
    df = frame(data, SCHEMA)
    monkeypatch.setattr(joins, "LITERAL_NAMES", names)
    coded = labels.encode_labels(df, labels.build_vocabulary(df))
    assert rows(coded) == sorted(
        [("1", [0, 1]), ("1", [2]), (None, [0]), (None, []), ("2", [1, 1]), ("3", [])], key=repr
    )
    known = labels.build_vocabulary(df).filter("label <> 'b'")
    with pytest.raises(Exception, match="unknown label: b"):
        labels.encode_labels(df, known).collect()


def test_sparse_labels(spark):
    df = spark.createDataFrame([([4, 0, 4, 9],), ([],)], "label_ids array<int>")
    assert [tuple(r.labels) for r in labels.encode_sparse(df, 5).collect()] == [(5, [0, 4]), (5, [])]


@pytest.mark.parametrize("names", [200, 0])
def test_annotation_sets_say_the_same_as_the_tasks(spark, monkeypatch, names):
    monkeypatch.setattr(joins, "LITERAL_NAMES", names)
    table = [("a", ["y", "x", "x", None]), ("a", ["z"]), ("b", []), ("c", None), (None, ["x", "w"]), ("d", ["w"])]
    df = spark.createDataFrame(table, "text string, tags array<string>")
    vocabulary = spark.createDataFrame([("x",), ("y",), ("z",), ("x",), (None,)], "label string").dropna()
    sets = labels.annotation_sets(df, vocabulary)
    assert rows(sets.withColumn("accept", F.concat_ws("|", "accept"))) == rows(
        spark.createDataFrame(
            [("a", "x|y", 1), ("a", "z", 2), ("b", "", 3), ("c", "", 3), (None, "x", 2), ("d", "", 3)],
            "text string, accept string, n_reject int",
        )
    )
    told = sets.select("text", F.explode("accept").alias("label"))
    tasks = labels.annotation_tasks(df, vocabulary).filter("answer = 'accept'")
    assert rows(told) == rows(tasks.select("text", "label"))
    assert labels.annotation_sets(df.limit(0), vocabulary).count() == 0
    none = labels.annotation_sets(df, vocabulary.limit(0))
    assert {(len(r.accept), r.n_reject) for r in none.collect()} == {(0, 0)}
