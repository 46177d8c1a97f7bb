from __future__ import annotations

import pytest
from compare import rows
from pyspark.sql import functions as F

from tagloom.functions import text as fn
from tagloom.operators import filters as flt


@pytest.mark.parametrize(
    "year,tags,years,keep",
    [
        (2018, ["T1"], None, True),
        (2018, ["T3"], None, False),
        (2018, None, [2019, 2020], False),
        (2020, None, [2019, 2020], True),
        (2020, ["T1"], [2019, 2020], True),
        (2020, ["T1"], [2018], False),
        (2020, ["T3"], [2020], False),
        (2020, [], [], True),
    ],
)
def test_filter_article(spark, year, tags, years, keep):
    df = spark.createDataFrame(
        [("t", ["T1", "T2"], "j", year)],
        "abstractText string, meshMajor array<string>, journal string, year int",
    )
    assert flt.filter_article(df, tags, years).count() == int(keep)


def test_missing_field_skips_its_filter(spark):
    df = spark.createDataFrame([(1, None, None)], "id int, meshMajor array<string>, year int")
    assert flt.filter_article(df, ["T1"], [2020]).count() == 1
    assert flt.filter_article(df.drop("meshMajor"), ["T1"], None).count() == 1


def test_rows_keep_all_their_tags(frame):
    df = frame([("1", ["a", "b"]), ("2", ["c"])], "pmid string, meshMajor array<string>")
    assert rows(flt.filter_tags_any(df, ["b"])) == [("1", ["a", "b"])]


def test_long_tag_list_becomes_a_join(frame, monkeypatch):
    df = frame([(str(i), [f"t{i}", "x"]) for i in range(50)], "pmid string, meshMajor array<string>")
    wanted = [f"t{i}" for i in range(0, 50, 2)]
    inline = rows(flt.filter_tags_any(df, wanted), "pmid")
    monkeypatch.setattr(flt, "INLINE_ITEMS", 3)
    assert rows(flt.filter_tags_any(df, wanted), "pmid") == inline
    assert len(inline) == 25


@pytest.mark.parametrize("limit", [1, 10_000])
def test_rows_of_equal_or_null_key_are_judged_one_by_one(frame, monkeypatch, limit):
    monkeypatch.setattr(flt, "INLINE_ITEMS", limit)
    df = frame([(1, ["a"]), (None, ["a"]), (2, ["b"]), (1, ["b"]), (3, None)], "pmid int, meshMajor array<string>")
    kept = sorted([(1, ["a"]), (None, ["a"])], key=repr)
    assert rows(flt.filter_tags_any(df, ["a", "z"])) == kept
    terms = df.sparkSession.createDataFrame([("a",), ("z",), (None,)], "name string")
    assert rows(flt.filter_pred_in_terms(df, terms, field="meshMajor")) == kept


def test_category_types(frame):
    df = frame(
        [(1, [("c1", "for"), ("c2", "sdg")]), (2, None), (3, [None, ("c3", "hrcs_rac")])],
        "id int, categories array<struct<id: string, category_type: string>>",
    )
    kept = flt.filter_category_type(df, ["for", "hrcs_rac"])
    assert rows(kept.select("id", "category.id")) == [(1, "c1"), (3, "c3")]


def test_tree_branch(frame):
    df = frame([("C01",), ("C22.1",), ("F03.2",), ("F01",), (None,)], "tree_number string")
    assert rows(flt.filter_tree_branch(df)) == [("C01",), ("F03.2",)]


def test_headings(spark):
    df = spark.createDataFrame(
        [(["Malaria/drug therapy*", "Humans*", "A/B/C", "X**", "Humans"],)], "t array<string>"
    )
    assert df.select(fn.normalise_headings("t")).first()[0] == ["Malaria", "Humans", "A", "X*", "Humans"]


def test_lists(spark):
    df = spark.createDataFrame([("T1, T2,, ,T3",), (None,), ("",)], "s string")
    assert [r[0] for r in df.select(fn.parse_list("s")).collect()] == [["T1", " T2", "T3"], [], []]
    assert df.select(fn.parse_list("s", trim=True)).first()[0] == ["T1", "T2", "T3"]
    printed = spark.createDataFrame([("""['a', "b's", 'c\\'d', 'e, f']""",), ("[]",)], "s string")
    assert [r[0] for r in printed.select(fn.parse_term_list("s")).collect()] == [
        ["a", "b's", "c'd", "e, f"],
        [],
    ]


def test_prompt_fills_topic_before_abstract(spark):
    df = spark.createDataFrame([("T", "about {TOPIC}")], "t string, a string")
    assert df.select(fn.render_prompt("{TOPIC}|{ABSTRACT}", "t", "a")).first()[0] == "T|about {TOPIC}"


@pytest.mark.parametrize(
    "answer,good",
    [
        ('  {"abstract": "a", "title": "t"}\n', True),
        ('{"abstract": "a", "title": "t", "more": 1}', True),
        ('{"abstract": "a"}', False),
        ('{"title": "t"}', False),
        ("{'abstract': 'a', 'title': 't'}", False),
        ('{"abstract": "a", "title": "t"} bye', False),
        ('{"abstract": "a", "title": "t"}, {"abstract": "b", "title": "u"}', False),
        ("sorry", False),
        ("", False),
        (None, False),
    ],
)
def test_generated_answers(spark, answer, good):
    df = spark.createDataFrame([(answer,)], "a string")
    got = df.select(fn.parse_generated("a").alias("p")).first().p
    assert (got is not None) == good
    if good:
        assert tuple(got) == ("a", "t")


def test_tagged_text_keeps_other_columns(frame):
    df = frame(
        [("t", "x", ["A/b*"], 7), ("u", "y", [], 8)],
        "title string, abstract string, mesh_terms array<string>, other int",
    )
    out = flt.project_tagged_text(df).collect()
    assert [r.asDict() for r in out] == [
        {"other": 7, "text": "x", "tags": ["A"], "meta": {"title": "t"}}
    ]


def test_annotation_record(spark):
    df = spark.createDataFrame(
        [("x", ["A", "B"], "s")], "abstract string, mesh_terms array<string>, for_first_level_name string"
    )
    row = flt.project_annotation_record(df, "me").first()
    assert [tuple(p) for p in row.prediction] == [("A", 1.0), ("B", 1.0)]
    assert row.metadata.for_first_level_name == "s" and row.multi_label


def test_ngrams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],)], "t array<string>")
    got = [r[0] for r in df.select(fn.ngrams(F.col("t"), 1, 2)).collect()]
    assert got == [["a", "b", "c", "a b", "b c"], ["a"]]
