"""What the planner must make of the operators."""

from __future__ import annotations

import os
import re

import pytest
from compare import rows
from pyspark.sql import functions as F

import __spark_entry__ as driver
from tagloom.operators import filters, labels, metrics, ordering, predictions, sampling
from tagloom.plans import views

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"Exchange (hash|range|Single|RoundRobin)", plan(df)))


LAZY = (
    "filter_years filter_tags_any filter_article filter_pred_in_terms project_tagged_text agg_tag_counts "
    "agg_micro_prf agg_confusion_multilabel agg_kappa agg_jaccard_samples semijoin_subtree "
    "antijoin_exclusions join_two_taggers crossjoin_annotation sample_stratified split_random topk_labels"
).split()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_or_nested_loop_join(spark, name):
    text = plan(driver.queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_filters_and_columns_reach_the_scan(spark):
    orders = views.table(spark, FOLDER, "orders").withColumn("year", F.col("o_orderpriority"))
    text = plan(filters.filter_years(orders, ["1-URGENT"]).select("o_orderkey"))
    assert "PushedFilters: [In(o_orderpriority" in text or "PushedFilters: [IsNotNull(o_orderpriority)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderpriority:string>" in text


def test_tag_filters_do_not_shuffle(spark):
    rows = views.table(spark, FOLDER, "documents").withColumn("tags", F.array("lang", "source"))
    terms = spark.createDataFrame([("en",), ("src1",)], "name string")
    assert shuffles(filters.filter_tags_any(rows, ["en"], "tags")) == 0
    assert shuffles(filters.filter_pred_in_terms(rows, terms)) == 0


def test_random_split_does_not_move_rows(spark):
    rows = views.table(spark, FOLDER, "documents")
    assert shuffles(sampling.split_random(rows, "doc_id", 0.1)) == 0


def test_stratified_sample_does_not_move_texts(spark):
    rows = views.grants(spark, FOLDER)
    out = sampling.sample_stratified(rows, "for_first_level_name", "doc_id", 5)
    assert shuffles(out) == 0 and "BroadcastHashJoin" in plan(out)


def test_numbering_lines_moves_one_row_per_split(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x" * 1_000 + "\n" + "y\n" * 100_000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        text = plan(ordering.head_lines(spark.read.text(str(tmp_path)), 500))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "rangepartitioning" not in text


def test_encoding_labels_does_not_shuffle(spark):
    rows = views.texts(spark, FOLDER).withColumn("tags", F.array(F.lit("en")))
    vocabulary = spark.createDataFrame([(0, "en")], "label_id int, label string")
    assert shuffles(labels.encode_labels(rows, vocabulary, "doc_id", "tags")) == 0


@pytest.mark.parametrize("name", ["join_encode_labels", "join_decode_labels", "encode_multi_hot", "src_column_stream", "encode_fixed_length"])
def test_encoding_runs_no_python(spark, name):
    text = plan(driver.queries()[name](spark, FOLDER))
    assert "Python" not in text and "Pandas" not in text and "Arrow" not in text


def test_top_k_is_cut_before_the_shuffle(spark):
    text = plan(predictions.topk_labels(views.scores_a(spark, FOLDER), 3))
    assert "WindowGroupLimit" in text


def test_report_shuffles_the_pairs_once(spark):
    truth = spark.range(50).selectExpr("id AS doc_id", "concat('l', id % 3) AS label")
    scores = truth.withColumn("score", F.lit(0.7))
    pairs = metrics.judged(truth, scores, [0.5], by="doc_id")
    per_doc = metrics.counts_per(pairs, ["doc_id"], [0.5])
    assert shuffles(per_doc) == 1


def test_line_items_are_spread_before_they_are_grouped(spark, tmp_path, monkeypatch):
    """No task groups all it has read: nearly each line item has a document and label of its own."""
    lines = [(i // 3, i % 7, float(i % 50), 0.1 * (i % 3), "FO"[i % 2]) for i in range(90)] + [(None, 1, 5.0, 0.1, "F"), (3, None, 5.0, 0.1, "F")]
    schema = "l_orderkey long, l_partkey long, l_quantity double, l_discount double, l_linestatus string"
    spark.createDataFrame(lines, schema).write.parquet(str(tmp_path / "lineitem.parquet"))
    parts = spark.createDataFrame([(i, f"b{i % 4}") for i in range(7)], "p_partkey long, p_brand string")
    parts.write.parquet(str(tmp_path / "part.parquet"))
    d = str(tmp_path)
    for view in (views.docs, views.truth, views.scores_a, views.scores_b, views.scores_c):
        want = rows(view(spark, d))
        with monkeypatch.context() as patch:
            patch.setattr(views, "ROWS_IN_ONE_TASK", 9)
            found = view(spark, d)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert rows(found) == want and len(want) > 20
        assert "HashAggregate" not in plan.split("REPARTITION_BY_NUM")[1] and "HashAggregate" in plan
