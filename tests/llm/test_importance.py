from __future__ import annotations

import math
from collections import Counter

import cases
import numpy as np
import pytest

from tagloom.llm import importance

LABELS = "doc_id long, quality int, toxic int"


def corpus(spark):
    rows = [(i, cases.prose(i, 60 + i)) for i in range(100)]
    rows += [(i, " ".join(f"junk{(i * j) % 37}%" for j in range(80))) for i in range(100, 140)]
    labels = [(i, 1, 0) for i in range(0, 60, 2)] + [(i, 0, 1) for i in range(100, 120)]
    labels += [(0, 1, 0), (4, None, 1), (2, 0, 0), (None, 1, 0), (9_999, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    return rows, docs, spark.createDataFrame(labels, LABELS)


def plain_weights(rows, targets):
    raw, good = Counter(), Counter()
    for doc, text in rows:
        found = Counter(importance.buckets_of(text).tolist())
        raw += found
        if doc in targets:
            good += found
    n, b = sum(raw.values()), importance.BUCKETS
    m = sum(good.values())
    return {
        doc: sum(
            c * (math.log((good[k] + 1) / (m + b)) - math.log((raw[k] + 1) / (n + b)))
            for k, c in Counter(importance.buckets_of(text).tolist()).items()
        )
        for doc, text in rows
    }


def test_weights_and_top_k_equal_a_plain_count(spark):
    rows, docs, labels = corpus(spark)
    found = {r["doc_id"]: r for r in importance.resample(docs, labels, fraction=0.7).collect()}
    targets = {i for i in range(0, 60, 2)} - {2} | {9_999}
    weights = plain_weights(rows, targets)
    assert all(found[d]["log_weight"] == pytest.approx(w, abs=1e-6) for d, w in weights.items())
    order = sorted(found, key=lambda d: -found[d]["key"])
    assert {d for d in found if found[d]["kept"]} == set(order[: round(0.7 * 140)])
    assert {d for d in found if found[d]["kept"]} >= set(range(90)) - set()


def test_target_rows_are_a_bounded_sample(spark):
    _, _, labels = corpus(spark)
    assert len(importance.target_ids(labels, most=5)) == 5
    whole = importance.target_ids(labels)
    assert 2 not in whole and 4 in whole and len(whole) == 30
    assert set(importance.target_ids(labels, most=5)) <= set(whole)


def test_noise_is_gumbel(spark):
    from pyspark.sql import functions as F

    values = np.array([r[0] for r in spark.range(20_000).select(importance.gumbel(F.col("id"), 3)).collect()])
    assert values.mean() == pytest.approx(0.5772, abs=0.04) and values.std() == pytest.approx(1.2825, abs=0.05)


@pytest.mark.parametrize("k", [0, 1, 17, 499, 500])
def test_cut_off_is_exact_with_ties(spark, monkeypatch, k):
    monkeypatch.setattr(importance, "NARROW", 3)
    monkeypatch.setattr(importance, "BINS", 4)
    keys = [float(i % 40) * 0.1 - 7 for i in range(500)]
    scored = spark.createDataFrame([(x,) for x in keys], "key double")
    low, high, m = importance.cut_off(scored, k) if k else (8.0, 8.0, 0)
    assert sum(x > high for x in keys) + m == k
    assert m <= sum(low <= x <= high for x in keys)
    if k:
        assert sorted(keys)[-k] >= low and all(x >= low for x in sorted(keys)[-k:])


def test_exactly_k_of_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a b c")] * 20 + [(2, None)] * 5 + [(None, "")] * 5, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0)], LABELS)
    rows = importance.resample(cases.clashing(docs), labels, fraction=0.5).collect()
    assert len(rows) == 30 and sum(r["kept"] for r in rows) == 15


def test_awkward_rows(spark, documents, nothing):
    labels = spark.createDataFrame([], LABELS)
    rows = importance.resample(documents, labels, fraction=1.0).collect()
    assert len(rows) == documents.count() and all(r["kept"] for r in rows)
    assert {r["log_weight"] for r in rows if r["doc_id"] in (4, 5, 6)} == {0.0}
    assert importance.resample(nothing, labels).count() == 0
    assert not any(r["kept"] for r in importance.resample(documents, labels, fraction=0.0).collect())


def test_toxic_documents_are_no_targets(spark, tmp_path):
    from tagloom.llm import queries

    rows, docs, labels = corpus(spark)
    # 4 is called toxic where its quality is null.
    assert importance.target_ids(labels, leave_toxic=True) and not {4, 9_999} & set(importance.target_ids(labels, leave_toxic=True))
    unknown = spark.createDataFrame([(1, 1, None), (2, 1, 1), (2, 1, 0), (3, 1, 0)], LABELS)
    assert sorted(importance.target_ids(unknown, leave_toxic=True)) == [1, 3]
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    weights = plain_weights(rows, {i for i in range(0, 60, 2)} - {2, 4})
    got = {r["doc_id"]: r["log_weight"] for r in queries.op9_importance(spark, str(tmp_path)).collect()}
    assert all(got[d] == pytest.approx(w, abs=1e-6) for d, w in weights.items())
