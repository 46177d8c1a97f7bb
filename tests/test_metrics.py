from __future__ import annotations

import random

import numpy as np
import pytest
from compare import rows

from tagloom.operators import agreement, metrics


def long(matrix, kind=None):
    out = []
    for i, row in enumerate(matrix):
        for j, v in enumerate(row):
            if v:
                out.append((i, f"l{j:03d}") if kind is None else (i, f"l{j:03d}", float(v)))
    return out


def tables(spark, y, scores):
    truth = spark.createDataFrame(long(y), "doc_id int, label string").repartition(3)
    scored = spark.createDataFrame(long(scores, float), "doc_id int, label string, score double").repartition(3)
    vocabulary = spark.createDataFrame([(f"l{j:03d}",) for j in range(y.shape[1])], "label string")
    return truth, scored, vocabulary


@pytest.fixture(scope="module")
def case(spark):
    r = np.random.default_rng(3)
    y = (r.random((100, 12)) < 0.2).astype(int)
    y[:, 5] = 0
    y[7] = 0
    scores = np.round(r.random((100, 12)), 1) * (r.random((100, 12)) < 0.6)
    scores[:, 9] = 0
    scores[7] = 0
    return y, scores, *tables(spark, y, scores)


def div(a, b):
    return a / b if b else 0.0


def test_confusion_of_every_label(case):
    y, scores, truth, scored, vocabulary = case
    got = metrics.confusion_counts(truth, scored, 100, vocabulary, [0.3, 0.7]).collect()
    assert len(got) == 24
    for r in got:
        j = int(r.label[1:])
        p = scores[:, j] > r.threshold
        t = y[:, j] == 1
        assert (r.tn, r.fp, r.fn, r.tp) == ((~t & ~p).sum(), (~t & p).sum(), (t & ~p).sum(), (t & p).sum())
        assert r.tn + r.fp + r.fn + r.tp == 100


def test_binary_confusion(spark):
    r = random.Random(5)
    y, p = ({i for i in range(100) if r.random() < 0.5} for _ in range(2))
    got = metrics.confusion(
        spark.createDataFrame([(i,) for i in y], "doc_id int"),
        spark.createDataFrame([(i,) for i in p], "doc_id int"),
        100,
    ).first()
    assert tuple(got) == (100 - len(y | p), len(p - y), len(y - p), len(y & p))


def test_micro_averages(case):
    y, scores, truth, scored, _ = case
    got = metrics.micro_prf(truth, scored, [0, 1, 0.5, 0.9]).collect()
    assert sorted(r.threshold for r in got) == [0, 0.5, 0.9, 1]
    for r in got:
        p = scores > r.threshold
        tp = (p & (y == 1)).sum()
        assert r.precision == div(tp, p.sum()) and r.recall == div(tp, y.sum())
        assert r.f1 == pytest.approx(div(2 * tp, p.sum() + y.sum()))
    assert metrics.micro_prf(truth, scored, [0.5]).count() == 1
    curve = [r.threshold for r in metrics.pr_curve(truth, scored).collect()]
    assert curve == [0.1, 0.2, 0.3, 0.4, 0.5]
    with pytest.raises(ValueError):
        metrics.micro_prf(truth, scored, [-0.1])


@pytest.mark.parametrize("swap", [False, True])
def test_report(case, swap):
    y, scores, truth, scored, vocabulary = case
    got = {(r.threshold, r.name): r for r in metrics.class_report(truth, scored, 100, vocabulary, [0.2, 0.6], swap).collect()}
    assert len(got) == 2 * (12 + 4)
    for th in (0.2, 0.6):
        t, p = y == 1, scores > th
        if swap:
            t, p = p, t
        tp, pp, pos = (t & p).sum(0), p.sum(0), t.sum(0)
        pr = np.array([[div(a, b), div(a, c), div(2 * a, b + c)] for a, b, c in zip(tp, pp, pos)])
        dtp, dpp, dpos = (t & p).sum(1), p.sum(1), t.sum(1)
        doc = np.array([[div(a, b), div(a, c), div(2 * a, b + c)] for a, b, c in zip(dtp, dpp, dpos)])
        expected = {f"l{j:03d}": [*pr[j], pos[j]] for j in range(12)}
        s = [tp.sum(), pp.sum(), pos.sum()]
        expected["micro avg"] = [div(s[0], s[1]), div(s[0], s[2]), div(2 * s[0], s[1] + s[2]), s[2]]
        expected["macro avg"] = [*pr.mean(0), s[2]]
        expected["weighted avg"] = [*((pr * pos[:, None]).sum(0) / s[2]), s[2]]
        expected["samples avg"] = [*doc.mean(0), s[2]]
        for name, values in expected.items():
            r = got[th, name]
            assert [r.precision, r.recall, r.f1, r.support] == pytest.approx(values), (th, name)


def test_pruned_report(case, spark):
    _, _, truth, scored, _ = case
    seen = spark.createDataFrame([("l001",), ("l004",), ("l001",)], "label string")
    names = {r.name for r in metrics.class_report_pruned(truth, scored, 100, seen).collect()}
    assert names == {"l001", "l004", *metrics.AVERAGES}


def test_f1_per_tag(case):
    y, scores, truth, scored, vocabulary = case
    got = {r.Tag: r.f1 for r in metrics.f1_per_tag(truth, scored, vocabulary, 0.5).collect()}
    assert got["l005"] == 0 and got["l009"] == 0
    p = scores[:, 1] > 0.5
    assert got["l001"] == pytest.approx(2 * (p & (y[:, 1] == 1)).sum() / (p.sum() + y[:, 1].sum()))


def test_minimum_score_counts_missing_pairs(frame):
    scores = frame([(0, "a", 0.5), (1, "a", 0.3), (0, "b", 0.7), (0, "c", -1.0)], "doc_id int, label string, score double")
    assert rows(metrics.label_min_score(scores, 2)) == [("a", 0.3), ("b", 0.0), ("c", -1.0)]


def test_formatted_results(spark):
    df = spark.createDataFrame([(0.5, 0.123, 0.456, 1.0)], "threshold double, precision double, recall double, f1 double")
    assert rows(metrics.formatted_results(df)) == [("0.50", "0.12", "0.46", "1.00")]


def test_partitions_do_not_matter(case, spark):
    _, _, truth, scored, vocabulary = case
    results = []
    for n in ("1", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(rows(metrics.confusion_counts(truth, scored, 100, vocabulary)))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1]


PAIRS = [
    (0, ["a", "b"], ["a"]),
    (1, ["b", "b"], ["c", "b"]),
    (2, [], []),
    (3, ["c", "zzz"], ["a", "zzz"]),
    (4, ["a"], ["a", "b"]),
]


@pytest.fixture
def pairs(frame):
    return frame(PAIRS, "doc_id int, a_terms array<string>, b_terms array<string>")


def test_agreement(pairs, spark):
    vocabulary = spark.createDataFrame([(x,) for x in "abcd"], "label string")
    kappas = []
    for x in "abc":
        a = np.array([x in p[1] for p in PAIRS])
        b = np.array([x in p[2] for p in PAIRS])
        po, pe = (a == b).mean(), a.mean() * b.mean() + (1 - a.mean()) * (1 - b.mean())
        kappas.append((po - pe) / (1 - pe))
    got = {r.metric: r.value for r in agreement.comparison_metrics(pairs, vocabulary).collect()}
    assert got["avg_cohen_kappa"] == pytest.approx(np.mean(kappas))
    assert got["a_avg_num_tags"] == 5 / 5 and got["b_avg_num_tags"] == 6 / 5
    share = [1 / 2, 1 / 2, 0, 0, 1 / 2]
    assert got["jaccard_score"] == pytest.approx(np.mean(share))
    plain = agreement.jaccard_samples(pairs).first().jaccard_score
    assert plain == pytest.approx(np.mean([1 / 2, 1 / 2, 0, 1 / 3, 1 / 2]))


def test_total_chance_agreement_is_undefined(spark):
    pairs = spark.createDataFrame([(0, ["a"], ["a"])], "doc_id int, a_terms array<string>, b_terms array<string>")
    vocabulary = spark.createDataFrame([("a",)], "label string")
    assert np.isnan(agreement.label_kappa(pairs, vocabulary, 1).first().kappa)


def test_sets(pairs):
    got = rows(agreement.only_terms(agreement.common_terms(pairs)), "doc_id", "common_terms", "a_only", "b_only")
    assert got[0] == (0, ["a"], ["b"], []) and got[1] == (1, ["b"], [], ["c"]) and got[2] == (2, [], [], [])


def test_two_taggers_keep_documents_of_either(frame):
    a = frame([(1, ["x"])], "doc_id int, tags array<string>")
    b = frame([(1, ["y"]), (2, ["z"])], "doc_id int, tags array<string>")
    assert rows(agreement.join_two_taggers(a, b)) == [(1, ["x"], ["y"]), (2, [], ["z"])]


@pytest.mark.parametrize("make, kept", [(metrics.class_report, "true"), (metrics.class_report_pruned, "label > 'l004'")])
def test_tasks_of_a_report_hold_a_bounded_number_of_documents(case, monkeypatch, make, kept):
    _, _, truth, scored, vocabulary = case

    def report():
        out = make(truth, scored, 100, vocabulary.filter(kept), [0.3, 0.7]).collect()
        return sorted((r.threshold, r.name, r.support, *(round(r[c], 9) for c in ("precision", "recall", "f1"))) for r in out)

    want, seen, real = report(), [], metrics.judged
    monkeypatch.setattr(metrics, "DOCS_IN_ONE_TASK", 10)
    monkeypatch.setattr(metrics, "judged", lambda *a, **more: seen.append(real(*a, **more)) or seen[-1])
    assert report() == want
    assert seen[0].rdd.getNumPartitions() >= 10
