from __future__ import annotations

import numpy as np
import pytest
from compare import rows

from tagloom.operators import thresholds as th


def tables(spark, y, scores, sparse=False):
    truth = [(i, j) for i, j in zip(*np.nonzero(y))]
    scored = [
        (i, j, float(scores[i, j]))
        for i in range(scores.shape[0])
        for j in range(scores.shape[1])
        if scores[i, j] or not sparse
    ]
    names = spark.createDataFrame([(j,) for j in range(scores.shape[1])], "label int")
    return (
        spark.createDataFrame([(int(i), int(j)) for i, j in truth], "doc_id int, label int"),
        spark.createDataFrame(scored, "doc_id int, label int, score double").repartition(3),
        names,
    )


def f1(tp, fp, fn):
    return tp / (tp + (fp + fn) / 2) if tp + fp + fn else 0.0


def counts(y, scores, limits):
    p = scores > limits
    return np.array([(y * p).sum(0), ((1 - y) * p).sum(0), (y * ~p).sum(0)])


def tuned(spark, y, scores, sparse=False, grid=None):
    truth, scored, names = tables(spark, y, scores, sparse)
    result = th.tune_thresholds(truth, scored, len(y), names, grid)
    return [t for _, t in rows(result.thresholds)], result


# Golden cases, as matrices of truth and scores with the thresholds to be found.
ONES = [[1, 1, 1], [1, 1, 1]], [[0.3, 0.5, 0.7], [0.1, 0.8, 0.2]], [0.1, 0.5, 0.2]
REALISTIC = (
    [[0, 0, 1], [1, 0, 0], [0, 1, 0]],
    [[0.3, 0.5, 0.7], [0.6, 0.7, 0.3], [0.1, 0.8, 0.2]],
    [0.3, 0.7, 0.3],
)


@pytest.mark.parametrize("y,scores,expected", [ONES, REALISTIC])
def test_known_cases(spark, y, scores, expected):
    got, _ = tuned(spark, np.array(y), np.array(scores))
    assert got == expected


@pytest.mark.parametrize("seed,sparse,grid", [(1, False, None), (2, True, None), (3, False, 10), (4, True, 10)])
def test_what_holds_for_any_result(spark, seed, sparse, grid):
    r = np.random.default_rng(seed)
    y = (r.random((40, 5)) < 0.3).astype(int)
    scores = np.round(np.clip(r.random((40, 5)) * 0.6 + y * 0.3, 0, 1), 2)
    if sparse:
        scores = scores * (r.random((40, 5)) < 0.5)
    got, result = tuned(spark, y, scores, sparse, grid)
    start, limits = scores.min(0), np.array(got)
    at = lambda t: f1(*counts(y, scores, t).sum(1))
    # The search starts from the least score of each label, never gets worse, and ends where it says.
    assert result.f1[0] == pytest.approx(at(start)) and result.f1[-1] == pytest.approx(at(limits))
    assert all(b >= a for a, b in zip(result.f1, result.f1[1:]))
    for j in range(y.shape[1]):
        options = [i / grid for i in range(1, grid)] if grid else sorted(set(scores[:, j]))
        moved = lambda c: np.where(np.arange(len(limits)) == j, c, limits)
        # No label alone can be raised to a better result.
        assert all(at(moved(c)) <= at(limits) + 1e-12 for c in options if c >= limits[j])
        if limits[j] != start[j]:
            # A new threshold is a candidate, and the lowest of those that keep the same documents.
            assert any(c == pytest.approx(limits[j]) for c in options)
            lower = [c for c in options if c < limits[j] - 1e-12]
            if lower:
                assert (counts(y, scores, moved(lower[-1]))[:, j] != counts(y, scores, limits)[:, j]).any()


def test_by_hand(spark):
    # Raising label 0 to 0.2 loses its false positive: F1 goes from 6/7 to 1, and label 1 is left alone.
    y = np.array([[1, 1], [0, 0], [0, 1]])
    scores = np.array([[0.9, 0.8], [0.2, 0.1], [0.1, 0.6]])
    got, result = tuned(spark, y, scores)
    assert got == [0.2, 0.1] and result.f1 == pytest.approx([6 / 7, 1.0, 1.0][: len(result.f1)])


def test_hull_of_points():
    r = np.random.default_rng(3)
    for _ in range(200):
        steps = r.integers(0, 4, (12, 2))
        steps[:, 0] += 1
        points = [tuple(map(int, p)) for p in np.cumsum(np.minimum(steps, steps[:, :1]), axis=0)]
        kept = set(th.upper_hull(points))
        for i, (x, y) in enumerate(points):
            above = any(
                (bx - ax) * (y - ay) < (by - ay) * (x - ax)
                for ax, ay in points for bx, by in points if ax < x < bx
            )
            assert (i in kept) == (not above)


@pytest.mark.parametrize("grid", [None, 20])
def test_few_candidates_choose_the_same(spark, monkeypatch, grid):
    r = np.random.default_rng(8)
    y = (r.random((300, 3)) < 0.3).astype(int)
    scores = np.round(np.clip(r.random((300, 3)) * 0.7 + y * 0.2, 0, 1), 3)
    seen = []
    plain = th.hull_candidates

    def counted(candidates, starts):
        found = plain(candidates, starts)
        seen.append((candidates.count(), found.count()))
        return found

    monkeypatch.setattr(th, "HELD", 16)
    monkeypatch.setattr(th, "hull_candidates", counted)
    few = tuned(spark, y, scores, grid=grid)
    monkeypatch.setattr(th, "hull_candidates", lambda candidates, starts: candidates)
    every = tuned(spark, y, scores, grid=grid)
    assert few[0] == every[0] and few[1].f1 == every[1].f1
    (before, after), = seen
    assert after < before * (0.5 if grid is None else 1)


def test_nothing_to_find_gives_zero(spark):
    y, scores = np.zeros((3, 2), int), np.array([[0.1, 0.2]] * 3)
    got, result = tuned(spark, y, scores)
    assert got == [0.1, 0.2] and result.f1[0] == 0.0


def test_positives_without_score_count_as_missed(spark):
    y = np.array([[1], [1], [0]])
    scores = np.array([[0.0], [0.9], [0.0]])
    got, result = tuned(spark, y, scores, sparse=True)
    assert got == [0.0] and result.f1[0] == pytest.approx(2 / 3)


def test_spread_running_totals_give_the_same(spark, monkeypatch):
    y, scores, expected = REALISTIC
    monkeypatch.setattr("tagloom.operators.ordering.ROWS_IN_ONE_TASK", 1)
    got, _ = tuned(spark, np.array(y), np.array(scores))
    assert got == expected


def test_apply_label_thresholds_is_strict(spark):
    scores = spark.createDataFrame([(1, "a", 0.5), (2, "a", 0.6), (1, "b", 0.1)], "doc_id int, label string, score double")
    limits = spark.createDataFrame([("a", 0.5), ("b", 0.0)], "label string, threshold double")
    assert rows(th.apply_label_thresholds(scores, limits), "doc_id", "label") == [(1, "b"), (2, "a")]


def test_labels_without_threshold(spark):
    scores = spark.createDataFrame([(1, "a", 0.5), (1, "b", 0.6), (2, "b", 0.2)], "doc_id int, label string, score double")
    limits = spark.createDataFrame([("a", 0.4)], "label string, threshold double")
    assert rows(th.apply_label_thresholds(scores, limits, 0.3), "doc_id", "label") == [(1, "a"), (1, "b")]
    with pytest.raises(Exception, match="no threshold for label: b"):
        th.apply_label_thresholds(scores, limits).collect()


def test_too_few_rounds_are_an_error(spark):
    y, scores, _ = REALISTIC
    truth, scored, names = tables(spark, np.array(y), np.array(scores))
    with pytest.raises(RuntimeError):
        th.tune_thresholds(truth, scored, 3, names, max_rounds=0)


def test_tuning_pays_off_on_the_held_out_part(spark):
    r = np.random.default_rng(9)
    y = (r.random((200, 4)) < 0.3).astype(int)
    scores = np.round(np.clip(r.random((200, 4)) * 0.6 + y * 0.35, 0, 1), 2)
    truth, scored, names = tables(spark, y, scores)
    docs = spark.range(200).selectExpr("cast(id as int) as doc_id")
    tuning, result = th.eval_after_tuning(truth, scored, docs, names, 0.5)
    row = result.first()
    assert row.tuned_f1 > row.start_f1 and tuning.rounds >= 1
