"""One threshold per label, tuned for the best micro F1 over all labels."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.columns import ratio
from tagloom.operators.metrics import micro_prf
from tagloom.operators.ordering import running_totals
from tagloom.operators.sampling import SEED, split_val_test
from tagloom.session import cut_lineage, fits, materialise, small_side


@dataclass
class Tuning:
    """``thresholds`` is (label, threshold); ``f1`` the micro F1 at the start and
    after every round on the data the thresholds were tuned on."""

    thresholds: DataFrame
    f1: list[float]

    @property
    def rounds(self) -> int:
        return len(self.f1) - 1


def threshold_points(
    truth: DataFrame,
    scores: DataFrame,
    n_docs: int,
    vocabulary: DataFrame,
    grid: int | None = None,
) -> DataFrame:
    """(label, score, cand, tp, fp, fn): counts when only scores above ``score`` are kept.

    Rows exist for every distinct score of a label, for the score 0 of documents
    it has no row for, and for the grid points ``i / grid``. ``cand`` marks the
    scores the search may choose.
    """
    exact = F.lit(grid is None)
    # Truth and scores are stacked and grouped, so one shuffle of the pairs gives all
    # counts; from here on the tables hold a row per label and distinct score.
    # A positive without a score is counted under the score NULL.
    counts = materialise(
        truth.select(
            "doc_id", "label", F.lit(1).alias("y"), F.lit(None).cast("double").alias("score")
        )
        .unionByName(
            scores.select(
                "doc_id", "label", F.lit(0).alias("y"), F.col("score").cast("double").alias("score")
            )
        )
        .groupBy("doc_id", "label")
        .agg(F.max("y").alias("y"), F.max("score").alias("score"))
        .groupBy("label", "score")
        .agg(F.count("*").alias("n"), F.sum("y").alias("pos")),
        "counts",
    )
    labels = vocabulary.select("label").distinct()
    stored = F.col("score").isNotNull()
    totals = labels.join(
        counts.groupBy("label").agg(
            F.sum("pos").alias("positives"),
            F.sum(F.when(stored, F.col("n"))).alias("stored"),
            F.sum(F.when(stored, F.col("pos"))).alias("found"),
        ),
        "label",
        "left",
    ).na.fill(0, ["positives", "stored", "found"])
    totals = small_side(cut_lineage(totals))
    rows = (
        counts.filter(stored)
        .join(totals.select("label"), "label", "left_semi")
        .select("label", "score", "n", "pos", exact.alias("cand"), F.lit(True).alias("own"))
        .unionByName(
            totals.filter(F.col("stored") < n_docs).select(
                "label",
                F.lit(0.0).alias("score"),
                (F.lit(n_docs) - F.col("stored")).alias("n"),
                (F.col("positives") - F.col("found")).alias("pos"),
                exact.alias("cand"),
                F.lit(True).alias("own"),
            )
        )
    )
    if grid is not None:
        steps = F.explode(F.array(*[F.lit(i / grid) for i in range(1, grid)]))
        none = F.lit(0).cast("long")
        rows = rows.unionByName(
            totals.select(
                "label",
                steps.alias("score"),
                none.alias("n"),
                none.alias("pos"),
                F.lit(True).alias("cand"),
                F.lit(False).alias("own"),
            )
        )
    merged = rows.groupBy("label", "score").agg(
        F.sum("n").alias("n"),
        F.sum("pos").alias("pos"),
        F.max("cand").alias("cand"),
        F.max("own").alias("own"),
    )
    running = running_totals(merged, "label", [F.desc("score")], ["n", "pos"])
    above, tp = F.col("run_n") - F.col("n"), F.col("run_pos") - F.col("pos")
    return running.join(totals.select("label", "positives"), "label").select(
        "label",
        "score",
        "cand",
        "own",
        tp.alias("tp"),
        (above - tp).alias("fp"),
        (F.col("positives") - tp).alias("fn"),
    )


def f1_of(tp, fp, fn) -> float:
    whole = tp + (fp + fn) / 2
    return tp / whole if whole else 0.0


def upper_hull(points: list[tuple[int, int]]) -> list[int]:
    """Places of the points on the upper convex hull of ``points`` (predicted, hit), which are in rising order; those
    in line with their neighbours stay. Exact, as all are whole numbers."""
    kept: list[int] = []
    for i, (x, y) in enumerate(points):
        while len(kept) > 1:
            (ax, ay), (bx, by) = points[kept[-2]], points[kept[-1]]
            if (bx - ax) * (y - ay) <= (by - ay) * (x - ax):
                break
            kept.pop()
        kept.append(i)
    return kept


# Candidates of a label that a task holds before it reduces them to their hull.
HELD = 50_000


def hull_candidates(candidates: DataFrame, starts: DataFrame) -> DataFrame:
    """The rows of ``candidates`` (label, score, tp, fp, fn) that can be chosen in any round.

    Whatever the other labels add, micro F1 is a ratio of what a label predicts and hits, both without squares, so it
    is largest on the upper hull of its (predicted, hit) points; of equal points the lowest score is
    taken. A threshold that has moved is on the hull, and what lies above it is the rest of the hull; for a label still at
    its start the hull of the scores from there on counts, so both hulls are kept. Each task reduces what it has of
    a label, and the parts are merged by label, so a label with many scores is never in one task whole.
    """
    joined = candidates.join(small_side(starts.select("label", F.col("threshold").alias("start"))), "label")
    columns = ["label", "score", "tp", "fp", "fn", "start"]
    joined = joined.select(*columns)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in joined.schema)

    def reduced(rows: list[tuple]) -> list[tuple]:
        # By predicted documents; of as many the lowest score first, which alone stays.
        rows = sorted(rows, key=lambda r: (r[2] + r[3], r[1]))
        rows = [r for i, r in enumerate(rows) if not i or r[2] + r[3] != rows[i - 1][2] + rows[i - 1][3]]
        kept = set()
        for late in (False, True):
            own = [i for i, r in enumerate(rows) if not late or r[1] >= r[5]]
            kept.update(own[i] for i in upper_hull([(rows[j][2] + rows[j][3], rows[j][2]) for j in own]))
        return [rows[i] for i in sorted(kept)]

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        kinds = None
        for batch in batches:
            kinds = batch.schema
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                own = held.setdefault(row[0], [])
                own.append(row)
                if len(own) >= HELD and len(own) & (len(own) - 1) == 0:
                    held[row[0]] = reduced(own)
        if kinds is not None:
            for own in held.values():
                rows = reduced(own)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kinds)], schema=kinds)

    def whole(label: pa.Table) -> pa.Table:
        rows = reduced(list(zip(*(c.to_pylist() for c in label.columns))))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), label.schema)], schema=label.schema)

    parts = joined.mapInArrow(part, schema)
    return parts.groupBy("label").applyInArrow(whole, schema).drop("start")


def tune_thresholds(
    truth: DataFrame,
    scores: DataFrame,
    n_docs: int,
    vocabulary: DataFrame | None = None,
    grid: int | None = None,
    max_rounds: int | None = None,
) -> Tuning:
    """Thresholds (``score > threshold``) that maximise micro F1.

    Every round lets each label choose, against the same global counts, the
    candidate that raises F1 most (the lowest of equals); from the second round
    on a threshold cannot fall, so a label moves at most once per candidate. Only candidates of
    :func:`hull_candidates` are tried, which choose the same. It ends when no label moves; with ``max_rounds`` it raises if that takes more rounds. Three totals
    per round reach the driver.
    """
    if vocabulary is None:
        vocabulary = truth.select("label").union(scores.select("label")).distinct()
    points = materialise(threshold_points(truth, scores, n_docs, vocabulary, grid))
    start = F.min_by(F.struct("score", "tp", "fp", "fn"), "score")
    state = cut_lineage(
        points.filter("own").groupBy("label").agg(start.alias("s")).select(
            "label", F.col("s.score").alias("threshold"), "s.tp", "s.fp", "s.fn"
        )
    )
    candidates = points.filter("cand").select("label", "score", "tp", "fp", "fn")
    candidates = materialise(hull_candidates(candidates, state), "candidates")
    one_table = fits(state)  # one row per label, in every round
    totals = _totals(state)
    history = [f1_of(*totals)]
    for step in count():
        if step == max_rounds:
            raise RuntimeError(f"thresholds still move after {max_rounds} rounds")
        tp, fp, fn = totals
        current = state.select(
            "label", "threshold", *[F.col(c).alias(f"own_{c}") for c in ("tp", "fp", "fn")]
        )
        moves = candidates.join(F.broadcast(current) if one_table else current, "label")
        if step:
            moves = moves.filter(F.col("score") >= F.col("threshold"))
        new_tp = F.lit(tp) + F.col("tp") - F.col("own_tp")
        new_fp = F.lit(fp) + F.col("fp") - F.col("own_fp")
        new_fn = F.lit(fn) + F.col("fn") - F.col("own_fn")
        gain = ratio(new_tp, new_tp + (new_fp + new_fn) / 2)
        best = (
            moves.withColumn("f1", gain)
            .filter(F.col("f1") > F.lit(history[-1]))
            .groupBy("label")
            .agg(
                F.max_by(
                    F.struct("score", "tp", "fp", "fn"),
                    F.struct(F.col("f1"), (-F.col("score")).alias("low")),
                ).alias("b")
            )
        )
        moved = F.col("b").isNotNull()
        state = cut_lineage(
            state.join(best, "label", "left").select(
                "label",
                F.when(moved, F.col("b.score")).otherwise(F.col("threshold")).alias("threshold"),
                *[F.when(moved, F.col(f"b.{c}")).otherwise(F.col(c)).alias(c) for c in ("tp", "fp", "fn")],
                moved.alias("moved"),
            )
        )
        *totals, moves_made = _totals(state, F.count_if("moved"))
        history.append(f1_of(*totals))
        if not moves_made:
            break
    return Tuning(state.select("label", "threshold"), history)


def _totals(state: DataFrame, *more: Column) -> tuple[int, ...]:
    row = state.agg(F.sum("tp"), F.sum("fp"), F.sum("fn"), *more).first()
    return tuple(int(v or 0) for v in row)


def apply_label_thresholds(
    scores: DataFrame, thresholds: DataFrame, default: float | None = None
) -> DataFrame:
    """Scores above their label's threshold. A label without one takes ``default``; without a
    default it is an error."""
    limits = small_side(thresholds.select("label", "threshold"))
    if default is None:
        problem = F.concat(F.lit("no threshold for label: "), F.coalesce(F.col("label").cast("string"), F.lit("NULL")))
        missing = F.raise_error(problem).cast("double")
    else:
        missing = F.lit(float(default))
    limit = F.when(F.col("threshold").isNull(), missing).otherwise(F.col("threshold"))
    return scores.join(limits, "label", "left").filter(F.col("score") > limit).drop("threshold")


def eval_after_tuning(
    truth: DataFrame,
    scores: DataFrame,
    docs: DataFrame,
    vocabulary: DataFrame,
    val_size: float = 0.8,
    start_threshold: float = 0.2,
    grid: int | None = None,
    seed: int = SEED,
) -> tuple[Tuning, DataFrame]:
    """Tunes on the validation part of ``docs`` (doc_id) and scores the rest.

    Returns the tuning and one row (start_f1, tuned_f1): F1 of the validation part
    at ``start_threshold``, and of the test part with the tuned thresholds.
    """
    parts = materialise(split_val_test(docs.select("doc_id").distinct(), "doc_id", val_size, seed))

    def part(df: DataFrame, name: str) -> DataFrame:
        return df.join(parts.filter(F.col("split") == name).select("doc_id"), "doc_id", "left_semi")

    val_truth, val_scores = materialise(part(truth, "val")), materialise(part(scores, "val"))
    n_val = parts.filter("split = 'val'").count()
    tuning = tune_thresholds(val_truth, val_scores, n_val, vocabulary, grid)
    start = micro_prf(val_truth, val_scores, [start_threshold]).select(F.col("f1").alias("start_f1"))
    known = part(scores, "test").join(
        small_side(tuning.thresholds.select("label")), "label", "left_semi"
    )
    kept = apply_label_thresholds(known, tuning.thresholds).withColumn("score", F.lit(1.0))
    final = micro_prf(part(truth, "test"), kept, [0.5]).select(F.col("f1").alias("tuned_f1"))
    rows = start.select("*", F.lit(1).alias("_one")).join(
        final.select("*", F.lit(1).alias("_one")), "_one"
    )
    return tuning, rows.select("start_f1", "tuned_f1")
