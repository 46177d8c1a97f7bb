"""Confusion counts and precision, recall, F1 over long tables.

Truth is (doc_id, label); scores are (doc_id, label, score) with missing pairs
meaning 0. Both are expected without repeated (doc_id, label) pairs, except that
repeats in truth are harmless.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.columns import ratio
from tagloom.operators.joins import bucket_count
from tagloom.session import cut_lineage, small_side

AVERAGES = ("micro avg", "macro avg", "weighted avg", "samples avg")

# Documents one task of a report groups: tables up to this size are left to AQE.
DOCS_IN_ONE_TASK = 100_000


def as_scores(predictions: DataFrame) -> DataFrame:
    """Predicted (doc_id, label) pairs as scores that pass the threshold 0.5."""
    return predictions.select("doc_id", "label").distinct().withColumn("score", F.lit(1.0))


def level(score: Column, thresholds: Sequence[float]) -> Column:
    """How many of the thresholds lie strictly below ``score``."""
    steps = [(score > F.lit(float(t))).cast("int") for t in thresholds]
    total = steps[0]
    for step in steps[1:]:
        total = total + step
    return total


def check_thresholds(thresholds: Sequence[float]) -> list[float]:
    ordered = sorted({float(t) for t in thresholds})
    if not ordered or ordered[0] < 0:
        raise ValueError("thresholds must be given and must not be negative")
    return ordered


def judged(
    truth: DataFrame,
    scores: DataFrame,
    thresholds: Sequence[float],
    by: str | None = None,
    parts: int | None = None,
) -> DataFrame:
    """One row per (doc_id, label) in either table: ``y`` 0/1 and the score's ``level``.

    The two tables are stacked and grouped instead of joined, which needs no sort
    and no equal partitioning. ``by`` spreads the rows on one of the two keys, so
    that a later grouping on that key needs no further shuffle; ``parts`` is the number of partitions, which AQE
    then leaves as it is.
    """
    stacked = truth.select(
        "doc_id", "label", F.lit(1).alias("y"), F.lit(None).cast("double").alias("score")
    ).unionByName(
        scores.select(
            "doc_id", "label", F.lit(0).alias("y"), F.col("score").cast("double").alias("score")
        )
    )
    if by:
        stacked = stacked.repartition(by) if parts is None else stacked.repartition(parts, by)
    pairs = stacked.groupBy("doc_id", "label").agg(
        F.max("y").alias("y"), F.max("score").alias("score")
    )
    score = F.coalesce("score", F.lit(0.0))
    return pairs.select("doc_id", "label", "y", level(score, thresholds).alias("level"))


def counts_per(rows: DataFrame, keys: Sequence[str], thresholds: Sequence[float]) -> DataFrame:
    """(keys, threshold, tp, pp, positives) from judged rows.

    Rows are first counted per key and level, then unfolded to the thresholds.
    """
    by_level = rows.groupBy(*keys, "level").agg(
        F.count("*").alias("n"), F.sum("y").alias("pos")
    )
    table = F.array(
        *[F.struct(F.lit(i).alias("i"), F.lit(t).alias("threshold")) for i, t in enumerate(thresholds)]
    )
    unfolded = by_level.select(*keys, "level", "n", "pos", F.explode(table).alias("t"))
    above = F.col("level") > F.col("t.i")
    return unfolded.groupBy(*keys, F.col("t.threshold").alias("threshold")).agg(
        F.sum(F.when(above, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(above, F.col("n")).otherwise(0)).alias("pp"),
        F.sum("pos").alias("positives"),
    )


def prf(tp: Column, predicted: Column, positives: Column) -> list[Column]:
    """Precision, recall and F1; 0 where the denominator is 0."""
    return [
        ratio(tp, predicted).alias("precision"),
        ratio(tp, positives).alias("recall"),
        ratio(2 * tp, predicted + positives).alias("f1"),
    ]


def confusion_counts(
    truth: DataFrame,
    scores: DataFrame,
    n_docs: int,
    vocabulary: DataFrame,
    thresholds: Sequence[float] = (0.5,),
) -> DataFrame:
    """(label, threshold, tn, fp, fn, tp) for every label of the vocabulary."""
    thresholds = check_thresholds(thresholds)
    seen = counts_per(judged(truth, scores, thresholds), ["label"], thresholds)
    every = vocabulary.select("label").withColumn(
        "threshold", F.explode(F.array(*[F.lit(t) for t in thresholds]))
    )
    tp, pp, positives = (F.coalesce(F.col(c), F.lit(0)) for c in ("tp", "pp", "positives"))
    return every.join(seen, ["label", "threshold"], "left").select(
        "label",
        "threshold",
        (F.lit(n_docs) - pp - positives + tp).alias("tn"),
        (pp - tp).alias("fp"),
        (positives - tp).alias("fn"),
        tp.alias("tp"),
    )


def confusion(truth: DataFrame, predictions: DataFrame, n_docs: int) -> DataFrame:
    """One row (tn, fp, fn, tp) for a single label's (doc_id) tables."""
    stacked = truth.select("doc_id", F.lit(1).alias("y"), F.lit(0).alias("p")).unionByName(
        predictions.select("doc_id", F.lit(0).alias("y"), F.lit(1).alias("p"))
    )
    flags = stacked.groupBy("doc_id").agg(F.max("y").alias("y"), F.max("p").alias("p"))
    tp, pp, positives = (
        F.coalesce(F.sum(c), F.lit(0)) for c in (F.col("y") * F.col("p"), F.col("p"), F.col("y"))
    )
    return flags.agg(tp.alias("tp"), pp.alias("pp"), positives.alias("positives")).select(
        (F.lit(n_docs) - F.col("pp") - F.col("positives") + F.col("tp")).alias("tn"),
        (F.col("pp") - F.col("tp")).alias("fp"),
        (F.col("positives") - F.col("tp")).alias("fn"),
        "tp",
    )


def micro_prf(truth: DataFrame, scores: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """(threshold, precision, recall, f1) over all labels, all thresholds in one pass."""
    thresholds = check_thresholds(thresholds)
    rows = counts_per(judged(truth, scores, thresholds), [], thresholds)
    return rows.select("threshold", *prf(F.col("tp"), F.col("pp"), F.col("positives")))


def pr_curve(
    truth: DataFrame, scores: DataFrame, thresholds: Sequence[float] = (0.1, 0.2, 0.3, 0.4, 0.5)
) -> DataFrame:
    """:func:`micro_prf` in threshold order."""
    return micro_prf(truth, scores, thresholds).orderBy("threshold")


def class_report(
    truth: DataFrame,
    scores: DataFrame,
    n_docs: int,
    vocabulary: DataFrame,
    thresholds: Sequence[float] = (0.5,),
    swap: bool = False,
) -> DataFrame:
    """(threshold, name, precision, recall, f1, support): a row per label and per average.

    Macro and weighted averages run over the whole vocabulary, the samples average
    over all ``n_docs`` documents. ``swap`` exchanges the roles of truth and
    prediction.
    """
    thresholds = check_thresholds(thresholds)
    names = vocabulary.select("label").distinct()
    # What a task keeps of its documents depends on their number, not on how small they were shuffled.
    tasks = None
    if n_docs > DOCS_IN_ONE_TASK:
        tasks = max(-(-n_docs // DOCS_IN_ONE_TASK), bucket_count(truth.sparkSession))
    rows = judged(truth, scores, thresholds, by="doc_id", parts=tasks).join(
        small_side(names), "label", "left_semi"
    )
    predicted, positives = ("positives", "pp") if swap else ("pp", "positives")
    measures = prf(F.col("tp"), F.col(predicted), F.col(positives))
    parts = ("precision", "recall", "f1")

    # One job counts per label and averages per document; both groupings read the
    # same shuffled pairs. What is left is a row per label and threshold.
    per_label = counts_per(rows, ["label"], thresholds).select(
        "label", "threshold", "tp", "pp", "positives", *[F.lit(None).cast("double").alias(c) for c in parts]
    )
    per_doc = counts_per(rows, ["doc_id"], thresholds).select("threshold", *measures)
    samples = per_doc.groupBy("threshold").agg(
        *[(F.sum(c) / F.lit(float(max(n_docs, 1)))).alias(c) for c in parts]
    )
    counted = cut_lineage(per_label.unionByName(samples, allowMissingColumns=True))
    every = names.withColumn("threshold", F.explode(F.array(*[F.lit(t) for t in thresholds])))
    labels = every.join(
        counted.filter("label IS NOT NULL").drop(*parts), ["label", "threshold"], "left"
    ).na.fill(0, ["tp", "pp", "positives"])
    support = F.col(positives).alias("support")
    scored = cut_lineage(labels.select("threshold", "label", "tp", "pp", "positives", *measures, support))

    def named(df: DataFrame, average: str, prefix: str = "") -> DataFrame:
        return df.select(
            "threshold", F.lit(average).alias("name"), *[F.col(prefix + c).alias(c) for c in parts], "support"
        )

    totals = scored.groupBy("threshold").agg(
        *[F.sum(c).alias(c) for c in ("tp", "pp", "positives", "support")],
        *[F.avg(c).alias(f"macro_{c}") for c in parts],
        *[ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(f"weighted_{c}") for c in parts],
    )
    totals = totals.select("*", *measures)
    averages = counted.filter("label IS NULL").select("threshold", *parts)
    own = scored.select("threshold", F.col("label").alias("name"), *parts, "support")
    return (
        own.unionByName(named(totals, AVERAGES[0]))
        .unionByName(named(totals, AVERAGES[1], "macro_"))
        .unionByName(named(totals, AVERAGES[2], "weighted_"))
        .unionByName(named(averages.join(totals.select("threshold", "support"), "threshold"), AVERAGES[3]))
    )


def class_report_pruned(
    truth: DataFrame,
    scores: DataFrame,
    n_docs: int,
    train_labels: DataFrame,
    thresholds: Sequence[float] = (0.5,),
    swap: bool = False,
) -> DataFrame:
    """:func:`class_report` over the labels seen in training only."""
    seen = train_labels.select("label").distinct()
    return class_report(truth, scores, n_docs, seen, thresholds, swap)


def f1_per_tag(
    truth: DataFrame, scores: DataFrame, vocabulary: DataFrame, threshold: float = 0.5
) -> DataFrame:
    """(Tag, f1) for every label of the vocabulary."""
    seen = counts_per(judged(truth, scores, [threshold]), ["label"], [threshold])
    joined = vocabulary.select("label").join(seen, "label", "left")
    return joined.na.fill(0, ["tp", "pp", "positives"]).select(
        F.col("label").alias("Tag"),
        ratio(2 * F.col("tp"), F.col("pp") + F.col("positives")).alias("f1"),
    )


def label_min_score(scores: DataFrame, n_docs: int, vocabulary: DataFrame | None = None) -> DataFrame:
    """(label, min_score): lowest score, counting 0 for documents without one."""
    stored = scores.groupBy("label").agg(F.min("score").alias("low"), F.count("*").alias("n"))
    if vocabulary is not None:
        stored = vocabulary.select("label").join(stored, "label", "left")
    absent = F.coalesce("n", F.lit(0)) < n_docs
    low = F.coalesce("low", F.lit(0.0))
    return stored.select(
        "label", F.when(absent, F.least(low, F.lit(0.0))).otherwise(low).alias("min_score")
    )


def formatted_results(results: DataFrame) -> DataFrame:
    """Evaluation results as the two-decimal strings that reports show."""
    columns = ("threshold", "precision", "recall", "f1")
    return results.select(*[F.format_string("%.2f", c).alias(c) for c in columns])
