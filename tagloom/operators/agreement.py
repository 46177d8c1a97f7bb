"""Comparison of two taggers.

Taggings are tables (doc_id, tags); documents a tagger said nothing about carry
an empty list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.columns import ratio
from tagloom.session import small_side


def join_two_taggers(a: DataFrame, b: DataFrame) -> DataFrame:
    """(doc_id, a_terms, b_terms) for every document of either tagger."""
    none = F.array().cast("array<string>")
    left = a.select("doc_id", F.col("tags").alias("a_terms"))
    right = b.select("doc_id", F.col("tags").alias("b_terms"))
    return left.join(right, "doc_id", "full").select(
        "doc_id",
        F.coalesce("a_terms", none).alias("a_terms"),
        F.coalesce("b_terms", none).alias("b_terms"),
    )


def common_terms(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("common_terms", F.array_sort(F.array_intersect("a_terms", "b_terms")))


def only_terms(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn(
        "a_only", F.array_sort(F.array_except("a_terms", "b_terms"))
    ).withColumn("b_only", F.array_sort(F.array_except("b_terms", "a_terms")))


def known_terms(pairs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``pairs`` in long form (doc_id, label, a, b): one row per known label used, 0/1 flags."""
    used = pairs.select(
        "doc_id", "a_terms", "b_terms", F.explode(F.array_union("a_terms", "b_terms")).alias("label")
    ).select(
        "doc_id",
        "label",
        F.array_contains("a_terms", F.col("label")).cast("int").alias("a"),
        F.array_contains("b_terms", F.col("label")).cast("int").alias("b"),
    )
    return used.join(small_side(vocabulary.select("label")), "label", "left_semi")


def label_kappa(pairs: DataFrame, vocabulary: DataFrame, n_docs: int) -> DataFrame:
    """(label, kappa) of the labels either tagger used; NaN where chance agreement is total."""
    n = F.lit(float(n_docs))
    counts = known_terms(pairs, vocabulary).groupBy("label").agg(
        F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum(F.col("a") * F.col("b")).alias("ab")
    )
    a, b, ab = (F.col(c).cast("double") for c in ("a", "b", "ab"))
    agree = (ab + (n - a - b + ab)) / n
    chance = (a / n) * (b / n) + ((n - a) / n) * ((n - b) / n)
    kappa = F.when(chance == 1.0, F.lit(float("nan"))).otherwise(
        F.try_divide(agree - chance, 1 - chance)
    )
    return counts.select("label", kappa.alias("kappa"))


def average_kappa(pairs: DataFrame, vocabulary: DataFrame, n_docs: int) -> DataFrame:
    return label_kappa(pairs, vocabulary, n_docs).agg(F.avg("kappa").alias("avg_cohen_kappa"))


def average_tags(pairs: DataFrame, vocabulary: DataFrame, n_docs: int) -> DataFrame:
    """(a_avg_num_tags, b_avg_num_tags) over all documents, known labels counted once."""
    return known_terms(pairs, vocabulary).agg(
        (F.coalesce(F.sum("a"), F.lit(0)) / F.lit(n_docs)).alias("a_avg_num_tags"),
        (F.coalesce(F.sum("b"), F.lit(0)) / F.lit(n_docs)).alias("b_avg_num_tags"),
    )


def jaccard_samples(pairs: DataFrame, vocabulary: DataFrame | None = None) -> DataFrame:
    """(jaccard_score): mean over documents of shared over used labels, 0 for none used."""
    if vocabulary is None:
        both = F.size(F.array_intersect("a_terms", "b_terms"))
        either = F.size(F.array_union("a_terms", "b_terms"))
        return pairs.agg(F.avg(ratio(both, either)).alias("jaccard_score"))
    n_docs = pairs.count()
    per_doc = known_terms(pairs, vocabulary).groupBy("doc_id").agg(
        ratio(F.sum(F.col("a") * F.col("b")), F.count("*")).alias("share")
    )
    return per_doc.agg(
        (F.coalesce(F.sum("share"), F.lit(0.0)) / F.lit(float(max(n_docs, 1)))).alias("jaccard_score")
    )


def comparison_metrics(pairs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(metric, value): average kappa, average tag numbers and Jaccard score."""
    n_docs = pairs.count()
    kappa = average_kappa(pairs, vocabulary, n_docs).selectExpr(
        "stack(1, 'avg_cohen_kappa', avg_cohen_kappa) AS (metric, value)"
    )
    tags = average_tags(pairs, vocabulary, n_docs).selectExpr(
        "stack(2, 'a_avg_num_tags', a_avg_num_tags, 'b_avg_num_tags', b_avg_num_tags)"
        " AS (metric, value)"
    )
    jaccard = jaccard_samples(pairs, vocabulary).selectExpr(
        "stack(1, 'jaccard_score', jaccard_score) AS (metric, value)"
    )
    return kappa.unionByName(tags).unionByName(jaccard)
