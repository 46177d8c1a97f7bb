"""Joins against the taxonomy and other dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.columns import seeded_hash
from tagloom.operators.filters import filter_annotation
from tagloom.operators.ordering import head_rows
from tagloom.session import small_side


def subtree(
    taxonomy: DataFrame,
    terms: DataFrame,
    term: str = "name",
    dot_aware: bool = True,
    all_trees: bool = False,
) -> DataFrame:
    """Descriptors at or below any descriptor named in ``terms``, each once.

    Every prefix of a tree number is an equi-join key, so the work grows with the
    taxonomy, not with its square. ``dot_aware=False`` matches raw text prefixes.
    ``all_trees=True`` looks at all tree numbers instead of the first.
    """
    tree = F.explode("tree_numbers") if all_trees else F.col("tree_number")
    nodes = taxonomy.select("ui", "name", tree.alias("tree")).filter("tree IS NOT NULL")
    named = terms.select(F.col(term).alias("name")).distinct()
    roots = nodes.join(small_side(named), "name", "left_semi").select(F.col("tree").alias("prefix"))
    if dot_aware:
        steps = F.split("tree", r"\.")
        prefixes = F.transform(
            F.sequence(F.lit(1), F.size(steps)),
            lambda i: F.array_join(F.slice(steps, F.lit(1), i), "."),
        )
    else:
        prefixes = F.transform(
            F.sequence(F.lit(1), F.length("tree")), lambda i: F.substring("tree", F.lit(1), i)
        )
    hits = (
        nodes.select("ui", F.explode(prefixes).alias("prefix"))
        .join(small_side(roots.distinct()), "prefix", "left_semi")
        .select("ui")
        .distinct()
    )
    return taxonomy.join(hits, "ui", "left_semi")


def inclusion_list(
    taxonomy: DataFrame, exclusions: DataFrame, name: str = "DescriptorName"
) -> DataFrame:
    """Names that may be used: allowed by their note and not excluded by hand."""
    excluded = exclusions.select(F.col(name).alias("name")).distinct()
    return filter_annotation(taxonomy).join(small_side(excluded), "name", "left_anti").select(
        F.col("name").alias(name)
    )


def join_category_name(categorised: DataFrame, categories: DataFrame) -> DataFrame:
    """Adds ``category_name`` and ``category_type``; an unknown id gets a NULL name."""
    named = categories.select("category_id", F.col("name").alias("category_name"))
    return (
        categorised.withColumn("category_id", F.col("category.id"))
        .withColumn("category_type", F.col("category.category_type"))
        .join(small_side(named), "category_id", "left")
        .drop("category")
    )


def union_portfolio(
    sample: DataFrame,
    active: DataFrame,
    n_active: int,
    key: str,
    text: str = "Synopsis",
    seed: int | None = None,
) -> DataFrame:
    """Sampled grants (flag 0) and the first ``n_active`` active ones (flag 1): by
    ``key``, or in seeded hash order when a seed is given."""
    order = [F.col(key)] if seed is None else [seeded_hash(seed, key)]
    chosen = head_rows(active.filter(F.col(text).isNotNull()), order, n_active)
    return sample.withColumn("active_portfolio", F.lit(0)).unionByName(
        chosen.select(key, F.col(text).alias("abstract")).withColumn(
            "active_portfolio", F.lit(1)
        ),
        allowMissingColumns=True,
    )
