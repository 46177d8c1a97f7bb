"""Row filters and projections. All of them are narrow unless a term list is
too long to inline; which rows they keep does not depend on that."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions import text as fn
from tagloom.functions.columns import as_column
from tagloom.operators.ordering import with_row_ids
from tagloom.session import small_side

# Longest list that is looked up as a set of literals; longer ones become a join.
INLINE_ITEMS = 10_000


def year_in(years: Sequence, year: Column | str = "year") -> Column:
    return as_column(year).cast("string").isin([str(y) for y in years])


def any_tag_in(tags: Sequence[str], field: Column | str = "meshMajor") -> Column:
    return F.exists(as_column(field), lambda t: t.isin(list(tags)))


def filter_years(df: DataFrame, years: Sequence | None, year: str = "year") -> DataFrame:
    """Rows of the wanted years; no years means no filter."""
    return df.filter(year_in(years, year)) if years else df


def filter_tags_any(
    df: DataFrame, tags: Sequence[str] | None, field: str = "meshMajor"
) -> DataFrame:
    """Rows with any wanted tag; they keep all their tags. No tags means no filter."""
    if not tags:
        return df
    if len(tags) <= INLINE_ITEMS:
        return df.filter(any_tag_in(tags, field))
    wanted = df.sparkSession.createDataFrame([(t,) for t in set(tags)], "_tag STRING")
    return filter_any_tag_of(df, wanted, "_tag", field)


def filter_any_tag_of(df: DataFrame, terms: DataFrame, term: str, field: str) -> DataFrame:
    """Rows with at least one element of ``field`` in the ``terms`` table.

    Up to ``INLINE_ITEMS`` terms are looked up row by row, without any shuffle; with
    more, every row gets a number and those of the matching rows are found by a join.
    """
    wanted = terms.select(F.col(term).alias("_tag")).filter("_tag IS NOT NULL").distinct()
    inline = [r[0] for r in wanted.limit(INLINE_ITEMS + 1).collect()]
    if len(inline) <= INLINE_ITEMS:
        return df.filter(any_tag_in(inline, field)) if inline else df.filter(F.lit(False))
    numbered = with_row_ids(df)
    hits = (
        numbered.select("_row_id", F.explode(F.array_distinct(field)).alias("_tag"))
        .join(small_side(wanted), "_tag", "left_semi")
        .select("_row_id")
        .distinct()
    )
    return numbered.join(hits, "_row_id", "left_semi").drop("_row_id")


def article_matches(
    columns: Sequence[str], tags: Sequence[str] | None, years: Sequence | None
) -> Column:
    """Wanted tags and wanted years, each skipped when its list or its field is missing."""
    keep = F.lit(True)
    if tags and "meshMajor" in columns:
        keep = keep & (F.col("meshMajor").isNull() | any_tag_in(tags))
    if years and "year" in columns:
        keep = keep & (F.col("year").isNull() | year_in(years))
    return keep


def filter_article(
    df: DataFrame, tags: Sequence[str] | None = None, years: Sequence | None = None
) -> DataFrame:
    """Rows for which :func:`article_matches` holds."""
    return df.filter(F.coalesce(article_matches(df.columns, tags, years), F.lit(False)))


def filter_has_text(df: DataFrame, field: str = "abstract") -> DataFrame:
    return df.filter(F.col(field).isNotNull())


def filter_has_tags(df: DataFrame, field: str = "mesh_terms") -> DataFrame:
    return df.filter(F.size(field) > 0)


def filter_category_type(
    df: DataFrame, kinds: Sequence[str], field: str = "categories"
) -> DataFrame:
    """One row per category of a wanted type, as struct column ``category``."""
    return df.select("*", F.explode_outer(field).alias("category")).filter(
        F.coalesce(F.col("category.category_type").isin(list(kinds)), F.lit(False))
    )


def filter_tree_branch(df: DataFrame, tree: str = "tree_number") -> DataFrame:
    """Diseases without the animal ones, and mental disorders."""
    t = F.col(tree)
    return df.filter((t.startswith("C") & ~t.startswith("C22")) | t.startswith("F03"))


def filter_annotation(df: DataFrame, annotation: str = "annotation") -> DataFrame:
    """Descriptors whose note does not forbid their use; no note allows it."""
    return df.filter(~F.coalesce(F.col(annotation), F.lit("")).contains(": Do not use"))


def filter_pred_in_terms(
    df: DataFrame, terms: DataFrame, term: str = "name", field: str = "tags"
) -> DataFrame:
    """Documents with at least one predicted tag among ``terms``."""
    return filter_any_tag_of(df, terms, term, field)


def project_drop(df: DataFrame) -> DataFrame:
    return df.drop("journal", "pmid", "title")


def project_tagged_text(publications: DataFrame) -> DataFrame:
    """Publications with tags, as tagged text; columns beyond the three used stay."""
    rest = [c for c in publications.columns if c not in ("abstract", "mesh_terms", "title")]
    return filter_has_tags(publications).select(
        *rest,
        F.col("abstract").alias("text"),
        fn.normalise_headings("mesh_terms").alias("tags"),
        F.create_map(F.lit("title"), F.col("title")).alias("meta"),
    )


def project_annotation_record(
    grants: DataFrame, agent: str, tags: str = "mesh_terms", stratum: str = "for_first_level_name"
) -> DataFrame:
    """Annotation records: every tag is a prediction with score 1."""
    return grants.select(
        F.col("abstract").alias("text"),
        F.transform(
            tags, lambda t: F.struct(t.alias("label"), F.lit(1.0).alias("score"))
        ).alias("prediction"),
        F.lit(agent).alias("prediction_agent"),
        F.struct(F.col(stratum)).alias("metadata"),
        F.lit(True).alias("multi_label"),
    )
