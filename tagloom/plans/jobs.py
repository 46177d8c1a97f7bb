"""Whole jobs, one per task a user runs. Each takes tables or paths and composes operators."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.operators import agreement, filters, labels, metrics, sampling, taxonomy, thresholds
from tagloom.operators import augment as aug
from tagloom.operators import textfeatures as tx
from tagloom.operators.ordering import head_rows, number_lines, with_row_ids
from tagloom.operators.predictions import Scorer, score_batch
from tagloom.session import materialise
from tagloom.sources import records, sinks


@dataclass
class Prepared:
    """Encoded rows with a ``split`` column, and the vocabularies they were encoded with."""

    rows: DataFrame
    labels: DataFrame
    tokens: DataFrame


def preprocess(
    articles: DataFrame,
    path: str | None = None,
    test_size: float | None = None,
    tags: Sequence[str] | None = None,
    train_years: Sequence | None = None,
    test_years: Sequence | None = None,
    max_rows: int = -1,
    label_vocabulary: DataFrame | None = None,
    token_vocabulary: DataFrame | None = None,
    length: int = 512,
    seed: int = sampling.SEED,
) -> Prepared:
    """Filters, label and token encoding, split, and, with ``path``, the saved dataset.

    Labels come from the filtered, unsplit rows unless a vocabulary is given. Every row that
    passes the filters is in the result, whatever its ``pmid``. ``max_rows`` takes the first
    rows in the order in which ``articles`` is read; to cut a file after its first lines,
    give ``max_rows`` to :func:`tagloom.sources.records.read_articles`.
    """
    if bool(train_years) != bool(test_years):
        raise ValueError("give both train and test years, or neither")
    if max_rows != -1:
        articles = head_rows(with_row_ids(articles), ["_row_id"], max_rows).drop("_row_id")
    years = [*(train_years or []), *(test_years or [])]
    kept = filters.filter_tags_any(filters.filter_years(articles, years), tags)
    # Read once, narrow: the two vocabularies, the encoding and the split all use it.
    kept = materialise(kept.select("pmid", "year", "meshMajor", "abstractText"), "articles")
    if label_vocabulary is None:
        label_vocabulary = labels.build_vocabulary(kept)
    docs = kept.select(F.col("pmid").alias("doc_id"), F.col("abstractText").alias("text"))
    if token_vocabulary is None:
        token_vocabulary = tx.token_vocabulary(docs)
    if years:
        split = sampling.split_years(kept, train_years, test_years, "pmid", test_size, seed)
    else:
        split = sampling.split_random(kept, "pmid", 0.05 if test_size is None else test_size, seed)
    coded = labels.with_label_ids(split, label_vocabulary)
    rows = tx.with_token_ids(coded, token_vocabulary, length, "abstractText").drop("pmid")
    if path is not None:
        sinks.write_dataset(rows, label_vocabulary, path)
    return Prepared(rows, label_vocabulary, token_vocabulary)


@dataclass
class Evaluation:
    """``results``: P, R, F1 per threshold. ``report``: per label and average, per threshold."""

    results: DataFrame
    report: DataFrame


def evaluate(
    docs: DataFrame,
    truth: DataFrame,
    scorer: Scorer,
    vocabulary: DataFrame,
    cuts: Sequence[float] = (0.5,),
    split_data: bool = True,
    test_size: float | None = None,
) -> Evaluation:
    """Scores (doc_id, text) documents and reports at every threshold; by default only
    the held-out part of :func:`tagloom.operators.sampling.split_train_test`."""
    if split_data:
        docs = sampling.split_train_test(docs, "doc_id", test_size=test_size)
        docs = docs.filter("split = 'test'").drop("split")
        truth = truth.join(docs.select("doc_id"), "doc_id", "left_semi")
    docs = materialise(docs, "docs")
    scores = materialise(scorer(docs), "scores")
    return Evaluation(
        metrics.pr_curve(truth, scores, cuts),
        metrics.class_report(truth, scores, docs.count(), vocabulary, cuts),
    )


def tune(
    docs: DataFrame,
    truth: DataFrame,
    scorer: Scorer,
    vocabulary: DataFrame,
    val_size: float = 0.8,
    grid: int | None = None,
    start_threshold: float = 0.2,
    path: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(thresholds, result): thresholds tuned on the validation part, F1 before and after."""
    scores = materialise(scorer(docs), "scores")
    tuning, result = thresholds.eval_after_tuning(
        truth, scores, docs, vocabulary, val_size, start_threshold, grid
    )
    if path is not None:
        sinks.write_report(tuning.thresholds, path)
    return tuning.thresholds, result


def augment(
    articles: DataFrame,
    path: str | None = None,
    wanted: DataFrame | None = None,
    min_examples: int | None = None,
    examples: int = 25,
    **request,
) -> DataFrame:
    """Generation requests for the rare tags of the training rows; with ``path`` the
    tag counts are written too. Answers go to ``augment.ingest_responses``."""
    rare = materialise(labels.rare_tags(labels.tag_counts(articles), wanted, min_examples), "rare")
    if path is not None:
        sinks.write_report(rare, path, "json")
    return aug.build_requests(articles, rare, examples, **request)


def sample_grants(
    spark: SparkSession,
    path: str,
    n_files: int = 10,
    per_category: int = 10,
    key: str = "grant_id",
    scorer: Scorer | None = None,
    seed: int = sampling.SEED,
) -> DataFrame:
    """A stratified sample of grants from a few parquet files, pre-tagged if there is a scorer."""
    columns = [key, "title", "abstract", "for_first_level_name"]
    grants = records.read_parquet_subset(spark, path, n_files, columns, seed)
    sample = sampling.sample_stratified(grants, "for_first_level_name", key, per_category, seed)
    if scorer is None:
        return sample
    sample = materialise(sample, "sample")
    docs = sample.select(F.col(key).alias("doc_id"), F.col("abstract").alias("text"))
    tags = score_batch(docs, scorer).select(F.col("doc_id").alias(key), F.col("tags").alias("mesh_terms"))
    return sample.join(tags, key, "left")


def sample_publications(
    publications: DataFrame,
    categories: DataFrame,
    kinds: Sequence[str],
    per_category: int,
    key: str,
    seed: int = sampling.SEED,
) -> DataFrame:
    """Exactly ``per_category`` publications for every (category, type) of interest."""
    kept = filters.filter_category_type(publications, kinds)
    named = taxonomy.join_category_name(kept, categories).withColumn(
        "category_name", F.coalesce("category_name", F.concat(F.lit("unknown "), F.col("category_id")))
    )
    return sampling.sample_stratified_fill(named, ["category_name", "category_type"], key, per_category, seed)


def compare_taggers(
    grants: DataFrame,
    active: DataFrame,
    tagger_a: Scorer,
    tagger_b: Scorer,
    descriptors: DataFrame,
    terms: DataFrame,
    per_category: int = 10,
    n_active: int = 200,
    threshold_a: float = 0.5,
    threshold_b: float = 0.5,
    key: str = "doc_id",
    path: str | None = None,
) -> DataFrame:
    """Sampled and active grants with both taggers' terms, common and own.

    Kept are the rows with a term of tagger ``a`` at or below one of ``terms`` in the
    taxonomy.
    """
    known = filters.filter_has_text(grants)
    sample = sampling.sample_stratified(known, "for_first_level_name", key, per_category)
    rows = materialise(taxonomy.union_portfolio(sample, active, n_active, key), "portfolio")
    docs = rows.select(F.col(key).alias("doc_id"), F.col("abstract").alias("text"))
    pairs = agreement.join_two_taggers(
        score_batch(docs, tagger_a, threshold_a), score_batch(docs, tagger_b, threshold_b)
    )
    below = materialise(taxonomy.subtree(descriptors, terms), "subtree")
    kept = filters.filter_pred_in_terms(materialise(pairs, "pairs"), below, field="a_terms")
    compared = agreement.only_terms(agreement.common_terms(kept))
    result = rows.withColumnRenamed(key, "doc_id").join(compared, "doc_id")
    if path is not None:
        sinks.write_report(result, path, "csv")
    return result


def convert_articles(
    spark: SparkSession,
    source: str,
    path: str,
    tags: Sequence[str] | None = None,
    years: Sequence | None = None,
    encoding: str = "ISO-8859-1",
) -> DataFrame:
    """Wrapped articles with a wanted tag and year, as JSON lines; returns the quarantine."""
    articles, bad = records.read_articles_wrapped(spark, source, tags, years, encoding)
    sinks.write_jsonl(articles, path)
    return bad


def convert_publications(spark: SparkSession, source: str, path: str, form: str = "arrays") -> DataFrame:
    """Publications with tags, as JSON lines of tagged text; returns the quarantine."""
    publications, bad = records.read_publications(spark, source, form)
    sinks.write_jsonl(filters.project_tagged_text(publications), path)
    return bad


def list_usable_descriptors(spark: SparkSession, source: str, exclusions: str, path: str) -> None:
    """CSV of the descriptors whose note allows their use and that the CSV ``exclusions`` does
    not name."""
    descriptors = records.read_taxonomy(spark, source)
    excluded = records.read_csv(spark, exclusions, "DescriptorName STRING")[0]
    sinks.write_report(taxonomy.inclusion_list(descriptors, excluded), path, "csv")


def list_disease_descriptors(spark: SparkSession, source: str, path: str) -> None:
    """CSV of the descriptors of diseases, without those of animals, and of mental disorders."""
    kept = filters.filter_tree_branch(records.read_taxonomy(spark, source))
    sinks.write_report(kept.select("ui", "name", "tree_number"), path, "csv")


def split_lines(
    spark: SparkSession,
    source: str,
    path: str,
    test_share: float,
    buffer_rows: int = 10_000,
    seed: int = sampling.SEED,
) -> None:
    """The lines of a file, whatever their encoding, as the text folders ``train`` and ``test``
    below ``path``."""
    lines = number_lines(spark.read.text(source))
    split = sampling.split_buffered(lines, "line_no", test_share, buffer_rows, seed)
    split = materialise(split.select("value", "split"), "split")
    for name in ("train", "test"):
        split.filter(F.col("split") == name).select("value").write.text(f"{path}/{name}")
