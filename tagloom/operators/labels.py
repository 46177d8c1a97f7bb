"""Label vocabulary, encoding and tag counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.operators.joins import coded_arrays, sized_join
from tagloom.operators.ordering import add_row_index
from tagloom.session import BROADCAST_ROWS, materialise, small_side

# Labels one array of annotation labels holds.
LABELS_PER_CHUNK = 10_000


def build_vocabulary(df: DataFrame, tags: str = "meshMajor") -> DataFrame:
    """(label_id, label): distinct labels numbered from 0 in label order."""
    labels = df.select(F.explode(tags).alias("label")).filter("label IS NOT NULL").distinct()
    return add_row_index(labels, ["label"], "label_id").select(
        F.col("label_id").cast("int"), "label"
    )


def unknown_labels(df: DataFrame, vocabulary: DataFrame, tags: str = "meshMajor") -> DataFrame:
    """(label, n) of the tags the vocabulary does not have."""
    seen = df.select(F.explode(tags).alias("label")).groupBy("label").agg(F.count("*").alias("n"))
    return seen.join(small_side(vocabulary), "label", "left_anti")


def with_label_ids(
    df: DataFrame,
    vocabulary: DataFrame,
    tags: str = "meshMajor",
    on_unknown: str = "fail",
    name: str = "label_ids",
) -> DataFrame:
    """Adds the ids of each row's tags, in their order, repeats kept; NULL tags have none.

    ``on_unknown`` is ``"fail"`` or ``"drop"``. Failing happens inside the job,
    on the first unknown tag, so the data is read once.
    """
    if on_unknown not in ("fail", "drop"):
        raise ValueError("on_unknown must be 'fail' or 'drop'")
    coded = coded_arrays(df, tags, vocabulary, "label", "label_id", "_codes")
    known = F.filter("_codes", lambda c: c.isNotNull())
    if on_unknown == "fail":
        lost = F.filter(
            F.arrays_zip(F.col(tags).alias("tag"), F.col("_codes").alias("code")),
            lambda p: p["code"].isNull() & p["tag"].isNotNull(),
        )
        problem = F.concat(F.lit("unknown label: "), F.get(lost, F.lit(0))["tag"])
        known = F.when(F.size(lost) > 0, F.raise_error(problem).cast("array<int>")).otherwise(known)
    return coded.withColumn(name, F.coalesce(known, F.array().cast("array<int>"))).drop("_codes")


def encode_labels(
    df: DataFrame,
    vocabulary: DataFrame,
    key: str = "pmid",
    tags: str = "meshMajor",
    on_unknown: str = "fail",
) -> DataFrame:
    """(key, label_ids) of every row, as for :func:`with_label_ids`; rows of equal or NULL key
    each keep their own."""
    return with_label_ids(df.select(key, tags), vocabulary, tags, on_unknown).select(key, "label_ids")


def decode_labels(coded: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Adds the label name to rows that carry ``label_id``."""
    return coded.join(small_side(vocabulary), "label_id")


def encode_sparse(
    df: DataFrame, size: int, ids: str = "label_ids", name: str = "labels"
) -> DataFrame:
    """Adds the row's labels as a sparse 0/1 vector: (size, sorted ids without repeats)."""
    own = F.array_sort(F.array_distinct(F.filter(ids, lambda i: (i >= 0) & (i < size))))
    return df.withColumn(name, F.struct(F.lit(size).alias("size"), own.alias("indices")))


def encode_multi_hot(
    df: DataFrame, size: int, ids: str = "label_ids", name: str = "multi_hot"
) -> DataFrame:
    """Adds the dense 0/1 vector of length ``size`` of each row's label ids, for the few cases
    that need it; :func:`encode_sparse` is the form for large vocabularies.

    The vector is spelled out from the gaps between sorted ids, so the work per
    row grows with ``size + ids``, not with their product.
    """
    own = F.array_sort(F.array_distinct(F.filter(ids, lambda i: (i >= 0) & (i < size))))
    starts = F.concat(F.array(F.lit(-1)), own)
    ends = F.concat(own, F.array(F.lit(size)))
    pieces = F.zip_with(
        starts,
        ends,
        lambda a, b: F.concat(
            F.when(a >= 0, F.array(F.lit(1))).otherwise(F.array().cast("array<int>")),
            F.array_repeat(F.lit(0), (b - a - 1).cast("int")),
        ),
    )
    return df.withColumn(name, F.flatten(pieces))


def tag_counts(df: DataFrame, tags: str = "meshMajor") -> DataFrame:
    """(label, n): uses of each tag; a tag repeated in a row counts each time."""
    return df.select(F.explode(tags).alias("label")).groupBy("label").agg(F.count("*").alias("n"))


def rare_tags(
    counts: DataFrame, wanted: DataFrame | None = None, min_examples: int | None = None
) -> DataFrame:
    """Counted tags that are in ``wanted`` (label) and used fewer than ``min_examples`` times."""
    if wanted is not None:
        counts = counts.join(small_side(wanted.select("label").distinct()), "label", "left_semi")
    if min_examples is not None:
        counts = counts.filter(F.col("n") < min_examples)
    return counts


def tag_extremes(counts: DataFrame, size: int = 5) -> DataFrame:
    """(side, tag): the biggest and smallest tags as ``label(count)``."""
    shown = F.concat(F.col("label"), F.lit("("), F.col("n").cast("string"), F.lit(")"))
    big = counts.orderBy(F.desc("n"), "label").limit(size)
    small = counts.orderBy("n", F.desc("label")).limit(size)
    return big.select(F.lit("biggest").alias("side"), shown.alias("tag")).unionByName(
        small.select(F.lit("smallest").alias("side"), shown.alias("tag"))
    )


def long_labels(df: DataFrame, key: str = "pmid", tags: str = "meshMajor") -> DataFrame:
    """Distinct (doc_id, label) of a tags column; a row's repeats go before any shuffle."""
    return df.select(
        F.col(key).alias("doc_id"), F.explode(F.array_distinct(tags)).alias("label")
    )


def annotation_sets(
    df: DataFrame, vocabulary: DataFrame, text: str = "text", tags: str = "tags"
) -> DataFrame:
    """(text, accept, n_reject): what :func:`annotation_tasks` says in one row per text.

    ``accept`` holds the text's own labels that are in the vocabulary, sorted, each once; all other labels, ``n_reject``
    of them, are rejected. The rows grow with the texts and not with texts x labels. Texts without labels, or whose
    labels are NULL, accept none.
    """
    numbered = build_vocabulary(vocabulary.select(F.array("label").alias("meshMajor")))
    numbered = materialise(numbered, "vocabulary")
    own = df.select(F.col(text).alias("text"), F.array_sort(F.array_distinct(tags)).alias("_tags"))
    coded = coded_arrays(own, "_tags", numbered, "label", "label_id", "_codes")
    pairs = F.arrays_zip(F.col("_tags").alias("tag"), F.col("_codes").alias("code"))
    accept = F.transform(F.filter(pairs, lambda p: p["code"].isNotNull()), lambda p: p["tag"])
    known = coded.select("text", F.coalesce(accept, F.array().cast("array<string>")).alias("accept"))
    return known.withColumn("n_reject", F.lit(numbered.count()) - F.size("accept"))


def annotation_tasks(
    df: DataFrame,
    vocabulary: DataFrame,
    mode: str = "train",
    text: str = "text",
    tags: str = "tags",
    grant_id: str = "grant_id",
    labels_per_chunk: int = LABELS_PER_CHUNK,
) -> DataFrame:
    """Annotation rows. ``teach``: text and its grant id. ``train``: each text once
    per label, accepted where the text carries the label.

    Labels travel as arrays of ``labels_per_chunk``: a text meets each array by its
    number and unfolds it on the spot. The arrays are broadcast while the vocabulary
    is small enough, so texts are neither shuffled nor cross-joined.
    """
    if mode == "teach":
        return df.select(
            F.col(text).alias("text"), F.struct(F.col(grant_id).alias("grant_id")).alias("meta")
        )
    if mode != "train":
        raise ValueError("mode must be 'train' or 'teach'")
    numbered = add_row_index(vocabulary.select("label").distinct(), ["label"], "_idx")
    chunks = materialise(
        numbered.groupBy(F.floor(F.col("_idx") / labels_per_chunk).cast("int").alias("_chunk")).agg(
            F.collect_list("label").alias("_labels")
        ),
        "chunks",
    )
    texts = df.select(
        F.col(text).alias("text"),
        F.col(tags).alias("_tags"),
        F.explode(F.sequence(F.lit(0), F.lit(max(chunks.count() - 1, 0)))).alias("_chunk"),
    )
    met = sized_join(
        texts, chunks, "_chunk", "text", max_rows=max(BROADCAST_ROWS // labels_per_chunk, 1)
    )
    answer = F.when(F.array_contains("_tags", F.col("label")), "accept").otherwise("reject")
    return met.select("text", "_tags", F.explode("_labels").alias("label")).select(
        "text", "label", answer.alias("answer")
    )
