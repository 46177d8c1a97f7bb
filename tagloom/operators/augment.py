"""Generation requests for rare tags, and the generated articles that come back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions import text as fn
from tagloom.operators.ordering import top_k
from tagloom.session import materialise, small_side

PROMPT = (
    "Write a new research abstract about the topic below, inspired by the example "
    "but clearly different from it. Answer with one well-formed JSON object with the "
    "fields 'abstract' (the new text) and 'title' (one sentence that sums it up).\n\n"
    "EXAMPLE:\n{ABSTRACT}\n\nTOPIC:\n{TOPIC}"
)


def seed_docs(
    articles: DataFrame, tags: DataFrame, key: str = "pmid", field: str = "meshMajor"
) -> DataFrame:
    """(label, key): the documents of every tag in ``tags``, for all tags in one pass."""
    carried = articles.select(key, F.explode(F.array_distinct(field)).alias("label"))
    return carried.join(small_side(tags.select("label")), "label", "left_semi")


def seeds_per_tag(seeds: DataFrame, required: int, key: str = "pmid") -> DataFrame:
    """(label, key, rn, available, used, n_per_seed): the first ``min(required, available)``
    documents of each tag, each asked for ``ceil(required / used)`` texts."""
    available = seeds.groupBy("label").agg(F.count("*").alias("available"))
    chosen = top_k(seeds, "label", [F.col(key)], required, "rn", spread_by=key)
    used = F.least(F.lit(required), F.col("available"))
    return chosen.join(available, "label").select(
        "label",
        key,
        "rn",
        "available",
        used.cast("int").alias("used"),
        F.ceil(F.lit(required) / used).cast("int").alias("n_per_seed"),
    )


def build_requests(
    articles: DataFrame,
    tags: DataFrame,
    required: int = 25,
    template: str = PROMPT,
    model: str = "gpt-3.5-turbo",
    temperature: float = 1.5,
    top_p: float = 1.0,
    presence_penalty: float = 0.0,
    year: str | None = None,
    key: str = "pmid",
) -> DataFrame:
    """One request per (tag, seed document), with what is needed to store its answers."""
    # The seeds are chosen on keys alone. They are few (tags times ``required``), so the
    # articles are then filtered where they lie instead of being shuffled.
    plan = materialise(seeds_per_tag(seed_docs(articles, tags, key), required, key), "seeds")
    full = articles.select(key, "abstractText", "meshMajor").join(small_side(plan), key)
    when = F.lit(str(year)) if year is not None else F.year(F.current_date()).cast("string")
    message = F.struct(
        F.lit("user").alias("role"),
        fn.render_prompt(template, "label", "abstractText").alias("content"),
    )
    return full.select(
        F.md5(F.concat_ws(":", "label", F.col(key).cast("string"))).alias("request_id"),
        F.lit(model).alias("model"),
        F.col("n_per_seed").alias("n"),
        F.lit(float(temperature)).alias("temperature"),
        F.lit(float(top_p)).alias("top_p"),
        F.lit(float(presence_penalty)).alias("presence_penalty"),
        F.array(message).alias("messages"),
        F.struct(
            F.col("label").alias("featured_tag"),
            F.col("meshMajor").alias("tags"),
            F.lit(required).alias("required_examples"),
            F.col("abstractText").alias("existing_example"),
            when.alias("year"),
            F.lit(model).alias("model_key"),
        ).alias("metadata"),
    )


def read_answers(responses: DataFrame) -> DataFrame:
    """One row per answer: request_id, choice, metadata, answer text, parsed struct or NULL.

    A failed response, or one without choices, has one row without choice and answer; a
    choice without a message has no answer.
    """
    given = F.when(~F.coalesce("failed", F.lit(False)), F.col("choices"))
    choices = responses.select(
        "request_id", "metadata", F.posexplode_outer(given).alias("choice", "c")
    )
    answers = choices.select(
        "request_id", "choice", "metadata", F.col("c.message.content").alias("answer")
    )
    return answers.withColumn("parsed", fn.parse_generated("answer"))


def ingest_responses(responses: DataFrame, ids: str = "md5") -> tuple[DataFrame, DataFrame]:
    """(articles, rejected): generated articles, and the answers that could not be read, with
    the responses that failed and the choices without a message among them.

    ``ids="md5"`` derives the article id from request and choice, so a rerun gives
    the same ids; ``ids="uuid"`` draws a random one.
    """
    answers = read_answers(responses)
    if ids == "md5":
        pmid = F.md5(F.concat_ws(":", "request_id", F.col("choice").cast("string")))
    else:
        pmid = F.replace(F.uuid(), F.lit("-"), F.lit(""))
    good = answers.filter("parsed IS NOT NULL").select(
        F.col("metadata.model_key").alias("journal"),
        F.col("metadata.tags").alias("meshMajor"),
        F.col("metadata.year").alias("year"),
        fn.strip_quotes("parsed.abstract").alias("abstractText"),
        pmid.alias("pmid"),
        fn.strip_quotes("parsed.title").alias("title"),
        fn.strip_quotes("metadata.existing_example").alias("existing_example"),
        F.col("metadata.required_examples").alias("required_examples"),
        F.col("metadata.featured_tag").alias("featured_tag"),
    )
    bad = answers.filter("parsed IS NULL").select(
        "request_id", "choice", F.col("metadata.featured_tag").alias("featured_tag"), "answer"
    )
    return good, bad
