"""Registered queries: text features, scorers, augmentation, streaming."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.text import WORD
from tagloom.functions.text import words as fn_words
from tagloom.operators import augment as aug
from tagloom.operators import linear, subwords
from tagloom.operators import textfeatures as tx
from tagloom.operators.ordering import add_row_index
from tagloom.operators.predictions import score_batch
from tagloom.plans import views
from tagloom.plans.catalog_labels import RARE, RARE_DOCS, SUPPLY, rare, supply
from tagloom.plans.catalog_metrics import rounded
from tagloom.plans.registry import query
from tagloom.plans.views import sql
from tagloom.session import materialise, scratch_path, small_side
from tagloom.streaming import jobs

# The stop words of the registered text queries.
STOP_WORDS = (
    "a an and are as at be but by for from had has have he her his i in is it its not of on or "
    "she so that the their them there they this to was we were which who will with you"
).split()

# Fixed value: the smallest number of documents a term of the text queries is in.
SETTINGS = tx.TfidfSettings(stop_words=STOP_WORDS, min_df=5)
CUT = 0.25  # cosine above which a label is given

TOKENS = f"""SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) AS pos FROM (
    SELECT doc_id, regexp_extract_all(lower(text), '{WORD}') AS w FROM documents)"""


@query(
    "encode_fixed_length",
    sql(
        """SELECT doc_id, coalesce(string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos), '')
                  || repeat(' 0', CAST(512 - count(id) AS INTEGER)) AS input_ids,
                  repeat('1', CAST(count(id) AS INTEGER))
                  || repeat('0', CAST(512 - count(id) AS INTEGER)) AS attention_mask
           FROM documents LEFT JOIN coded USING (doc_id) GROUP BY doc_id""",
        tokens=TOKENS,
        vocab="""SELECT token, token_id FROM (
            SELECT token, row_number() OVER (ORDER BY count(*) DESC, token) + 1 AS token_id
            FROM tokens GROUP BY token)""",
        coded="""SELECT doc_id, pos, coalesce(token_id, 1) AS id
            FROM tokens LEFT JOIN vocab USING (token) WHERE pos <= 512""",
    ),
)
def encode_fixed_length(spark: SparkSession, d: str) -> DataFrame:
    docs = views.texts(spark, d)
    coded = tx.encode_fixed_length(docs, tx.token_vocabulary(docs))
    return coded.select(
        "doc_id",
        F.concat_ws(" ", F.col("input_ids").cast("array<string>")).alias("input_ids"),
        F.concat_ws("", F.col("attention_mask").cast("array<string>")).alias("attention_mask"),
    )


# Pieces of the sub-word queries: the most used words, the ends of words, and single characters, but no figures.
PIECES = """SELECT piece AS token, row_number() OVER (ORDER BY piece) + 1 AS token_id FROM (
    SELECT token AS piece FROM (SELECT token FROM tokens GROUP BY token ORDER BY count(*) DESC, token LIMIT 800)
    UNION SELECT '##' || ending FROM (SELECT right(token, 3) AS ending FROM tokens WHERE length(token) > 3
        GROUP BY 1 ORDER BY count(*) DESC, ending LIMIT 400)
    UNION SELECT '##' || c FROM letters UNION SELECT c FROM letters)"""
LETTERS = """SELECT DISTINCT c FROM (SELECT unnest(string_split(token, '')) AS c FROM (SELECT DISTINCT token FROM tokens))
    WHERE NOT regexp_matches(c, '[0-9]')"""


def pieces(docs: DataFrame) -> DataFrame:
    """(token, token_id): the vocabulary ``PIECES`` of the documents, from their own words."""
    counts = materialise(
        docs.select(F.explode(fn_words("text")).alias("token")).groupBy("token").agg(F.count("*").alias("n")), "counts"
    )
    letters = counts.select(F.explode(F.split("token", "")).alias("c")).distinct().filter("c <> '' AND NOT c RLIKE '[0-9]'")
    endings = counts.filter("length(token) > 3").groupBy(F.expr("right(token, 3)").alias("ending")).agg(F.sum("n").alias("n"))
    named = [
        counts.orderBy(F.desc("n"), "token").limit(800).select("token"),
        endings.orderBy(F.desc("n"), "ending").limit(400).select(F.concat(F.lit("##"), "ending").alias("token")),
        letters.select(F.col("c").alias("token")),
        letters.select(F.concat(F.lit("##"), "c").alias("token")),
    ]
    numbered = add_row_index(reduce(DataFrame.unionAll, named).distinct(), ["token"], "_at")
    return numbered.select("token", (F.col("_at") + tx.RESERVED).cast("int").alias("token_id"))


@query(
    "encode_subwords",
    sql(
        """SELECT doc_id, CAST(coalesce(sum(len(ids)), 0) AS BIGINT) AS n_pieces,
                  array_to_string((coalesce(flatten(list(ids ORDER BY pos)), CAST([] AS INTEGER[]))
                      || list_transform(range(512), lambda x: CAST(0 AS INTEGER)))[:512], ' ') AS input_ids
           FROM documents LEFT JOIN (SELECT doc_id, pos, coalesce(ids, [1]) AS ids FROM tokens LEFT JOIN coded USING (token))
           USING (doc_id) GROUP BY doc_id""",
        tokens=TOKENS,
        letters=LETTERS,
        pieces=PIECES,
        bodies="""SELECT token_id AS id, starts_with(token, '##') AND length(token) > 2 AS inside,
            CASE WHEN starts_with(token, '##') AND length(token) > 2 THEN token[3:] ELSE token END AS body FROM pieces""",
        words="SELECT DISTINCT token FROM tokens",
        # The longest piece at each place of each word.
        longest="""SELECT token, place, arg_max(id, length(body)) AS id, max(length(body)) AS n
            FROM (SELECT token, unnest(range(1, length(token) + 1)) AS place FROM words) w,
                 (SELECT DISTINCT length(body) AS l FROM bodies) s, bodies b
            WHERE b.inside = (place > 1) AND length(b.body) = l AND place + l <= length(token) + 1 AND b.body = substr(token, place, l)
            GROUP BY 1, 2""",
        coded="""WITH RECURSIVE walk(token, place, ids) AS (
                SELECT token, CAST(1 AS BIGINT), CAST([] AS INTEGER[]) FROM words
                UNION ALL SELECT w.token, w.place + l.n, list_append(w.ids, CAST(l.id AS INTEGER))
                FROM walk w JOIN longest l ON l.token = w.token AND l.place = w.place)
            SELECT token, ids FROM walk WHERE place = length(token) + 1""",
    ),
)
def encode_subwords(spark: SparkSession, d: str) -> DataFrame:
    docs = views.texts(spark, d)
    coded = subwords.encode_subwords(docs, pieces(docs))
    ids = F.concat_ws(" ", F.col("input_ids").cast("array<string>")).alias("input_ids")
    return coded.select("doc_id", "n_pieces", ids)


STOP_LIST = ", ".join(f"'{w}'" for w in STOP_WORDS)

TFIDF = {
    "tf": f"""SELECT doc_id, term, count(*) AS tf FROM (
        SELECT doc_id, unnest(regexp_extract_all(lower(text), '{WORD}')) AS term FROM documents)
        WHERE term NOT IN ({STOP_LIST}) GROUP BY 1, 2""",
    "idf": """SELECT term, ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf FROM (
        SELECT term, CAST(count(*) AS DOUBLE) AS df FROM tf GROUP BY 1) ,
        (SELECT CAST(count(*) AS DOUBLE) AS n FROM documents) WHERE df >= 5""",
    "weights": """SELECT doc_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight
        FROM (SELECT doc_id, term, tf * idf AS raw FROM tf JOIN idf USING (term))""",
}


@query("features_tfidf", sql("SELECT doc_id, term, round(weight, 6) AS weight FROM weights", **TFIDF))
def features_tfidf(spark: SparkSession, d: str) -> DataFrame:
    model, weights = tx.features_tfidf(views.texts(spark, d), SETTINGS)
    terms = small_side(model.terms.select("term_id", "term"))
    return rounded(weights.join(terms, "term_id").select("doc_id", "term", "weight"))


EMBEDDING = {
    **TFIDF,
    "betas": """SELECT label, term, total / sqrt(sum(total * total) OVER (PARTITION BY label)) AS beta
        FROM (SELECT label, term, sum(weight) AS total FROM weights JOIN text_labels USING (doc_id)
              GROUP BY 1, 2)""",
}


@query(
    "label_embedding",
    sql("SELECT label, term, round(beta, 6) AS beta FROM betas", "text_labels", **EMBEDDING),
)
def label_embedding(spark: SparkSession, d: str) -> DataFrame:
    model, weights = tx.features_tfidf(views.texts(spark, d), SETTINGS)
    betas = linear.label_embedding(weights, views.text_labels(spark, d))
    terms = small_side(model.terms.select("term_id", "term"))
    return rounded(betas.join(terms, "term_id").select("label", "term", "beta"))


ROUNDS = 12  # of a split that are spelled out in SQL; once no label changes sides, further ones change nothing


def clusters_sql(vectors: str, per_cluster: int, name: str, n_labels: int) -> dict[str, str]:
    """The clustering of ``vectors`` (label, term, beta), each split and round spelled out; (label,
    cluster) is called ``name``. ``n_labels`` tells how many splits there are."""
    steps = {f"{name}_0": f"SELECT DISTINCT label, 0 AS cluster FROM {vectors}"}
    half = "row_number() OVER (PARTITION BY cluster ORDER BY {order}) > ceil(count(*) OVER (PARTITION BY cluster) / 2.0)"
    for level in range(linear.splits(n_labels, per_cluster)):
        side = f"{name}_{level}_side"
        steps[f"{side}0"] = f"""SELECT label, cluster, CAST({half.format(order="label")} AS INTEGER) AS side
            FROM {name}_{level}"""
        for i in range(ROUNDS):
            steps[f"{side}{i}_apart"] = f"""SELECT cluster, term, sum(CASE side WHEN 0 THEN unit ELSE -unit END) AS apart
                FROM (SELECT cluster, side, term, total / sqrt(sum(total * total) OVER (PARTITION BY cluster, side)) AS unit
                      FROM (SELECT cluster, side, term, sum(beta) AS total FROM {vectors} JOIN {side}{i} USING (label)
                            GROUP BY 1, 2, 3)) GROUP BY 1, 2"""
            steps[f"{side}{i + 1}"] = f"""SELECT label, cluster, CAST({half.format(order="lean DESC, label")} AS INTEGER) AS side
                FROM (SELECT label, cluster, sum(beta * apart) AS lean
                      FROM {vectors} JOIN {side}{i} USING (label) JOIN {side}{i}_apart USING (cluster, term) GROUP BY 1, 2)"""
        steps[f"{name}_{level + 1}"] = f"SELECT label, cluster * 2 + side AS cluster FROM {side}{ROUNDS}"
    steps[name] = f"SELECT label, cluster FROM {name}_{linear.splits(n_labels, per_cluster)}"
    return steps


N_LABELS = 26  # of text_labels: four languages, twenty sources and two marks
CLUSTERED = {**EMBEDDING, **clusters_sql("betas", 5, "members", N_LABELS)}


@query("cluster_labels", sql("SELECT label, cluster FROM members", "text_labels", **CLUSTERED))
def cluster_labels(spark: SparkSession, d: str) -> DataFrame:
    _, weights = tx.features_tfidf(views.texts(spark, d), SETTINGS)
    betas = linear.label_embedding(weights, views.text_labels(spark, d))
    return linear.cluster_labels(betas, per_cluster=5)


def training_sql(own: str, parents: str, name: str, settings: linear.TrainSettings) -> dict[str, str]:
    """The gradient steps of one level, spelled out: the scorers ``name`` (label, term, beta) of
    the labels that ``own`` (doc_id, label) gives to documents, in the clusters ``parents``."""
    keep = 1.0 - settings.rate * settings.decay
    steps = {
        f"{name}_pairs": f"""SELECT row_number() OVER () AS pair, * FROM (
            SELECT doc_id, m.label, max(CASE WHEN m.label = o.label THEN 1.0 ELSE 0.0 END) :: DOUBLE AS y
            FROM {own} o JOIN {parents} p ON o.label = p.label JOIN {parents} m ON m.cluster = p.cluster
            GROUP BY 1, 2)""",
        f"{name}_features": f"""SELECT doc_id, term, weight FROM weights
            UNION ALL SELECT DISTINCT doc_id, '', CAST(1 AS DOUBLE) FROM {own}""",
        f"{name}_keys": f"""SELECT label, term, row_number() OVER () AS key, any_value(size) AS size
            FROM {name}_pairs JOIN {name}_features USING (doc_id)
            JOIN (SELECT label, count(*) AS size FROM {name}_pairs GROUP BY 1) USING (label)
            GROUP BY label, term""",
        f"{name}_cells": f"""SELECT pair, key, weight, size FROM {name}_pairs
            JOIN {name}_features USING (doc_id) JOIN {name}_keys USING (label, term)""",
        f"{name}_r0": f"SELECT pair, 0.5 - y AS r FROM {name}_pairs",
        f"{name}_b0": f"SELECT key, CAST(0 AS DOUBLE) AS beta FROM {name}_keys",
    }
    for i in range(settings.steps):
        if i:
            steps[f"{name}_r{i}"] = f"""SELECT pair, 1.0 / (1.0 + exp(-m)) - y AS r
                FROM (SELECT pair, sum(weight * beta) AS m FROM {name}_cells
                      JOIN {name}_b{i} USING (key) GROUP BY 1) JOIN {name}_pairs USING (pair)"""
        steps[f"{name}_b{i + 1}"] = f"""SELECT key, {keep!r} * beta - {settings.rate!r} * g AS beta
            FROM (SELECT key, sum(r * weight) / any_value(size) AS g FROM {name}_cells
                  JOIN {name}_r{i} USING (pair) GROUP BY 1) JOIN {name}_b{i} USING (key)"""
    steps[name] = f"""SELECT label, term, beta FROM {name}_b{settings.steps} JOIN {name}_keys USING (key)
        WHERE abs(beta) >= {settings.min_weight!r} OR term = ''"""
    return steps


PER_CLUSTER = 8  # of the trained taggers: few enough for a tree of two levels
BY_STEPS = linear.TrainSettings(solver="steps")  # the solver that can be told in SQL


def tree_sql(settings: linear.TrainSettings) -> dict[str, str]:
    """Label tree and scorers of a trained tagger: ``low`` for labels, ``high`` for clusters."""
    return {
        **EMBEDDING,
        **clusters_sql("betas", PER_CLUSTER, "members", N_LABELS),
        "low_parents": "SELECT label, '0:' || cluster AS cluster FROM members",
        "own_labels": "SELECT DISTINCT doc_id, label FROM text_labels",
        "own_clusters": """SELECT DISTINCT doc_id, cluster AS label
            FROM own_labels JOIN low_parents USING (label)""",
        "high_parents": "SELECT DISTINCT cluster AS label, '1:0' AS cluster FROM low_parents",
        **training_sql("own_labels", "low_parents", "low", settings),
        **training_sql("own_clusters", "high_parents", "high", settings),
    }


def trained(spark: SparkSession, d: str, settings: linear.TrainSettings, **more) -> linear.LinearTagger:
    return linear.train_linear_tagger(
        views.texts(spark, d), views.text_labels(spark, d), SETTINGS, settings, PER_CLUSTER, **more
    )


@query(
    "train_linear_tagger",
    sql(
        """SELECT 0 AS level, label, term, round(beta, 6) AS beta FROM high
           UNION ALL SELECT 1, label, term, round(beta, 6) FROM low""",
        "text_labels", **tree_sql(BY_STEPS),
    ),
)
def train_linear_tagger(spark: SparkSession, d: str) -> DataFrame:
    """Betas of a tagger trained on all documents, with their tree level and term."""
    tagger = trained(spark, d, BY_STEPS)
    levels = [x.betas.withColumn("level", F.lit(i)) for i, x in enumerate(tagger.levels)]
    betas = reduce(DataFrame.unionByName, levels)
    terms = small_side(tagger.tfidf.terms.select("term_id", "term"))
    named = betas.join(terms, "term_id", "left")
    return rounded(named.select("level", "label", F.coalesce("term", F.lit("")).alias("term"), "beta"))


@query(
    "train_linear_dual",
    sql(
        """SELECT label, cluster, n, CAST(coalesce(n_own, 0) AS BIGINT) AS n_own, true AS solved
           FROM (SELECT label, cluster, count(DISTINCT doc_id) AS n FROM low_parents
                 JOIN (SELECT doc_id, cluster FROM own_labels JOIN low_parents USING (label)) USING (cluster) GROUP BY 1, 2)
           LEFT JOIN (SELECT label, count(*) AS n_own FROM own_labels GROUP BY 1) USING (label)""",
        "text_labels", **EMBEDDING, **clusters_sql("betas", PER_CLUSTER, "members", N_LABELS),
        low_parents="SELECT label, '0:' || cluster AS cluster FROM members",
        own_labels="SELECT DISTINCT doc_id, label FROM text_labels",
    ),
)
def train_linear_dual(spark: SparkSession, d: str) -> DataFrame:
    """For each label of the bottom level, the documents its scorer was trained on, and whether the loss of
    that scorer over them, worked out anew, is proved to be near the least one: it may not be above the
    gap plus the loss of the scorer that the gradient steps find."""
    _, weights = tx.features_in_blocks(views.texts(spark, d), SETTINGS)
    truth = materialise(views.text_labels(spark, d).distinct(), "truth")
    embedding = materialise(linear.label_embedding(weights, truth), "embedding")
    parents = linear.label_tree(embedding, PER_CLUSTER)[-1]
    settings = linear.TrainSettings(min_weight=0.0)
    solved = materialise(linear.solve_in_blocks(weights, truth, parents, settings), "solved")
    stepped = linear.train_betas(weights, truth, parents, linear.TrainSettings(solver="steps", min_weight=0.0))
    pairs = materialise(linear.training_pairs(truth, parents), "pairs")
    losses = linear.losses(weights.weights(), pairs, solved, settings.decay)
    others = linear.losses(weights.weights(), pairs, stepped, settings.decay)
    gaps = solved.filter(F.col("term_id") == linear.BIAS).select("label", "gap")
    near = (F.col("gap") <= settings.gap) & (F.col("loss") <= F.col("stepped") + settings.gap)
    return (
        losses.join(others.select("label", F.col("loss").alias("stepped")), "label")
        .join(gaps, "label")
        .join(parents, "label")
        .select("label", "cluster", "n", "n_own", near.alias("solved"))
    )


BEST = {
    **EMBEDDING,
    "scores": """SELECT doc_id, label, sum(weight * beta) AS score
        FROM weights JOIN betas USING (term) GROUP BY 1, 2""",
    "best": """SELECT doc_id, label, score FROM (
        SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) AS rn
        FROM scores) WHERE rn <= 5""",
}

def tagger(spark: SparkSession, d: str) -> linear.LinearTagger:
    return linear.embedding_tagger(
        views.texts(spark, d), views.text_labels(spark, d), SETTINGS, only_topk=5
    )


@query(
    "score_linear",
    sql(
        """SELECT doc_id, label, round(score, 6) AS score FROM (
             SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) AS rn FROM (
               SELECT doc_id, label, sum(weight * beta) AS score
               FROM near JOIN members ON near.cluster = members.cluster
               JOIN weights USING (doc_id) JOIN betas USING (label, term) GROUP BY 1, 2)) WHERE rn <= 5""",
        "text_labels", **CLUSTERED,
        centres="""SELECT cluster, term, sum(beta) / any_value(size) AS beta
            FROM betas JOIN members USING (label)
            JOIN (SELECT cluster, count(*) AS size FROM members GROUP BY 1) USING (cluster) GROUP BY 1, 2""",
        near="""SELECT doc_id, cluster FROM (
            SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, CAST(cluster AS VARCHAR)) AS rn
            FROM (SELECT doc_id, cluster, sum(weight * beta) AS score
                  FROM weights JOIN centres USING (term) GROUP BY 1, 2)) WHERE rn <= 2""",
    ),
)
def score_linear(spark: SparkSession, d: str) -> DataFrame:
    """The labels of each document's two nearest clusters."""
    _, weights = tx.features_tfidf(views.texts(spark, d), SETTINGS)
    betas = materialise(linear.label_embedding(weights, views.text_labels(spark, d)))
    clusters = materialise(linear.cluster_labels(betas, per_cluster=5), "clusters")
    return rounded(linear.score_linear(weights, betas, k=5, clusters=clusters, beam=2))


@query(
    "score_linear_exact",
    sql("SELECT doc_id, label, round(score, 6) AS score FROM best", "text_labels", **BEST),
)
def score_linear_exact(spark: SparkSession, d: str) -> DataFrame:
    """The best labels of each document, though clusters whose bound is too low are not scored."""
    _, weights = tx.features_in_blocks(views.texts(spark, d), SETTINGS)
    betas = materialise(linear.label_embedding(weights, views.text_labels(spark, d)))
    clusters = linear.cluster_labels(betas, per_cluster=5)
    return rounded(linear.score_exact(weights, betas, clusters, k=5))


TAGGED = sql(
    f"""SELECT doc_id, coalesce(string_agg(label, '|' ORDER BY label) FILTER (score > {CUT}), '') AS tags
        FROM documents LEFT JOIN best USING (doc_id) GROUP BY doc_id""",
    "text_labels", **BEST,
)


@query("score_batch", TAGGED)
def score_batch_query(spark: SparkSession, d: str) -> DataFrame:
    tags = score_batch(views.texts(spark, d), tagger(spark, d).score, CUT)
    return tags.select("doc_id", F.concat_ws("|", "tags").alias("tags"))


def level_sql(scorers: str) -> str:
    return f"""SELECT doc_id, label, 1.0 / (1.0 + exp(-sum(weight * beta))) AS score
        FROM (SELECT doc_id, term, weight FROM weights
              UNION ALL SELECT doc_id, '', CAST(1 AS DOUBLE) FROM documents) f
        JOIN {scorers} USING (term) GROUP BY 1, 2"""


TREE_BEST = {
    **tree_sql(BY_STEPS),
    "low_scores": level_sql("low"),
    "above": f"""SELECT doc_id, label, score FROM (
        SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) AS rn
        FROM ({level_sql("high")})) WHERE rn <= 2""",
    "best": """SELECT doc_id, label, score FROM (
        SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) AS rn FROM (
            SELECT doc_id, s.label, a.score * s.score AS score FROM above a
            JOIN low_parents p ON p.cluster = a.label
            JOIN low_scores s USING (doc_id) WHERE s.label = p.label)) WHERE rn <= 5""",
}


def saved_tree(spark: SparkSession, d: str) -> linear.LinearTagger:
    """A trained tree with two levels, saved, loaded, and followed along its two best clusters."""
    path = scratch_path(spark, "tagger")
    linear.save_tagger(trained(spark, d, BY_STEPS, only_topk=5, beam=2), path)
    return linear.load_tagger(spark, path)


@query("model_save_load", sql("SELECT doc_id, label, round(score, 6) AS score FROM best", "text_labels", **TREE_BEST))
def model_save_load(spark: SparkSession, d: str) -> DataFrame:
    return rounded(saved_tree(spark, d).score(views.texts(spark, d)))


TREE_TAGGED = sql(
    f"""SELECT doc_id, coalesce(string_agg(label, '|' ORDER BY label) FILTER (score > {CUT}), '') AS tags
        FROM documents LEFT JOIN best USING (doc_id) GROUP BY doc_id""",
    "text_labels", **TREE_BEST,
)


@query("score_batch_tree", TREE_TAGGED)
def score_batch_tree(spark: SparkSession, d: str) -> DataFrame:
    """The tags a trained, saved tree gives."""
    tags = score_batch(views.texts(spark, d), saved_tree(spark, d).score, CUT)
    return tags.select("doc_id", F.concat_ws("|", "tags").alias("tags"))


TEMPLATE = "About {TOPIC}: {ABSTRACT}"

REQUESTS = f"""SELECT label, pmid, abstractText, meshMajor,
        md5(label || ':' || pmid) AS request_id,
        CAST(ceil(CAST({SUPPLY} AS DOUBLE) / least({SUPPLY}, available)) AS INTEGER) AS n
    FROM (SELECT label, pmid, row_number() OVER (PARTITION BY label ORDER BY pmid) AS rn,
                 count(*) OVER (PARTITION BY label) AS available FROM seeds)
    JOIN articles USING (pmid) WHERE rn <= {SUPPLY}"""
REQUEST_VIEWS = {"rare": RARE, "seeds": f"{RARE_DOCS} WHERE label IN (SELECT label FROM rare)", "requests": REQUESTS}


def requests(spark: SparkSession, d: str) -> DataFrame:
    """As many examples wanted as rare tags have documents on average: some have fewer."""
    articles, tags = materialise(views.articles(spark, d), "articles"), materialise(rare(spark, d))
    required = supply(aug.seed_docs(articles, tags))
    return aug.build_requests(articles, tags, required, TEMPLATE, year="2024")


@query(
    "build_requests",
    sql(
        f"""SELECT request_id, 'gpt-3.5-turbo' AS model, n, CAST(1.5 AS DOUBLE) AS temperature,
                  CAST(1 AS DOUBLE) AS top_p, CAST(0 AS DOUBLE) AS presence_penalty, 'user' AS role,
                  'About ' || label || ': ' || abstractText AS content, label AS featured_tag,
                  array_to_string(meshMajor, '|') AS tags, {SUPPLY} AS required_examples,
                  abstractText AS existing_example, '2024' AS year
           FROM requests""",
        "articles", **REQUEST_VIEWS,
    ),
)
def build_requests(spark: SparkSession, d: str) -> DataFrame:
    m, meta = F.col("messages")[0], F.col("metadata")
    return requests(spark, d).select(
        "request_id", "model", "n", "temperature", "top_p", "presence_penalty",
        m.role.alias("role"), m.content.alias("content"),
        meta.featured_tag.alias("featured_tag"), F.concat_ws("|", meta.tags).alias("tags"),
        meta.required_examples.alias("required_examples"),
        meta.existing_example.alias("existing_example"), meta.year.alias("year"),
    )


@query(
    "ingest_responses",
    sql(
        f"""SELECT md5(request_id || ':0') AS pmid, 'gpt-3.5-turbo' AS journal, '2024' AS year,
                  'a new ' || abstractText AS "abstractText", label || 's story' AS title,
                  array_to_string(meshMajor, '|') AS tags, abstractText AS existing_example,
                  {SUPPLY} AS required_examples, label AS featured_tag, CAST(NULL AS VARCHAR) AS rejected
           FROM requests WHERE label <> 'Brand#3'
           UNION ALL
           SELECT request_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, label, unnest(
               ['Sorry, ' || label, '{{"abstract":"' || label || '"}}', '{{"abstract":"a","title":"b"}} done'])
           FROM requests WHERE label <> 'Brand#3'
           UNION ALL
           SELECT request_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, label, NULL
           FROM requests WHERE label = 'Brand#3'""",
        "articles", **REQUEST_VIEWS,
    ),
)
def ingest_responses(spark: SparkSession, d: str) -> DataFrame:
    """One good answer per request and three that must be rejected; one tag failed, and its
    requests are listed among the rejected."""
    tag = F.col("metadata.featured_tag")
    good = F.to_json(
        F.struct(
            F.concat(F.lit('a "new" '), F.col("metadata.existing_example")).alias("abstract"),
            F.concat(tag, F.lit("'s story")).alias("title"),
        )
    )
    answers = [
        F.concat(F.lit("\n"), good, F.lit(" ")),
        F.concat(F.lit("Sorry, "), tag),
        F.concat(F.lit('{"abstract":"'), tag, F.lit('"}')),
        F.lit('{"abstract":"a","title":"b"} done'),
    ]
    choices = [
        F.struct(F.struct(F.lit("assistant").alias("role"), a.alias("content")).alias("message"))
        for a in answers
    ]
    responses = requests(spark, d).select(
        "request_id", (tag == "Brand#3").alias("failed"), F.array(*choices).alias("choices"), "metadata"
    )
    responses = materialise(responses, "responses")  # read for the articles and for the rejected
    articles, rejected = aug.ingest_responses(responses)
    kept = articles.withColumn("tags", F.concat_ws("|", "meshMajor")).drop("meshMajor")
    refused = rejected.select(
        F.col("request_id").alias("pmid"), "featured_tag", F.col("answer").alias("rejected")
    )
    return kept.unionByName(refused, allowMissingColumns=True)


@query(
    "stream_ingest",
    sql(
        """SELECT pmid, year, array_to_string("meshMajor", '|') AS tags FROM articles
           WHERE "abstractText" IS NOT NULL
           UNION ALL SELECT NULL, NULL, '{"pmid":' || pmid || '",,' FROM articles
           WHERE "abstractText" IS NULL""",
        "articles",
    ),
)
def stream_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Wrapped article files, taken in by a stream two files at a time."""
    source, out, state = (scratch_path(spark, n) for n in ("incoming", "taken", "state"))
    whole = F.concat(F.to_json(F.struct("journal", "meshMajor", "year", "abstractText", "title", "pmid")), F.lit(","))
    broken = F.concat(F.lit('{"pmid":'), "pmid", F.lit('",,'))
    lines = views.articles(spark, d).select(
        "pmid", F.when(F.col("abstractText").isNull(), broken).otherwise(whole).alias("value")
    )
    lines.repartition(4, "pmid").select("value").write.text(source)
    jobs.stream_ingest(spark, source, out, state, max_files=2).awaitTermination()
    good = spark.read.parquet(f"{out}/articles")
    bad = spark.read.schema("line STRING, batch_id INT").parquet(f"{out}/quarantine")
    none = F.lit(None).cast("string")
    return good.select(
        "pmid", F.col("year").cast("string").alias("year"), F.concat_ws("|", "meshMajor").alias("tags")
    ).unionByName(bad.select(none.alias("pmid"), none.alias("year"), F.col("line").alias("tags")))


ARRIVE = 8  # files of a micro-batch, each written and read by a task


@query(
    "stream_monthly",
    """SELECT CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month,
              count(*) AS n, min(o_orderkey) AS first_key
       FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 50 <> 0 THEN o_orderdate END AS day FROM orders)
       GROUP BY 1, 2""",
)
def stream_monthly(spark: SparkSession, d: str) -> DataFrame:
    """Orders that arrive in files, a third of them twice; the second run of the stream finds late ones."""
    source, out, state = (scratch_path(spark, n) for n in ("incoming", "months", "state"))
    day = F.when(F.col("o_orderkey") % 50 != 0, F.col("o_orderdate"))
    orders = views.table(spark, d, "orders").select("o_orderkey", day.alias("day"))
    for late in (False, True):
        new = orders.filter((F.col("o_orderkey") % 3 == 0) | ((F.col("o_orderkey") % 3 == 1) == F.lit(late)))
        new.repartition(2 * ARRIVE, "o_orderkey").write.mode("append").parquet(source)
        arriving = spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", ARRIVE).parquet(source)
        arriving = arriving.withColumn("arrived", F.col("_metadata.file_modification_time"))
        jobs.stream_monthly(arriving, "o_orderkey", "day", "arrived", out, state).awaitTermination()
    rows, _ = jobs.read_stream_months(spark, out)
    return rows.groupBy("year", "month").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_key"))


def streamed(spark: SparkSession, d: str, scorer: linear.LinearTagger) -> DataFrame:
    source, out, state = (scratch_path(spark, n) for n in ("incoming", "scored", "state"))
    docs = views.texts(spark, d)
    docs.repartition(4, "doc_id").write.parquet(source)
    arriving = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 2).parquet(source)
    jobs.stream_score(arriving, scorer.score, out, state, CUT).awaitTermination()
    return spark.read.parquet(out).select("doc_id", F.concat_ws("|", "tags").alias("tags"))


@query("stream_score", TAGGED)
def stream_score(spark: SparkSession, d: str) -> DataFrame:
    """The tags of :func:`score_batch`, given to documents as they arrive."""
    return streamed(spark, d, tagger(spark, d))


@query("stream_score_tree", TREE_TAGGED)
def stream_score_tree(spark: SparkSession, d: str) -> DataFrame:
    """The tags of :func:`score_batch_tree`, given to documents as they arrive."""
    return streamed(spark, d, saved_tree(spark, d))
