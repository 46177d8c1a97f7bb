"""Registered queries: joins, label encoding, counts, splits, samples, shards, sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.operators import agreement, labels, sampling, taxonomy
from tagloom.operators import augment as aug
from tagloom.operators.filters import filter_category_type, filter_tags_any, filter_years
from tagloom.operators.ordering import add_row_index
from tagloom.operators.predictions import topk_labels
from tagloom.plans import views
from tagloom.plans.registry import query
from tagloom.plans.views import sql
from tagloom.session import materialise, scratch_path
from tagloom.sources.records import read_terms

# The year filter of the rare-tag question.
RARE_YEARS = ("1995", "1996")
UNWANTED = ("Brand#7", "Brand#11")  # tags that the list of wanted tags leaves out


def joined(column: str) -> F.Column:
    return F.concat_ws("|", column)


VOCAB = """SELECT CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS label_id, label
           FROM (SELECT DISTINCT unnest("meshMajor") AS label FROM articles)"""

ENCODED = """SELECT pmid, coalesce(string_agg(CAST(label_id AS VARCHAR), '|' ORDER BY pos), '') AS label_ids
    FROM (SELECT pmid, unnest("meshMajor") AS label, generate_subscripts("meshMajor", 1) AS pos
          FROM articles) JOIN vocab USING (label) GROUP BY pmid
    UNION ALL SELECT pmid, '' FROM articles WHERE len("meshMajor") = 0"""


@query("agg_label_vocab", sql(VOCAB, "articles"))
def agg_label_vocab(spark: SparkSession, d: str) -> DataFrame:
    return labels.build_vocabulary(views.articles(spark, d))


@query("join_encode_labels", sql(ENCODED, "articles", vocab=VOCAB))
def join_encode_labels(spark: SparkSession, d: str) -> DataFrame:
    articles = views.articles(spark, d)
    coded = labels.encode_labels(articles, labels.build_vocabulary(articles))
    return coded.select("pmid", joined(F.col("label_ids").cast("array<string>")).alias("label_ids"))


@query(
    "join_decode_labels",
    sql("SELECT pmid, label, count(*) AS n FROM (SELECT pmid, unnest(\"meshMajor\") AS label FROM articles) GROUP BY ALL", "articles"),
)
def join_decode_labels(spark: SparkSession, d: str) -> DataFrame:
    articles = views.articles(spark, d)
    vocabulary = labels.build_vocabulary(articles)
    coded = labels.encode_labels(articles, vocabulary)
    rows = coded.select("pmid", F.explode("label_ids").alias("label_id"))
    named = labels.decode_labels(rows, vocabulary)
    return named.groupBy("pmid", "label").agg(F.count("*").alias("n"))


@query(
    "encode_multi_hot",
    sql(
        """SELECT pmid, (SELECT CAST(count(*) AS INTEGER) FROM vocab) AS size,
                  coalesce(string_agg(CAST(label_id AS VARCHAR), '|' ORDER BY label_id), '') AS indices
           FROM articles LEFT JOIN hot USING (pmid) GROUP BY pmid""",
        "articles",
        vocab=VOCAB,
        hot="""SELECT DISTINCT pmid, label_id FROM (SELECT pmid, unnest("meshMajor") AS label FROM articles)
               JOIN vocab USING (label)""",
    ),
)
def encode_multi_hot(spark: SparkSession, d: str) -> DataFrame:
    articles = views.articles(spark, d)
    vocabulary = labels.build_vocabulary(articles)
    coded = labels.encode_labels(articles, vocabulary)
    hot = labels.encode_sparse(coded, vocabulary.count())
    indices = F.col("labels.indices").cast("array<string>")
    return hot.select("pmid", F.col("labels.size").alias("size"), joined(indices).alias("indices"))


COUNTS = 'SELECT label, count(*) AS n FROM (SELECT unnest("meshMajor") AS label FROM articles) GROUP BY 1'


@query("agg_tag_counts", sql(f"{COUNTS} ORDER BY n DESC, label", "articles"))
def agg_tag_counts(spark: SparkSession, d: str) -> DataFrame:
    return labels.tag_counts(views.articles(spark, d)).orderBy(F.desc("n"), "label")


YEAR_COUNTS = f"""SELECT label, count(*) AS n FROM (
    SELECT unnest("meshMajor") AS label FROM articles WHERE year IN {RARE_YEARS}) GROUP BY 1"""
RARE = f"""SELECT label, n FROM ({YEAR_COUNTS}) WHERE label NOT IN {UNWANTED}
    AND n < (SELECT floor(avg(n)) FROM ({YEAR_COUNTS}))"""


def rare(spark: SparkSession, d: str) -> DataFrame:
    """Tags of a list that have fewer examples in two years than tags have on average."""
    counts = labels.tag_counts(filter_years(views.articles(spark, d), RARE_YEARS))
    counts = materialise(counts, "counts")
    limit = counts.agg(F.floor(F.avg("n"))).first()[0]
    path = scratch_path(spark, "wanted")
    known = views.vocabulary(spark, d).filter(~F.col("label").isin(*UNWANTED))
    known.unionByName(spark.createDataFrame([("no such tag",)], "label STRING")).write.text(path)
    return labels.rare_tags(counts, read_terms(spark, path), limit)


@query("agg_rare_tags", sql(RARE, "articles"))
def agg_rare_tags(spark: SparkSession, d: str) -> DataFrame:
    return rare(spark, d)


@query(
    "agg_tag_extremes",
    sql(
        """SELECT 'biggest' AS side, label || '(' || n || ')' AS tag
           FROM (SELECT * FROM rare ORDER BY n DESC, label LIMIT 5)
           UNION ALL SELECT 'smallest', label || '(' || n || ')'
           FROM (SELECT * FROM rare ORDER BY n, label DESC LIMIT 5)""",
        "articles",
        rare=RARE,
    ),
)
def agg_tag_extremes(spark: SparkSession, d: str) -> DataFrame:
    """Of the rare tags, those with the most and the fewest examples."""
    return labels.tag_extremes(rare(spark, d))


@query(
    "join_category_name",
    sql(
        """SELECT pub_id, p_type AS category_id, kind AS category_type, name AS category_name
           FROM (SELECT l_orderkey AS pub_id, p_type, kind FROM headings)
           LEFT JOIN categories ON category_id = p_type WHERE kind IN ('for', 'hrcs_rac')""",
        "headings",
        "categories",
    ),
)
def join_category_name(spark: SparkSession, d: str) -> DataFrame:
    kept = filter_category_type(views.publications(spark, d), ["for", "hrcs_rac"])
    named = taxonomy.join_category_name(kept, views.categories(spark, d))
    return named.select("pub_id", "category_id", "category_type", "category_name")


@query(
    "antijoin_exclusions",
    sql(
        """SELECT name AS "DescriptorName" FROM taxonomy
           WHERE NOT contains(coalesce(annotation, ''), ': Do not use')
             AND name NOT IN (SELECT p_name || ' ' || p_partkey FROM part WHERE p_type = 'PROMO')""",
        "taxonomy",
    ),
)
def antijoin_exclusions(spark: SparkSession, d: str) -> DataFrame:
    excluded = views.table(spark, d, "part").filter("p_type = 'PROMO'").select(
        F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("DescriptorName")
    )
    return taxonomy.inclusion_list(views.taxonomy(spark, d), excluded)


@query(
    "semijoin_subtree",
    sql(
        """SELECT ui, name, tree_number FROM taxonomy t WHERE EXISTS (
             SELECT 1 FROM taxonomy r JOIN part ON r.name = p_name || ' ' || p_partkey
             WHERE p_size = 11 AND (t.tree_number = r.tree_number
                                    OR starts_with(t.tree_number, r.tree_number || '.')))""",
        "taxonomy",
    ),
)
def semijoin_subtree(spark: SparkSession, d: str) -> DataFrame:
    terms = views.table(spark, d, "part").filter("p_size = 11").select(
        F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("name")
    )
    return taxonomy.subtree(views.taxonomy(spark, d), terms).select("ui", "name", "tree_number")


@query(
    "crossjoin_annotation",
    sql(
        """SELECT "abstractText" AS text, label,
                  CASE WHEN list_contains("meshMajor", label) THEN 'accept' ELSE 'reject' END AS answer
           FROM articles, vocabulary WHERE "abstractText" IS NOT NULL""",
        "articles",
        "vocabulary",
    ),
)
def crossjoin_annotation(spark: SparkSession, d: str) -> DataFrame:
    """Every text with every label, unfolded row by row from arrays of labels."""
    articles = views.articles(spark, d).filter("abstractText IS NOT NULL")
    return labels.annotation_tasks(
        articles, views.vocabulary(spark, d), text="abstractText", tags="meshMajor"
    )


@query(
    "annotation_sets",
    sql(
        """SELECT "abstractText" AS text,
                  coalesce(array_to_string(list_sort(list_filter(list_distinct("meshMajor"),
                      lambda t: list_contains(own, t))), '|'), '') AS accept,
                  CAST(len(own) - len(list_filter(list_distinct("meshMajor"),
                      lambda t: list_contains(own, t))) AS BIGINT) AS n_reject
           FROM articles, wanted WHERE "abstractText" IS NOT NULL""",
        "articles",
        "vocabulary",
        wanted=f"SELECT list(label) AS own FROM vocabulary WHERE label NOT IN {UNWANTED}",
    ),
)
def annotation_sets(spark: SparkSession, d: str) -> DataFrame:
    """Every text with the set of labels it accepts, of those that annotators are asked about."""
    articles = views.articles(spark, d).filter("abstractText IS NOT NULL")
    wanted = views.vocabulary(spark, d).filter(~F.col("label").isin(*UNWANTED))
    sets = labels.annotation_sets(articles, wanted, text="abstractText", tags="meshMajor")
    return sets.select("text", joined("accept").alias("accept"), F.col("n_reject").cast("long").alias("n_reject"))


RARE_DOCS = 'SELECT label, pmid FROM (SELECT DISTINCT pmid, unnest("meshMajor") AS label FROM articles)'
SUPPLY = """(SELECT CAST(floor(avg(c)) AS INTEGER) FROM (SELECT count(*) AS c FROM seeds GROUP BY label))"""


def supply(seeds: DataFrame) -> int:
    """How many documents a tag has on average."""
    counts = seeds.groupBy("label").agg(F.count("*").alias("c"))
    return int(counts.agg(F.floor(F.avg("c"))).first()[0] or 0)


@query("join_seed_docs", sql(f"{RARE_DOCS} WHERE label IN (SELECT label FROM rare)", "articles", rare=RARE))
def join_seed_docs(spark: SparkSession, d: str) -> DataFrame:
    return aug.seed_docs(views.articles(spark, d), rare(spark, d)).select("label", "pmid")


@query(
    "seeds_per_tag",
    sql(
        f"""SELECT label, pmid, CAST(rn AS INTEGER) AS rn, available,
                  CAST(least({SUPPLY}, available) AS INTEGER) AS used,
                  CAST(ceil(CAST({SUPPLY} AS DOUBLE) / least({SUPPLY}, available)) AS INTEGER) AS n_per_seed
           FROM (SELECT label, pmid, row_number() OVER (PARTITION BY label ORDER BY pmid) AS rn,
                        count(*) OVER (PARTITION BY label) AS available FROM seeds)
           WHERE rn <= {SUPPLY}""",
        "articles",
        seeds=RARE_DOCS,
    ),
)
def seeds_per_tag(spark: SparkSession, d: str) -> DataFrame:
    """As many seeds for each tag as tags have documents on average: some have fewer."""
    seeds = materialise(aug.seed_docs(views.articles(spark, d), views.vocabulary(spark, d)), "seeds")
    return aug.seeds_per_tag(seeds, supply(seeds))


def tagged(spark: SparkSession, d: str, scores: DataFrame) -> DataFrame:
    hit = F.when(F.col("score") > 0.5, F.col("label"))
    return scores.groupBy("doc_id").agg(F.array_sort(F.collect_set(hit)).alias("tags"))


def two_taggers(spark: SparkSession, d: str) -> DataFrame:
    return agreement.join_two_taggers(
        tagged(spark, d, views.scores_a(spark, d)), tagged(spark, d, views.scores_b(spark, d))
    )


PAIRS = """SELECT doc_id, coalesce(list(DISTINCT a.label) FILTER (a.score > 0.5), []) AS a_terms,
                  coalesce(list(DISTINCT b.label) FILTER (b.score > 0.5), []) AS b_terms
           FROM scores_a a FULL JOIN scores_b b USING (doc_id, label) GROUP BY doc_id"""
PAIR_VIEWS = ("scores_a", "scores_b")


@query(
    "join_two_taggers",
    sql(
        """SELECT doc_id, array_to_string(list_sort(a_terms), '|') AS a_terms,
                  array_to_string(list_sort(b_terms), '|') AS b_terms FROM pairs""",
        *PAIR_VIEWS,
        pairs=PAIRS,
    ),
)
def join_two_taggers(spark: SparkSession, d: str) -> DataFrame:
    return two_taggers(spark, d).select(
        "doc_id", joined("a_terms").alias("a_terms"), joined("b_terms").alias("b_terms")
    )


@query(
    "set_common_terms",
    sql(
        """SELECT doc_id, array_to_string(list_sort(list_intersect(a_terms, b_terms)), '|') AS common_terms
           FROM pairs""",
        *PAIR_VIEWS,
        pairs=PAIRS,
    ),
)
def set_common_terms(spark: SparkSession, d: str) -> DataFrame:
    return agreement.common_terms(two_taggers(spark, d)).select(
        "doc_id", joined("common_terms").alias("common_terms")
    )


@query(
    "set_only_terms",
    sql(
        """SELECT doc_id,
             array_to_string(list_sort(list_filter(a_terms, lambda t: NOT list_contains(b_terms, t))), '|') AS a_only,
             array_to_string(list_sort(list_filter(b_terms, lambda t: NOT list_contains(a_terms, t))), '|') AS b_only
           FROM pairs""",
        *PAIR_VIEWS,
        pairs=PAIRS,
    ),
)
def set_only_terms(spark: SparkSession, d: str) -> DataFrame:
    return agreement.only_terms(two_taggers(spark, d)).select(
        "doc_id", joined("a_only").alias("a_only"), joined("b_only").alias("b_only")
    )


STRATA = """SELECT doc_id, for_first_level_name FROM (
    SELECT *, row_number() OVER (PARTITION BY for_first_level_name ORDER BY md5('42:' || doc_id), doc_id) AS rn
    FROM grants) WHERE rn <= 10"""


@query("sample_stratified", sql(STRATA, "grants"))
def sample_stratified(spark: SparkSession, d: str) -> DataFrame:
    grants = views.grants(spark, d).select("doc_id", "for_first_level_name")
    return sampling.sample_stratified(grants, "for_first_level_name", "doc_id", 10)


@query(
    "sample_stratified_fill",
    sql(
        """SELECT doc_id, for_first_level_name, lang, CAST(draw AS INTEGER) AS draw FROM (
             SELECT doc_id, for_first_level_name, lang, rn AS draw FROM ranked WHERE n >= 10 AND rn <= 10
             UNION ALL
             SELECT r.doc_id, r.for_first_level_name, r.lang, draw
             FROM ranked r, range(1, 11) AS t(draw)
             WHERE n < 10 AND rn = 1 + ('0x' || substr(md5('42:' || for_first_level_name || ':' || lang
                                        || ':' || draw), 1, 8))::BIGINT % n)""",
        "grants",
        ranked="""SELECT *, count(*) OVER (PARTITION BY for_first_level_name, lang) AS n,
                  row_number() OVER (PARTITION BY for_first_level_name, lang
                                     ORDER BY md5('42:' || doc_id), doc_id) AS rn FROM grants""",
    ),
)
def sample_stratified_fill(spark: SparkSession, d: str) -> DataFrame:
    grants = views.grants(spark, d).select("doc_id", "for_first_level_name", "lang")
    return sampling.sample_stratified_fill(grants, ["for_first_level_name", "lang"], "doc_id", 10)


@query(
    "union_portfolio",
    sql(
        f"""SELECT doc_id, abstract, for_first_level_name, 0 AS active_portfolio
            FROM grants WHERE doc_id IN (SELECT doc_id FROM ({STRATA}))
            UNION ALL
            SELECT doc_id, text, NULL, 1 FROM (
              SELECT conv_id * 1000 + turn AS doc_id, text FROM conversations ORDER BY 1 LIMIT 50)""",
        "grants",
    ),
)
def union_portfolio(spark: SparkSession, d: str) -> DataFrame:
    """Sampled documents and the first fifty conversation turns as active grants."""
    grants = views.grants(spark, d).select("doc_id", "abstract", "for_first_level_name")
    sample = sampling.sample_stratified(grants, "for_first_level_name", "doc_id", 10)
    active = views.table(spark, d, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"), F.col("text").alias("Synopsis")
    )
    return taxonomy.union_portfolio(sample, active, 50, "doc_id")


def hash_split(size: str, name: str = "test", rest: str = "train") -> str:
    return f"""SELECT pmid, year, CASE WHEN rn <= {size} THEN '{name}' ELSE '{rest}' END AS split
        FROM (SELECT pmid, year, row_number() OVER (ORDER BY md5('42:' || pmid)) AS rn,
                     count(*) OVER () AS n FROM articles)"""


def keyed(spark: SparkSession, d: str) -> DataFrame:
    """(pmid, year) of all articles, from the orders alone."""
    return views.table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("pmid"), F.year("o_orderdate").cast("string").alias("year")
    )


@query("split_random", sql(hash_split("ceil(CAST(0.05 AS DOUBLE) * n)"), "articles"))
def split_random(spark: SparkSession, d: str) -> DataFrame:
    return sampling.split_random(keyed(spark, d), "pmid", 0.05)


@query("split_train_test", sql(hash_split("ceil(CAST(0.25 AS DOUBLE) * n)"), "articles"))
def split_train_test(spark: SparkSession, d: str) -> DataFrame:
    return sampling.split_train_test(keyed(spark, d), "pmid")


@query("split_val_test", sql(hash_split("floor(CAST(0.8 AS DOUBLE) * n)", "val", "test"), "articles"))
def split_val_test(spark: SparkSession, d: str) -> DataFrame:
    return sampling.split_val_test(keyed(spark, d), "pmid", 0.8)


@query(
    "split_years",
    sql(
        """SELECT pmid, year, 'train' AS split FROM articles WHERE year IN ('1995', '1996', '1997')
           UNION ALL
           SELECT pmid, year, 'test' FROM (
             SELECT pmid, year, row_number() OVER (ORDER BY md5('42:' || pmid)) AS rn, count(*) OVER () AS n
             FROM articles WHERE year IN ('1998', '1999')) WHERE rn <= ceil(CAST(0.3 AS DOUBLE) * n)""",
        "articles",
    ),
)
def split_years(spark: SparkSession, d: str) -> DataFrame:
    return sampling.split_years(keyed(spark, d), [1995, 1996, 1997], [1998, 1999], "pmid", 0.3)


ROWS = """SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS idx FROM orders"""


@query(
    "split_buffered",
    sql(
        """SELECT o_orderkey, idx, CASE WHEN rn > n - floor(CAST(0.1 AS DOUBLE) * n) THEN 'test' ELSE 'train' END AS split
           FROM (SELECT *, row_number() OVER (PARTITION BY idx // 10000 ORDER BY md5('42:' || idx)) AS rn,
                        count(*) OVER (PARTITION BY idx // 10000) AS n FROM numbered)""",
        numbered=ROWS,
    ),
)
def split_buffered(spark: SparkSession, d: str) -> DataFrame:
    rows = add_row_index(views.table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"])
    return sampling.split_buffered(rows, "idx", 0.1)


@query(
    "shard_contiguous",
    sql(
        "SELECT o_orderkey, idx, CAST(ntile(100) OVER (ORDER BY idx) - 1 AS INTEGER) AS shard FROM numbered",
        numbered=ROWS,
    ),
)
def shard_contiguous(spark: SparkSession, d: str) -> DataFrame:
    rows = views.table(spark, d, "orders").select("o_orderkey")
    return sampling.shard_contiguous(rows, ["o_orderkey"], 100)


@query(
    "add_row_index",
    sql(
        """SELECT pmid, row_number() OVER (ORDER BY CAST(pmid AS BIGINT)) - 1 AS idx
           FROM articles WHERE list_has_any("meshMajor", ['Brand#3', 'Brand#17'])""",
        "articles",
    ),
)
def add_row_index_query(spark: SparkSession, d: str) -> DataFrame:
    """Positions among the rows that carry a wanted tag."""
    kept = filter_tags_any(views.articles(spark, d), ["Brand#3", "Brand#17"]).select("pmid")
    return add_row_index(kept, [F.col("pmid").cast("long")])


@query(
    "topk_labels",
    sql(
        """SELECT doc_id, label, score, CAST(rn AS INTEGER) AS rn FROM (
             SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) AS rn
             FROM scores_a) WHERE rn <= 3""",
        "scores_a",
    ),
)
def topk_labels_query(spark: SparkSession, d: str) -> DataFrame:
    return topk_labels(views.scores_a(spark, d), 3)
