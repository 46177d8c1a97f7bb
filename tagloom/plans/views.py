"""The article, score and taxonomy tables, derived from the given star schema.

Each view exists twice, as DataFrame and as SQL text with the same meaning.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.operators.joins import bucket_count

# Line items one task groups by document: tables of up to four times as many are left to the plan.
ROWS_IN_ONE_TASK = 500_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def lines(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    return table(spark, d, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))


def by_document(spark: SparkSession, d: str, rows: DataFrame) -> DataFrame:
    """``rows`` of line items, spread by document, and label if they have one, before they are grouped. Nearly each has a
    pair of its own, so a task that groups what it has read holds a whole split, or joined partition, and gains nothing."""
    n = table(spark, d, "lineitem").count()
    if n <= 4 * ROWS_IN_ONE_TASK:
        return rows
    keys = [c for c in ("doc_id", "label") if c in rows.columns]
    return rows.repartition(max(-(-n // ROWS_IN_ONE_TASK), bucket_count(spark)), *keys)


def articles(spark: SparkSession, d: str) -> DataFrame:
    """One article per order; orders without lines have no text and no tags."""
    bundles = lines(spark, d).groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list("p_brand")).alias("tags"),
        F.array_join(F.array_sort(F.collect_list("p_name")), " ").alias("body"),
        F.min("p_name").alias("head"),
    )
    orders = table(spark, d, "orders")
    joined = orders.join(bundles, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.select(
        F.col("o_orderkey").cast("string").alias("pmid"),
        F.col("o_orderpriority").alias("journal"),
        F.year("o_orderdate").cast("string").alias("year"),
        F.coalesce("tags", F.array().cast("array<string>")).alias("meshMajor"),
        F.col("body").alias("abstractText"),
        F.col("head").alias("title"),
    )


def article_labels(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, label, year): distinct tags of each article."""
    return lines(spark, d).select(F.col("l_orderkey").alias("doc_id"), F.col("p_brand").alias("label")).distinct()


def publications(spark: SparkSession, d: str) -> DataFrame:
    heading = F.concat(
        "p_brand", F.lit("/"), "p_type", F.when(F.col("l_returnflag") == "R", "*").otherwise("")
    )
    category = F.struct(
        F.col("p_type").alias("id"),
        F.when(F.col("l_returnflag") == "N", "for")
        .when(F.col("l_returnflag") == "R", "hrcs_rac")
        .otherwise("sdg")
        .alias("category_type"),
    )
    bundles = lines(spark, d).groupBy("l_orderkey").agg(
        F.min("p_name").alias("title"),
        F.array_join(F.array_sort(F.collect_list("p_name")), " ").alias("abstract"),
        F.array_sort(F.collect_list(heading)).alias("mesh_terms"),
        F.array_sort(F.collect_list(category)).alias("categories"),
    )
    orders = table(spark, d, "orders").select("o_orderkey")
    return orders.join(bundles, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").alias("pub_id"),
        "title",
        "abstract",
        F.coalesce("mesh_terms", F.array().cast("array<string>")).alias("mesh_terms"),
        "categories",
    )


def categories(spark: SparkSession, d: str) -> DataFrame:
    """Category names; the type STANDARD has none."""
    types = table(spark, d, "part").select("p_type").distinct().filter("p_type <> 'STANDARD'")
    return types.select(
        F.col("p_type").alias("category_id"), F.concat(F.lit("about "), F.lower("p_type")).alias("name")
    )


def docs(spark: SparkSession, d: str) -> DataFrame:
    return by_document(spark, d, table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"))).distinct()


def truth(spark: SparkSession, d: str) -> DataFrame:
    own = lines(spark, d).filter("l_linestatus = 'F'")
    return by_document(spark, d, own.select(F.col("l_orderkey").alias("doc_id"), F.col("p_brand").alias("label"))).distinct()


def scores_a(spark: SparkSession, d: str) -> DataFrame:
    own = lines(spark, d).select(F.col("l_orderkey").alias("doc_id"), F.col("p_brand").alias("label"), "l_quantity")
    return by_document(spark, d, own).groupBy("doc_id", "label").agg((F.max("l_quantity") / F.lit(50.0)).alias("score"))


def scores_b(spark: SparkSession, d: str) -> DataFrame:
    own = lines(spark, d).select(F.col("l_orderkey").alias("doc_id"), F.col("p_brand").alias("label"), "l_discount")
    return by_document(spark, d, own).groupBy("doc_id", "label").agg(F.round(F.max("l_discount") * 10, 6).alias("score"))


def scores_c(spark: SparkSession, d: str) -> DataFrame:
    """Scores that favour the true labels, so that thresholds are worth tuning."""
    weight = F.when(F.col("l_linestatus") == "F", 1.0).otherwise(0.25)
    own = lines(spark, d).select(F.col("l_orderkey").alias("doc_id"), F.col("p_brand").alias("label"), (F.col("l_quantity") * weight).alias("own"))
    return by_document(spark, d, own).groupBy("doc_id", "label").agg((F.max("own") / F.lit(50.0)).alias("score"))


def vocabulary(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(F.col("p_brand").alias("label")).distinct()


def taxonomy(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("p_partkey")
    branch = F.element_at(
        F.array(*[F.lit(b) for b in ("A", "C", "F", "G")]), (key % 4 + 1).cast("int")
    )
    node = F.concat(branch, F.lpad((F.col("p_size") % 30).cast("string"), 2, "0"))
    leaf = F.lpad((key % 1000).cast("string"), 3, "0")
    tree = F.when(key % 10 == 0, node).otherwise(F.concat(node, F.lit("."), leaf))
    return table(spark, d, "part").select(
        F.concat(F.lit("D"), key.cast("string")).alias("ui"),
        F.concat_ws(" ", "p_name", key.cast("string")).alias("name"),
        F.when(F.col("p_size") % 10 == 0, F.lit("note: Do not use")).alias("annotation"),
        tree.alias("tree_number"),
        F.array(tree).alias("tree_numbers"),
    )


def grants(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(
        "doc_id",
        F.concat(F.col("lang"), F.lit(" "), F.col("doc_id").cast("string")).alias("title"),
        F.col("text").alias("abstract"),
        F.col("source").alias("for_first_level_name"),
        "lang",
    )


def texts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "text")


def text_labels(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, label): language and source of each document, and its quality marks."""
    documents = table(spark, d, "documents")
    marks = table(spark, d, "labels")
    tags = documents.select("doc_id", F.explode(F.array("lang", "source")).alias("label"))
    good = marks.filter("quality = 1").select("doc_id", F.lit("quality").alias("label"))
    toxic = marks.filter("toxic = 1").select("doc_id", F.lit("toxic").alias("label"))
    return tags.unionByName(good).unionByName(toxic)


SQL = {
    "lines": "SELECT * FROM lineitem JOIN part ON l_partkey = p_partkey",
    "articles": """
        SELECT CAST(o_orderkey AS VARCHAR) AS pmid, o_orderpriority AS journal,
               CAST(year(o_orderdate) AS VARCHAR) AS year,
               coalesce(tags, CAST([] AS VARCHAR[])) AS "meshMajor",
               body AS "abstractText", head AS title
        FROM orders LEFT JOIN (
            SELECT l_orderkey, list_sort(list(p_brand)) AS tags,
                   string_agg(p_name, ' ' ORDER BY p_name) AS body, min(p_name) AS head
            FROM lines GROUP BY l_orderkey) ON o_orderkey = l_orderkey""",
    "article_labels": "SELECT DISTINCT l_orderkey AS doc_id, p_brand AS label FROM lines",
    "headings": """
        SELECT l_orderkey, p_name, p_type,
               p_brand || '/' || p_type || CASE WHEN l_returnflag = 'R' THEN '*' ELSE '' END AS heading,
               CASE l_returnflag WHEN 'N' THEN 'for' WHEN 'R' THEN 'hrcs_rac' ELSE 'sdg' END AS kind
        FROM lines""",
    "publications": """
        SELECT o_orderkey AS pub_id, title, abstract,
               coalesce(mesh_terms, CAST([] AS VARCHAR[])) AS mesh_terms
        FROM orders LEFT JOIN (
            SELECT l_orderkey, min(p_name) AS title,
                   string_agg(p_name, ' ' ORDER BY p_name) AS abstract,
                   list_sort(list(heading)) AS mesh_terms
            FROM headings GROUP BY l_orderkey) ON o_orderkey = l_orderkey""",
    "categories": """
        SELECT DISTINCT p_type AS category_id, 'about ' || lower(p_type) AS name
        FROM part WHERE p_type <> 'STANDARD'""",
    "docs": "SELECT DISTINCT l_orderkey AS doc_id FROM lineitem",
    "truth": """
        SELECT DISTINCT l_orderkey AS doc_id, p_brand AS label FROM lines WHERE l_linestatus = 'F'""",
    "scores_a": """
        SELECT l_orderkey AS doc_id, p_brand AS label, max(l_quantity) / 50.0 AS score
        FROM lines GROUP BY 1, 2""",
    "scores_b": """
        SELECT l_orderkey AS doc_id, p_brand AS label, round(max(l_discount) * 10, 6) AS score
        FROM lines GROUP BY 1, 2""",
    "scores_c": """
        SELECT l_orderkey AS doc_id, p_brand AS label,
               max(l_quantity * CASE WHEN l_linestatus = 'F' THEN 1.0 ELSE 0.25 END) / 50.0 AS score
        FROM lines GROUP BY 1, 2""",
    "vocabulary": "SELECT DISTINCT p_brand AS label FROM part",
    "taxonomy": """
        SELECT ui, name, annotation,
               CASE WHEN p_partkey % 10 = 0 THEN node ELSE node || '.' || leaf END AS tree_number
        FROM (SELECT p_partkey, 'D' || p_partkey AS ui, p_name || ' ' || p_partkey AS name,
                     CASE WHEN p_size % 10 = 0 THEN 'note: Do not use' END AS annotation,
                     ['A', 'C', 'F', 'G'][1 + p_partkey % 4]
                         || lpad(CAST(p_size % 30 AS VARCHAR), 2, '0') AS node,
                     lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') AS leaf
              FROM part)""",
    "grants": """
        SELECT doc_id, lang || ' ' || doc_id AS title, text AS abstract,
               source AS for_first_level_name, lang FROM documents""",
    "texts": "SELECT doc_id, text FROM documents",
    "text_labels": """
        SELECT doc_id, unnest([lang, source]) AS label FROM documents
        UNION ALL SELECT doc_id, 'quality' FROM labels WHERE quality = 1
        UNION ALL SELECT doc_id, 'toxic' FROM labels WHERE toxic = 1""",
}

NEEDS = {
    "articles": ["lines"],
    "article_labels": ["lines"],
    "headings": ["lines"],
    "publications": ["headings"],
    "truth": ["lines"],
    "scores_a": ["lines"],
    "scores_b": ["lines"],
    "scores_c": ["lines"],
}


def sql(body: str, *views: str, **more: str) -> str:
    """``body`` under a WITH clause of the named views, what they need, and ``more``, which are steps
    that build on each other and so are worked out once."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in order:
            order.append(name)

    for name in views:
        add(name)
    parts = [f"{n} AS ({SQL[n].strip()})" for n in order]
    parts += [f"{n} AS MATERIALIZED ({text.strip()})" for n, text in more.items()]
    return (f"WITH {', '.join(parts)} " if parts else "") + body.strip()
