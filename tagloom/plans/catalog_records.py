"""Registered queries: sources, sinks, filters, projections and text functions.

A source query first lets Spark write the derived records in the format that is
read, then reads them back through the source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom import schemas
from tagloom.functions import text as fn
from tagloom.operators import filters as flt
from tagloom.operators.ordering import head_lines
from tagloom.operators.sampling import split_hash_share
from tagloom.operators.labels import build_vocabulary, tag_counts
from tagloom.plans import views
from tagloom.plans.registry import query
from tagloom.plans.views import sql
from tagloom.session import scratch_path
from tagloom.sources import monthly, records, sinks

YEARS = ("1996", "1998")
IN_ARRAYS = 5_000  # publications below this id are in files of one array each
TAGS = ("Brand#3", "Brand#17")


def joined(column: str) -> F.Column:
    return F.concat_ws("|", column)


def flat_articles(df: DataFrame) -> DataFrame:
    return df.select("pmid", "journal", "year", "title", "abstractText", joined("meshMajor").alias("tags"))


FLAT = """SELECT pmid, journal, year, title, "abstractText", array_to_string("meshMajor", '|') AS tags
          FROM articles"""


@query(
    "src_articles_jsonl",
    sql(
        """SELECT pmid, journal, year, 'é ' || title AS title, "abstractText",
                  array_to_string("meshMajor", '|') AS tags
           FROM articles WHERE "abstractText" IS NOT NULL
           UNION ALL SELECT NULL, NULL, NULL, NULL, '{"pmid":"' || pmid || 'é","year":,', NULL
           FROM articles WHERE "abstractText" IS NULL""",
        "articles",
    ),
)
def src_articles_jsonl(spark: SparkSession, d: str) -> DataFrame:
    """Articles without text are written as broken lines and must end in quarantine."""
    path = scratch_path(spark, "articles.jsonl")
    articles = views.articles(spark, d).withColumn("title", F.concat(F.lit("é "), "title"))
    whole = F.to_json(F.struct("journal", "meshMajor", "year", "abstractText", "title", "pmid"))
    broken = F.concat(F.lit('{"pmid":"'), "pmid", F.lit('é","year":,'))
    articles.select(
        F.when(F.col("abstractText").isNull(), broken).otherwise(whole).alias("value")
    ).write.text(path)
    good, bad = records.read_articles(spark, path)
    return flat_articles(good).unionByName(
        bad.select(F.col("line").alias("abstractText")), allowMissingColumns=True
    )


@query(
    "src_articles_wrapped",
    sql(
        """SELECT pmid, year, array_to_string("meshMajor", '|') AS tags FROM articles
           WHERE "abstractText" IS NOT NULL
           UNION ALL SELECT NULL, NULL, '{"pmid":"' || pmid || '","year":,' FROM articles
           WHERE "abstractText" IS NULL""",
        "articles",
    ),
)
def src_articles_wrapped(spark: SparkSession, d: str) -> DataFrame:
    """Articles without text are written as broken lines and must end in quarantine."""
    path = scratch_path(spark, "wrapped")
    whole = F.concat(F.to_json(F.struct("journal", "meshMajor", "year", "abstractText", "title", "pmid")), F.lit(","))
    broken = F.concat(F.lit('{"pmid":"'), "pmid", F.lit('","year":,'))
    lines = views.articles(spark, d).select(
        F.when(F.col("abstractText").isNull(), broken).otherwise(whole).alias("value")
    )
    lines.write.text(path)
    spark.createDataFrame([('{"articles":[',)], "value STRING").write.mode("append").text(path)
    good, bad = records.read_articles_wrapped(spark, path)
    none = F.lit(None).cast("string")
    return good.select("pmid", "year", joined("meshMajor").alias("tags")).unionByName(
        bad.select(none.alias("pmid"), none.alias("year"), F.col("line").alias("tags"))
    )


def write_tagged_text(spark: SparkSession, d: str) -> str:
    """Tagged text as JSON lines; articles without text are broken lines."""
    path = scratch_path(spark, "tagged.jsonl")
    record = F.struct(
        F.col("abstractText").alias("text"),
        F.col("meshMajor").alias("tags"),
        F.struct("journal", "year").alias("meta"),
    )
    broken = F.concat(F.lit('{"text":'), "pmid", F.lit(" é"))
    views.articles(spark, d).select(
        F.when(F.col("abstractText").isNull(), broken).otherwise(F.to_json(record)).alias("value")
    ).write.text(path)
    return path


@query(
    "src_tagged_text",
    sql(
        """SELECT journal, year, "abstractText" AS text, array_to_string("meshMajor", '|') AS tags
           FROM articles WHERE "abstractText" IS NOT NULL
           UNION ALL SELECT NULL, NULL, '{"text":' || pmid || ' é', NULL
           FROM articles WHERE "abstractText" IS NULL""",
        "articles",
    ),
)
def src_tagged_text(spark: SparkSession, d: str) -> DataFrame:
    rows, bad = records.read_tagged_text(spark, write_tagged_text(spark, d))
    meta = [F.col("meta").getItem(k).alias(k) for k in ("journal", "year")]
    return rows.select(*meta, "text", joined("tags").alias("tags")).unionByName(
        bad.select(F.col("line").alias("text")), allowMissingColumns=True
    )


@query(
    "src_column_stream",
    sql(
        """SELECT array_to_string(list_transform(range(1, 26),
               lambda i: CAST(list_contains("meshMajor", 'Brand#' || i) AS INTEGER)), '') AS hot
           FROM articles WHERE "abstractText" IS NOT NULL""",
        "articles",
    ),
)
def src_column_stream(spark: SparkSession, d: str) -> DataFrame:
    """Only the tags, as 0/1 vectors; shown in the order of the brand numbers."""
    rows, _ = records.read_tagged_text(spark, write_tagged_text(spark, d))
    number = F.expr("CAST(substring(label, 7) AS INT) - 1")
    brands = views.vocabulary(spark, d).select(number.alias("label_id"), "label")
    hot = records.tags(rows, brands)
    return hot.select(F.concat_ws("", F.col("tags").cast("array<string>")).alias("hot"))


@query(
    "src_publications",
    sql(
        f"""SELECT title, abstract, array_to_string(mesh_terms, '|') AS mesh_terms
           FROM publications WHERE title IS NOT NULL OR pub_id < {IN_ARRAYS}
           UNION ALL SELECT '{{"title":' || pub_id || ' é', NULL, NULL
           FROM publications WHERE title IS NULL AND pub_id >= {IN_ARRAYS}
           UNION ALL SELECT '[{{"title":"é"' || chr(10), NULL, NULL""",
        "publications",
    ),
)
def src_publications(spark: SparkSession, d: str) -> DataFrame:
    """The first publications in files with one JSON array each, one of them broken, all others
    as JSON lines, those without a title broken."""
    arrays, lines = scratch_path(spark, "arrays"), scratch_path(spark, "lines")
    record = F.struct("title", "abstract", "mesh_terms", "categories")
    rows = views.publications(spark, d)
    rows.filter(F.col("pub_id") < IN_ARRAYS).groupBy(
        F.floor(F.col("pub_id") / 1000).alias("file")
    ).agg(F.to_json(F.collect_list(record)).alias("value")).write.partitionBy("file").text(arrays)
    spark.createDataFrame([('[{"title":"é"', -1)], "value STRING, file LONG").write.mode(
        "append"
    ).partitionBy("file").text(arrays)
    broken = F.concat(F.lit('{"title":'), F.col("pub_id").cast("string"), F.lit(" é"))
    rows.filter(F.col("pub_id") >= IN_ARRAYS).select(
        F.when(F.col("title").isNull(), broken).otherwise(F.to_json(record)).alias("value")
    ).write.text(lines)
    first, bad_files = records.read_publications(spark, arrays)
    rest, bad_lines = records.read_publications(spark, lines, "lines")
    read = first.select("title", "abstract", "mesh_terms").unionByName(rest.drop("categories"))
    bad = bad_files.unionByName(bad_lines).select(F.col("line").alias("title"))
    return read.select("title", "abstract", joined("mesh_terms").alias("mesh_terms")).unionByName(
        bad, allowMissingColumns=True
    )


SUBSET = records.subset_places(8, 42)[:3]


@query(
    "src_parquet_subset",
    sql(
        f"""SELECT title, abstract, for_first_level_name FROM grants
            WHERE doc_id % 8 IN ({', '.join(map(str, SUBSET))})""",
        "grants",
    ),
)
def src_parquet_subset(spark: SparkSession, d: str) -> DataFrame:
    """Three of eight files, which hold the documents by their id."""
    path = scratch_path(spark, "grants")
    rows = views.grants(spark, d).withColumn("file", F.col("doc_id") % 8)
    # By number, not by hash, which would deal several files to one task.
    rows.repartitionById(8, F.col("file").cast("int")).write.partitionBy("file").parquet(path)
    return records.read_parquet_subset(spark, path, 3, ["title", "abstract", "for_first_level_name"])


@query(
    "src_csv_texts",
    sql(
        """SELECT doc_id, nullif(text, '') AS text, lang FROM documents WHERE doc_id % 50 <> 7
           UNION ALL SELECT NULL, 'n/a' || doc_id, NULL FROM documents WHERE doc_id % 50 = 7"""
    ),
)
def src_csv_texts(spark: SparkSession, d: str) -> DataFrame:
    """Texts of many lines as CSV, some with an id that is no number: those end in quarantine."""
    path = scratch_path(spark, "texts")
    number = F.col("doc_id").cast("string")
    odd = F.when(F.col("doc_id") % 50 == 7, F.concat(F.lit("n/a"), number)).otherwise(number)
    sinks.write_report(views.table(spark, d, "documents").select(odd.alias("doc_id"), "text", "lang"), path, "csv")
    good, bad = records.read_csv(spark, path, "doc_id BIGINT, text STRING, lang STRING")
    first = F.regexp_extract("line", "^[^,]*", 0)
    return good.unionByName(bad.select(first.alias("text")), allowMissingColumns=True)


@query("src_csv_dims", sql("SELECT category_id, name FROM categories", "categories"))
def src_csv_dims(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "categories")
    sinks.write_report(views.categories(spark, d), path, "csv")
    return records.read_csv(spark, path, schemas.CATEGORY)[0]


XML_RECORDS = 200_000  # of a file, as one task reads it


@query("src_taxonomy_xml", sql("SELECT ui, name, annotation, tree_number FROM taxonomy", "taxonomy"))
def src_taxonomy_xml(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "descriptors")
    views.taxonomy(spark, d).select(
        F.col("ui").alias("DescriptorUI"),
        F.struct(F.col("name").alias("String")).alias("DescriptorName"),
        F.col("annotation").alias("Annotation"),
        F.struct(F.col("tree_numbers").alias("TreeNumber")).alias("TreeNumberList"),
    ).write.format("xml").option("rootTag", "DescriptorRecordSet").option(
        "rowTag", "DescriptorRecord"
    ).option("maxRecordsPerFile", XML_RECORDS).save(path)
    return records.read_taxonomy(spark, path).select("ui", "name", "annotation", "tree_number")


@query("src_term_list", "SELECT DISTINCT p_name AS label FROM part")
def src_term_list(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "terms")
    names = views.table(spark, d, "part").select("p_name").distinct()
    padded = names.select(F.concat(F.lit(" "), "p_name", F.lit(" \n")).alias("value"))
    padded.write.text(path)  # the extra line break leaves blank lines behind
    return records.read_terms(spark, path)


@query("sink_jsonl", sql(FLAT, "articles"))
def sink_jsonl(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "articles.jsonl")
    sinks.write_jsonl(views.articles(spark, d), path)
    return flat_articles(spark.read.schema(schemas.ARTICLE).json(path))


@query(
    "sink_json_array",
    sql(
        "SELECT title, abstract, array_to_string(mesh_terms, '|') AS mesh_terms FROM publications",
        "publications",
    ),
)
def sink_json_array(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "samples")
    sinks.write_sample(views.publications(spark, d).select("title", "abstract", "mesh_terms"), path)
    read = spark.read.schema("title STRING, abstract STRING, mesh_terms ARRAY<STRING>").json(path)
    return read.select("title", "abstract", joined("mesh_terms").alias("mesh_terms"))


SPLIT = """SELECT pmid, year, CASE WHEN ('0x' || substr(md5('42:' || pmid), 1, 8))::BIGINT < 858993459
           THEN 'test' ELSE 'train' END AS split FROM articles"""


def saved_dataset(spark: SparkSession, d: str) -> str:
    path = scratch_path(spark, "dataset")
    articles = views.articles(spark, d)
    sinks.write_dataset(split_hash_share(articles, "pmid", 0.2), build_vocabulary(articles), path)
    return path


@query("sink_dataset", sql(SPLIT, "articles"))
def sink_dataset(spark: SparkSession, d: str) -> DataFrame:
    rows, _ = sinks.read_dataset(spark, saved_dataset(spark, d), split=None)
    return rows.select("pmid", "year", F.col("split").cast("string").alias("split"))


@query("src_dataset", sql(f"SELECT pmid, year, split FROM ({SPLIT}) WHERE split = 'train'", "articles"))
def src_dataset(spark: SparkSession, d: str) -> DataFrame:
    rows, _ = sinks.read_dataset(spark, saved_dataset(spark, d))
    return rows.select("pmid", "year", F.col("split").cast("string").alias("split"))


@query(
    "sink_reports",
    sql(
        """SELECT 'counts' AS report, p_brand AS name, count(*) AS n, NULL AS tags FROM lines GROUP BY 2
           UNION ALL
           SELECT 'thresholds', p_brand, CAST(floor(1000 * (avg(p_size) / 50.0)) AS BIGINT), NULL
           FROM part GROUP BY 2
           UNION ALL
           SELECT 'tags', pmid, len("meshMajor"), CASE WHEN len("meshMajor") = 0 THEN '[]'
                  ELSE '["' || array_to_string("meshMajor", '","') || '"]' END FROM articles""",
        "lines", "articles",
    ),
)
def sink_reports(spark: SparkSession, d: str) -> DataFrame:
    """Counts, thresholds and rows with arrays, each written as CSV and read again."""
    counts, limits, nested = (scratch_path(spark, n) for n in ("counts", "limits", "nested"))
    articles = views.articles(spark, d)
    part = views.table(spark, d, "part")
    sinks.write_report(tag_counts(articles), counts, "csv")
    threshold = (F.avg("p_size") / F.lit(50.0)).alias("threshold")
    sinks.write_report(part.groupBy(F.col("p_brand").alias("label")).agg(threshold), limits, "csv")
    sinks.write_report(articles.select("pmid", "meshMajor"), nested, "csv")
    none = F.lit(None).cast("string").alias("tags")
    tags = F.from_json("meshMajor", "array<string>")
    return (
        records.read_csv(spark, counts, "label STRING, n BIGINT")[0]
        .select(F.lit("counts").alias("report"), F.col("label").alias("name"), "n", none)
        .unionByName(
            records.read_csv(spark, limits, "label STRING, threshold DOUBLE")[0].select(
                F.lit("thresholds").alias("report"),
                F.col("label").alias("name"),
                F.floor(F.col("threshold") * 1000).alias("n"),
                none,
            )
        )
        .unionByName(
            records.read_csv(spark, nested, "pmid STRING, meshMajor STRING")[0].select(
                F.lit("tags").alias("report"),
                F.col("pmid").alias("name"),
                F.size(tags).cast("long").alias("n"),
                F.col("meshMajor").alias("tags"),
            )
        )
    )


@query(
    "ingest_monthly",
    """SELECT CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month,
              count(*) AS n, min(o_orderkey) AS first_key
       FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 50 <> 0 THEN o_orderdate END AS day FROM orders)
       GROUP BY 1, 2""",
)
def ingest_monthly(spark: SparkSession, d: str) -> DataFrame:
    """A first run takes one year, a second run the other years; some orders have no date."""
    path = scratch_path(spark, "monthly")
    day = F.when(F.col("o_orderkey") % 50 != 0, F.col("o_orderdate"))
    orders = views.table(spark, d, "orders").select("o_orderkey", day.alias("day"))
    monthly.ingest_monthly(orders, "day", path, year=1997)
    monthly.ingest_monthly(orders, "day", path)
    none = F.lit(None).cast("int")
    undated = monthly.read_undated(spark, path).select("o_orderkey", none.alias("year"), none.alias("month"))
    months = monthly.read_months(spark, path).select("o_orderkey", "year", "month")
    return months.unionByName(undated).groupBy("year", "month").agg(
        F.count("*").alias("n"), F.min("o_orderkey").alias("first_key")
    )


@query(
    "limit_head",
    sql(
        """SELECT CAST(o_orderkey AS VARCHAR) AS pmid, CAST(year(o_orderdate) AS VARCHAR) AS year
           FROM orders ORDER BY o_orderkey LIMIT 500"""
    ),
)
def limit_head(spark: SparkSession, d: str) -> DataFrame:
    """The first 500 lines of a file set written in key order."""
    path = scratch_path(spark, "lines")
    orders = views.table(spark, d, "orders")
    record = F.struct(F.col("o_orderkey").cast("string").alias("pmid"), F.year("o_orderdate").cast("string").alias("year"))
    orders.orderBy("o_orderkey").select(F.to_json(record).alias("value")).write.text(path)
    head = head_lines(spark.read.text(path), 500)
    return head.select(F.from_json("value", "pmid STRING, year STRING").alias("r")).select("r.*")


@query("filter_years", sql(f"SELECT * FROM ({FLAT}) WHERE year IN {YEARS}", "articles"))
def filter_years(spark: SparkSession, d: str) -> DataFrame:
    return flat_articles(flt.filter_years(views.articles(spark, d), YEARS))


ANY = f"""list_has_any("meshMajor", {list(TAGS)})"""


@query("filter_tags_any", sql(f"{FLAT} WHERE {ANY}", "articles"))
def filter_tags_any(spark: SparkSession, d: str) -> DataFrame:
    return flat_articles(flt.filter_tags_any(views.articles(spark, d), TAGS))


@query("filter_article", sql(f"{FLAT} WHERE {ANY} AND year IN {YEARS}", "articles"))
def filter_article(spark: SparkSession, d: str) -> DataFrame:
    return flat_articles(flt.filter_article(views.articles(spark, d), TAGS, YEARS))


@query("filter_has_text", sql(f'{FLAT} WHERE "abstractText" IS NOT NULL', "articles"))
def filter_has_text(spark: SparkSession, d: str) -> DataFrame:
    return flat_articles(flt.filter_has_text(views.articles(spark, d), "abstractText"))


@query(
    "filter_has_tags",
    sql(
        """SELECT pub_id, array_to_string(mesh_terms, '|') AS mesh_terms FROM publications
           WHERE len(mesh_terms) > 0""",
        "publications",
    ),
)
def filter_has_tags(spark: SparkSession, d: str) -> DataFrame:
    kept = flt.filter_has_tags(views.publications(spark, d))
    return kept.select("pub_id", joined("mesh_terms").alias("mesh_terms"))


@query(
    "filter_category_type",
    sql(
        """SELECT l_orderkey AS pub_id, p_type AS category_id, kind AS category_type
           FROM headings WHERE kind IN ('for', 'hrcs_rac')""",
        "headings",
    ),
)
def filter_category_type(spark: SparkSession, d: str) -> DataFrame:
    kept = flt.filter_category_type(views.publications(spark, d), ["for", "hrcs_rac"])
    return kept.select(
        "pub_id", F.col("category.id").alias("category_id"), F.col("category.category_type")
    )


@query(
    "filter_tree_branch",
    sql(
        """SELECT ui, name, tree_number FROM taxonomy
           WHERE (starts_with(tree_number, 'C') AND NOT starts_with(tree_number, 'C22'))
              OR starts_with(tree_number, 'F03')""",
        "taxonomy",
    ),
)
def filter_tree_branch(spark: SparkSession, d: str) -> DataFrame:
    return flt.filter_tree_branch(views.taxonomy(spark, d)).select("ui", "name", "tree_number")


@query(
    "filter_annotation",
    sql(
        "SELECT ui, name FROM taxonomy WHERE NOT contains(coalesce(annotation, ''), ': Do not use')",
        "taxonomy",
    ),
)
def filter_annotation(spark: SparkSession, d: str) -> DataFrame:
    return flt.filter_annotation(views.taxonomy(spark, d)).select("ui", "name")


@query(
    "filter_pred_in_terms",
    sql(
        """SELECT pmid, array_to_string("meshMajor", '|') AS tags FROM articles
           WHERE list_has_any("meshMajor", (SELECT list(DISTINCT p_brand) FROM part WHERE p_size = 7))""",
        "articles",
    ),
)
def filter_pred_in_terms(spark: SparkSession, d: str) -> DataFrame:
    terms = views.table(spark, d, "part").filter("p_size = 7").select(F.col("p_brand").alias("name"))
    kept = flt.filter_pred_in_terms(views.articles(spark, d), terms, field="meshMajor")
    return kept.select("pmid", joined("meshMajor").alias("tags"))


@query(
    "project_drop",
    sql(
        """SELECT year, "abstractText", array_to_string("meshMajor", '|') AS tags FROM articles""",
        "articles",
    ),
)
def project_drop(spark: SparkSession, d: str) -> DataFrame:
    rest = flt.project_drop(views.articles(spark, d))
    return rest.withColumn("tags", joined("meshMajor")).drop("meshMajor")


@query(
    "project_tagged_text",
    sql(
        """SELECT pub_id, abstract AS text, title AS meta_title,
                  array_to_string(list_transform(mesh_terms, lambda t: regexp_replace(split_part(t, '/', 1), '\\*$', '')), '|') AS tags
           FROM publications WHERE len(mesh_terms) > 0""",
        "publications",
    ),
)
def project_tagged_text(spark: SparkSession, d: str) -> DataFrame:
    rows = flt.project_tagged_text(views.publications(spark, d))
    return rows.select(
        "pub_id", "text", F.col("meta").getItem("title").alias("meta_title"), joined("tags").alias("tags")
    )


@query(
    "project_annotation_record",
    sql(
        """SELECT abstract AS text, lang || ':1.0|' || for_first_level_name || ':1.0' AS prediction,
                  'tagger' AS prediction_agent, for_first_level_name AS stratum, true AS multi_label
           FROM grants""",
        "grants",
    ),
)
def project_annotation_record(spark: SparkSession, d: str) -> DataFrame:
    grants = views.grants(spark, d).withColumn("mesh_terms", F.array("lang", "for_first_level_name"))
    rows = flt.project_annotation_record(grants, "tagger")
    shown = F.transform("prediction", lambda p: F.concat(p.label, F.lit(":"), p.score.cast("string")))
    return rows.select(
        "text",
        F.concat_ws("|", shown).alias("prediction"),
        "prediction_agent",
        F.col("metadata.for_first_level_name").alias("stratum"),
        "multi_label",
    )


@query(
    "fn_normalise_heading",
    sql(
        """SELECT heading, regexp_replace(split_part(heading, '/', 1), '\\*$', '') AS main, count(*) AS n
           FROM (SELECT heading FROM headings UNION ALL SELECT p_type || '**' FROM headings) GROUP BY 1""",
        "headings",
    ),
)
def fn_normalise_heading(spark: SparkSession, d: str) -> DataFrame:
    terms = views.publications(spark, d).select(F.explode("mesh_terms").alias("heading"))
    starred = views.lines(spark, d).select(F.concat("p_type", F.lit("**")).alias("heading"))
    counted = terms.unionByName(starred).groupBy("heading").agg(F.count("*").alias("n"))
    return counted.select("heading", fn.normalise_heading("heading").alias("main"), "n")


@query(
    "fn_parse_list",
    """SELECT o_orderkey, array_to_string(list_filter(
           string_split(o_orderstatus || ', ' || o_orderpriority || ', ,,' || o_custkey, ','),
           lambda x: trim(x) <> ''), '|') AS items
       FROM orders""",
)
def fn_parse_list(spark: SparkSession, d: str) -> DataFrame:
    listed = F.concat(
        "o_orderstatus", F.lit(", "), "o_orderpriority", F.lit(", ,,"), F.col("o_custkey").cast("string")
    )
    return views.table(spark, d, "orders").select(
        "o_orderkey", F.concat_ws("|", fn.parse_list(listed)).alias("items")
    )


@query(
    "fn_strip_quotes",
    """SELECT conv_id, turn, replace(replace(text, '''', ''), '"', '') AS text FROM conversations""",
)
def fn_strip_quotes(spark: SparkSession, d: str) -> DataFrame:
    return views.table(spark, d, "conversations").select(
        "conv_id", "turn", fn.strip_quotes("text").alias("text")
    )


@query(
    "fn_strip_breaks",
    "SELECT doc_id, replace(replace(text, chr(10), ' '), chr(9), ' ') AS text FROM documents",
)
def fn_strip_breaks(spark: SparkSession, d: str) -> DataFrame:
    return views.table(spark, d, "documents").select("doc_id", fn.strip_breaks("text").alias("text"))


@query(
    "fn_render_prompt",
    """SELECT doc_id, replace(replace('About {TOPIC}: {ABSTRACT} ({TOPIC})', '{TOPIC}', source),
                              '{ABSTRACT}', text) AS prompt
       FROM documents""",
)
def fn_render_prompt(spark: SparkSession, d: str) -> DataFrame:
    template = "About {TOPIC}: {ABSTRACT} ({TOPIC})"
    return views.table(spark, d, "documents").select(
        "doc_id", fn.render_prompt(template, "source", "text").alias("prompt")
    )


@query(
    "fn_parse_generated",
    """SELECT doc_id, CASE WHEN n_chars < 500 OR lang <> 'en' THEN text END AS abstract,
              CASE WHEN n_chars < 500 OR lang <> 'en' THEN source END AS title
       FROM documents""",
)
def fn_parse_generated(spark: SparkSession, d: str) -> DataFrame:
    """Long English texts are answered without a title and must not parse."""
    both = F.to_json(F.struct(F.col("text").alias("abstract"), F.col("source").alias("title")))
    half = F.to_json(F.struct(F.col("text").alias("abstract")))
    usable = (F.col("n_chars") < 500) | (F.col("lang") != "en")
    answer = F.concat(F.lit(" \n"), F.when(usable, both).otherwise(half), F.lit("\n"))
    parsed = views.table(spark, d, "documents").select("doc_id", fn.parse_generated(answer).alias("p"))
    return parsed.select("doc_id", "p.abstract", "p.title")


@query(
    "fn_parse_term_list",
    """SELECT l_orderkey, array_to_string(list_sort(list(p_name || '''s')), '|') AS terms
       FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
)
def fn_parse_term_list(spark: SparkSession, d: str) -> DataFrame:
    """Lists printed with double quotes, as their items hold a single one."""
    term = F.concat(F.lit('"'), "p_name", F.lit("'s\""))
    printed = views.lines(spark, d).groupBy("l_orderkey").agg(
        F.concat(
            F.lit("["), F.array_join(F.array_sort(F.collect_list(term)), ", "), F.lit("]")
        ).alias("printed")
    )
    return printed.select("l_orderkey", F.concat_ws("|", fn.parse_term_list("printed")).alias("terms"))


