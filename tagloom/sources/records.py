"""Readers. Every schema is given, none is inferred."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom import schemas
from tagloom.functions.columns import as_column
from tagloom.operators.filters import filter_article
from tagloom.operators.labels import encode_multi_hot, encode_sparse, with_label_ids
from tagloom.operators.ordering import head_lines
from tagloom.session import materialise
from tagloom.sources.spanning import csv_records, json_objects

CORRUPT = "_corrupt_record"


def decoded(lines: DataFrame, encoding: str, value: str = "value") -> DataFrame:
    """The lines of a text source, which keeps their bytes, read in ``encoding``. Batch and
    streaming readers share it."""
    if encoding.upper() in ("UTF-8", "UTF8"):
        return lines
    return lines.withColumn(value, F.decode(F.col(value).cast("binary"), encoding))


def parse_lines(lines: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """The fields of ``schema`` of JSON lines, and ``_corrupt_record``: the whole line where it
    is no such object, else NULL. Blank lines are no records."""
    parsed = F.from_json(
        value,
        f"{schema}, {CORRUPT} STRING",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "allowSingleQuotes": "false"},
    )
    rows = lines.filter(F.trim(F.col(value), F.lit(" \t\r")) != "")
    rows = rows.select(F.col(value).alias("_line"), parsed.alias("a"))
    lost = F.col("a").isNull() | F.col(f"a.{CORRUPT}").isNotNull()
    broken = F.when(lost, F.col("_line"))
    return rows.select("a.*", broken.alias("_broken")).drop(CORRUPT).withColumnRenamed("_broken", CORRUPT)


def good_and_bad(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine): the records, and the text (line) of what is none."""
    good = parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, parsed.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("line"))


def read_json_lines(
    spark: SparkSession,
    path: str | list[str],
    schema: str,
    encoding: str = "UTF-8",
    max_rows: int = -1,
) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine) of one JSON object per line, of the first ``max_rows`` lines only if
    that is given."""
    lines = spark.read.text(path)
    if max_rows != -1:
        lines = head_lines(lines, max_rows).select("value")
    return good_and_bad(parse_lines(decoded(lines, encoding), schema))


def read_articles(
    spark: SparkSession, path: str | list[str], encoding: str = "UTF-8", max_rows: int = -1
) -> tuple[DataFrame, DataFrame]:
    """(articles, quarantine), one JSON object per line."""
    return read_json_lines(spark, path, schemas.ARTICLE, encoding, max_rows)


def parse_article_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Article fields plus ``_corrupt_record``, from lines of a wrapped article file.

    A line that is no article is kept whole in ``_corrupt_record``.
    The comma or the closing brackets after an object are cut by pattern, so a last
    line without them stays whole. The ``{"articles":[`` opening and bare closing
    lines are no records.
    """
    whole = F.trim(F.col(value), F.lit(" \t\r"))
    body = F.when(whole.endswith(","), F.substring(whole, F.lit(1), F.length(whole) - 1)).otherwise(
        F.regexp_replace(whole, r"(?<=\})\s*\]\s*\}?$", "")
    )
    opening = F.col(value).rlike(r'^\s*\{\s*"articles"\s*:\s*\[\s*$')
    closing = F.col(value).rlike(r"^\s*\]?\s*\}?\s*$")
    inner = lines.filter(~opening & ~closing).select(F.col(value).alias("_whole"), body.alias("value"))
    parsed = F.from_json(
        "value",
        f"{schemas.ARTICLE}, {CORRUPT} STRING",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "allowSingleQuotes": "false"},
    )
    rows = inner.select("_whole", parsed.alias("a"))
    lost = F.col("a").isNull() | F.col(f"a.{CORRUPT}").isNotNull()
    broken = F.when(lost, F.col("_whole"))
    return rows.select("a.*", broken.alias("_broken")).drop(CORRUPT).withColumnRenamed("_broken", CORRUPT)


def read_articles_wrapped(
    spark: SparkSession,
    path: str,
    tags: Sequence[str] | None = None,
    years: Sequence | None = None,
    encoding: str = "ISO-8859-1",
) -> tuple[DataFrame, DataFrame]:
    """(articles, quarantine) of a wrapped article file, one object per line.

    ``quarantine`` has one column, the text of each line that is no article.
    """
    good, bad = good_and_bad(parse_article_lines(decoded(spark.read.text(path), encoding)))
    return filter_article(good, tags, years), bad


def read_tagged_text(
    spark: SparkSession, path: str | list[str], encoding: str = "UTF-8"
) -> tuple[DataFrame, DataFrame]:
    """((text, tags, meta), quarantine): meta as a map of strings, empty when it is not an
    object."""
    rows, bad = read_json_lines(spark, path, schemas.TAGGED_TEXT, encoding)
    none = F.create_map().cast("map<string,string>")
    meta = F.coalesce(F.from_json("meta", "map<string,string>"), none)
    return rows.withColumn("meta", meta), bad


def flatten_meta(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The given meta keys as columns, and the text."""
    return rows.select(*[F.col("meta").getItem(k).alias(k) for k in keys], "text")


def texts(rows: DataFrame) -> DataFrame:
    """Only the texts; no other column is read."""
    return rows.select("text")


def tags(rows: DataFrame, vocabulary: DataFrame | None = None, dense: bool = True) -> DataFrame:
    """Only the tags, as 0/1 vectors over a vocabulary (label_id, label) if one is given, dense
    or as (size, indices); tags that the vocabulary does not have are left out."""
    if vocabulary is None:
        return rows.select("tags")
    coded = with_label_ids(rows.select("tags"), vocabulary, "tags", "drop")
    size = vocabulary.count()
    hot = encode_multi_hot(coded, size) if dense else encode_sparse(coded, size, name="multi_hot")
    return hot.select(F.col("multi_hot").alias("tags"))


def read_publications(
    spark: SparkSession, path: str, form: str = "arrays"
) -> tuple[DataFrame, DataFrame]:
    """(publications, quarantine): ``form`` is "parquet", "lines" for one JSON object per
    line, or "arrays" for files that each hold one JSON array, of which any number of tasks read
    one (:func:`tagloom.sources.spanning.json_objects`). Objects that are no publications are in
    quarantine one by one, and so is text that is in no object."""
    if form == "parquet" or path.rstrip("/").endswith(".parquet"):
        rows = spark.read.schema(schemas.PUBLICATION).parquet(path)
        return rows, spark.createDataFrame([], "line STRING")
    if form == "lines":
        return read_json_lines(spark, path, schemas.PUBLICATION)
    if form != "arrays":
        raise ValueError("form must be parquet, lines or arrays")
    objects, stray = json_objects(spark, path)
    good, bad = good_and_bad(parse_lines(objects, schemas.PUBLICATION))
    return good, bad.unionByName(stray)


def read_parquet_subset(
    spark: SparkSession,
    path: str,
    n_files: int,
    columns: Sequence[str] | None = None,
    seed: int | None = 42,
) -> DataFrame:
    """The named columns of ``n_files`` files under ``path``: in seeded hash order of
    their places in name order, or in name order when ``seed`` is None. Names may hold random
    parts, places do not, so the same data written again gives the same subset. Capped at
    the files there are."""
    files = sorted(spark.read.parquet(path).inputFiles())
    chosen = range(len(files)) if seed is None else subset_places(len(files), seed)
    rows = spark.read.parquet(*[files[i] for i in chosen[:n_files]])
    return rows.select(*columns) if columns else rows


def subset_places(files: int, seed: int) -> list[int]:
    """The places 0 to ``files`` - 1 in the order in which a seeded subset takes them."""
    return sorted(range(files), key=lambda i: hashlib.md5(f"{seed}:{i}".encode()).hexdigest())


def read_csv(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine) of CSV files with one header, read by column name; quoted fields may span
    lines, and any number of tasks read a file (:func:`tagloom.sources.spanning.csv_records`).

    Empty fields are NULL. ``quarantine`` (line) has the records with too many or too few fields and those of which
    a value is not of its type.
    """
    # Written once: headers, rows and both kinds of quarantine are read from it.
    records = materialise(csv_records(spark, path), "records")
    headers = records.filter("kind = 'first'").select("record").distinct().limit(2).collect()
    wanted = spark.createDataFrame([], schema).schema
    if not headers:
        return spark.createDataFrame([], schema), spark.createDataFrame([], "line STRING")
    if len(headers) > 1:
        raise ValueError(f"files under {path} have different headers")
    options = {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    header = headers[0]["record"]
    width = ", ".join(f"c{i} STRING" for i in range(header.count(",") + 1))
    first = spark.createDataFrame([(header,)], "record STRING").select(F.from_csv("record", width, options).alias("h"))
    names = list(first.first()["h"])
    while names and names[-1] is None:  # commas within quotes count too many
        names.pop()
    missing = [f.name for f in wanted if f.name not in names]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    fields = ", ".join(f"c{i} STRING" for i in range(len(names)))
    parsed = records.filter("kind = 'whole'").select(
        "record", F.from_csv("record", f"{fields}, {CORRUPT} STRING", options).alias("r")
    )
    text = {f.name: F.col(f"r.c{names.index(f.name)}") for f in wanted}
    values = [text[f.name].try_cast(f.dataType).alias(f.name) for f in wanted]
    odd = F.col(f"r.{CORRUPT}").isNotNull() | F.col("r").isNull()
    for f in wanted:
        odd = odd | (text[f.name].isNotNull() & text[f.name].try_cast(f.dataType).isNull())
    good = parsed.filter(~odd).select(*values)
    bad = parsed.filter(odd).select(F.col("record").alias("line"))
    return good, bad.unionByName(records.filter("kind = 'bad'").select(F.col("record").alias("line")))


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """(ui, name, annotation, tree_number, tree_numbers) of descriptor XML.

    ``tree_number`` is the first one, NULL for a descriptor without any.
    """
    rows = (
        spark.read.format("xml")
        .option("rowTag", "DescriptorRecord")
        .schema(schemas.DESCRIPTOR)
        .load(path)
    )
    trees = as_column("TreeNumberList.TreeNumber")
    return rows.select(
        F.col("DescriptorUI").alias("ui"),
        F.col("DescriptorName.String").alias("name"),
        F.col("Annotation").alias("annotation"),
        F.get(trees, F.lit(0)).alias("tree_number"),
        trees.alias("tree_numbers"),
    )


def read_terms(spark: SparkSession, path: str, trim: bool = True) -> DataFrame:
    """(label): one term per line, blank lines dropped."""
    value = F.trim("value", F.lit(" \t\r\n")) if trim else F.col("value")
    return spark.read.text(path).select(value.alias("label")).filter(F.trim("label") != "")
