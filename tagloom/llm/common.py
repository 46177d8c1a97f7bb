"""What the operators of this folder share: Arrow batches in small slices, row ids,
column barriers and connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import tagloom.llm
from tagloom.session import materialise

# Functions of this folder travel to the executors with the tasks that call them, so it
# needs not be installed there.
cloudpickle.register_pickle_by_value(tagloom.llm)

# Rows of one Arrow batch between Spark and Python, and of one slice that is turned
# into Python objects. Both bound the memory of a task when texts are long.
BATCH_ROWS = 1_000
SLICE_ROWS = 128

# ASCII white space: the words of all operators are what lies between these.
SPACE = r"[\x20\x09-\x0D]"


def small_batches(spark: SparkSession) -> None:
    """Limits Arrow batches, in rows, for the rest of the session; never raises the limit."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sent(spark: SparkSession, value):
    """Broadcasts ``value``, whose size the caller has bounded, together with its classes.
    Returns a function that gives it back, unpacked once per task."""
    packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    unpacked: dict = {}

    def get():
        if not unpacked:
            unpacked["value"] = cloudpickle.loads(packed.value)
        return unpacked["value"]

    return get


def map_slices(
    df: DataFrame,
    function: Callable[[dict[str, list]], dict[str, list]],
    schema: str,
    prepare: Callable[[], Callable] | None = None,
) -> DataFrame:
    """Applies ``function`` to slices of at most ``SLICE_ROWS`` rows of ``df``.

    ``function`` takes and returns a dict of lists, one per column; the lists it returns
    may be of another length. With ``prepare`` the function is made once per task by
    ``prepare()``, which may load what the task needs.
    """
    spark = df.sparkSession
    small_batches(spark)
    arrow = arrow_schema(schema)
    names = list(df.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = function if prepare is None else prepare()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                out = call({n: part.column(i).to_pylist() for i, n in enumerate(names)})
                arrays = [pa.array(out[f.name], type=f.type) for f in arrow]
                if len(arrays[0]):
                    yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, schema)


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {
        "long": pa.int64(),
        "int": pa.int32(),
        "double": pa.float64(),
        "string": pa.string(),
        "boolean": pa.bool_(),
        "binary": pa.binary(),
        "array<long>": pa.list_(pa.int64()),
        "array<string>": pa.list_(pa.string()),
    }
    fields = (part.strip().rsplit(" ", 1) for part in ddl.split(","))
    return pa.schema([pa.field(name, kinds[kind]) for name, kind in fields])


def held(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are worked out once, however often they are used afterwards.

    They come from a generator of one row, across which the optimiser moves no
    expression, so a later filter doesn't repeat them.
    """
    row = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def with_row_ids(docs: DataFrame, more: Sequence[Column] = ()) -> DataFrame:
    """Written table of ``row`` (all columns of ``docs`` as a struct), ``rid`` (a number of
    that row alone) and the columns ``more``, which are worked out from those of ``docs``.

    Row ids make repeated and null keys harmless, and as they are written they stay the
    same when a lost task is run again.
    """
    rows = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
        *more,
        F.monotonically_increasing_id().alias("rid"),
    )
    return materialise(rows, "rows")


def unpack(rows: DataFrame, names: Sequence[str], **changed: Column) -> DataFrame:
    """The columns ``names`` out of ``row``, with some of them replaced."""
    return rows.select(
        *[changed[n].alias(n) if n in changed else F.col(f"row.`{n}`").alias(n) for n in names]
    )


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of the graph with edges ``links(a, b)``: (node, root), root being
    the smallest node of the component. Nodes without a link are not in it.

    Large and small stars in turn: each round links every node with the smallest of its
    neighbours, first its larger neighbours, then its smaller ones, until nothing changes,
    which takes about log(size) rounds. A hub's edges are joined with one row, its
    minimum, so Spark can split them. Every round is written to the shared folder.
    """
    stars = materialise(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter("u > v")
        .distinct(),
        "links",
    )
    before = None
    while True:
        both = stars.unionAll(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionAll(least.select("u", F.col("m").alias("v")))
        stars = materialise(small.filter("u > v").distinct(), "stars")
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    nodes = stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionAll(nodes.select(F.col("root").alias("node"), "root").distinct())
