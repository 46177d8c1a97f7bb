from __future__ import annotations

import json
import math

from compare import rows
from pyspark.sql import functions as F

from tagloom import schemas
from tagloom.operators import augment, labels

ARTICLES = [
    ("1", ["rare", "common"], "first 'text'"),
    ("2", ["common", "common"], "second"),
    ("3", ["rare", "rare", "odd"], "third"),
    ("4", ["common"], "fourth"),
]


def articles(frame):
    return frame(ARTICLES, "pmid string, meshMajor array<string>, abstractText string")


def test_requests_cover_every_rare_tag(frame):
    df = articles(frame)
    rare = labels.rare_tags(labels.tag_counts(df), min_examples=4)
    got = augment.build_requests(df, rare, 5, "{TOPIC}: {ABSTRACT}", year=2024).collect()
    assert sorted((r.metadata.featured_tag, r.messages[0].content) for r in got) == [
        ("odd", "odd: third"), ("rare", "rare: first 'text'"), ("rare", "rare: third"),
    ]
    assert {(r.metadata.featured_tag, r.n) for r in got} == {("odd", 5), ("rare", 3)}
    assert {r.metadata.year for r in got} == {"2024"} and {r.temperature for r in got} == {1.5}
    assert len({r.request_id for r in got}) == 3


def test_seeds_of_a_hot_tag(spark):
    df = spark.range(500).select(F.format_string("%04d", "id").alias("pmid"), F.array(F.lit("hot")).alias("meshMajor"))
    tags = spark.createDataFrame([("hot",)], "label string")
    got = augment.seeds_per_tag(augment.seed_docs(df, tags), 7).collect()
    assert sorted(r.pmid for r in got) == [f"{i:04d}" for i in range(7)]
    assert {(r.available, r.used, r.n_per_seed) for r in got} == {(500, 7, 1)}
    few = augment.seeds_per_tag(augment.seed_docs(df.limit(3), tags), 7).collect()
    assert {(r.used, r.n_per_seed) for r in few} == {(3, math.ceil(7 / 3))}


def response(i, failed, *contents):
    return {
        "request_id": i,
        "failed": failed,
        "choices": [{"message": {"role": "assistant", "content": c}} for c in contents],
        "metadata": {
            "featured_tag": "T", "tags": ["T", "U"], "required_examples": 3,
            "existing_example": "it's \"old\"", "year": "2024", "model_key": "m",
        },
    }


def test_answers_become_articles(spark, tmp_path):
    good = json.dumps({"abstract": "a \"quoted\" text's\nline", "title": "the 'title'"})
    data = [response("r1", False, good, "no json", None), response("r2", True, good), response("r3", None, good, '{"title": 1}')]
    path = tmp_path / "r.jsonl"
    path.write_text("\n".join(json.dumps(d) for d in data))
    found, rejected = augment.ingest_responses(spark.read.schema(schemas.RESPONSE).json(str(path)))
    got = found.collect()
    assert len(got) == 2 and len({r.pmid for r in got}) == 2
    assert set(found.columns) == {
        "journal", "meshMajor", "year", "abstractText", "pmid", "title", "existing_example",
        "required_examples", "featured_tag",
    }
    r = got[0]
    assert (r.journal, r.meshMajor, r.year, r.abstractText, r.title, r.existing_example) == (
        "m", ["T", "U"], "2024", "a quoted texts\nline", "the title", "its old",
    )
    assert rows(rejected, "request_id", "choice", "answer") == sorted(
        [("r1", 1, "no json"), ("r3", 1, '{"title": 1}'), ("r1", 2, None), ("r2", None, None)], key=repr
    )


def test_random_ids(spark, tmp_path):
    path = tmp_path / "r.jsonl"
    good = json.dumps({"abstract": "a", "title": "t"})
    path.write_text(json.dumps(response("r", False, good, good)))
    found, _ = augment.ingest_responses(spark.read.schema(schemas.RESPONSE).json(str(path)), ids="uuid")
    ids = [r.pmid for r in found.collect()]
    assert len(set(ids)) == 2 and all(len(i) == 32 for i in ids)
