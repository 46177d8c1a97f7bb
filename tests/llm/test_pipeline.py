from __future__ import annotations

import cases
import pytest
from test_quality_rules import measures
from test_simhash import grouped, plain_fingerprint

import corpus_pipeline
from tagloom.llm import chunks, decontaminate, quality_rules

BENCHMARK = "item_id long, text string"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with copies, near copies, a shared passage, leaks and junk."""
    path = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, cases.prose(i, 120), "en", "s", 0) for i in range(30)]
    passage = cases.prose(999, 90)
    item = cases.prose(998, 40, 10**9)
    rows += [(30 + i, rows[3][1], "en", "s", 0) for i in range(5)]
    rows += [(40 + i, f"{cases.prose(40 + i, 80)} {passage} {cases.prose(20_040 + i, 80)}", "en", "s", 0) for i in range(4)]
    rows += [(50 + i, f"{cases.prose(50 + i, 100)} {item} {cases.prose(20_050 + i, 60)}", None, None, None) for i in range(3)]
    rows += [(60, None, None, None, None), (61, "", "en", "s", 0), (62, "few words", "en", "s", 9), (None, cases.prose(62, 90), "en", "s", 1)]
    spark.createDataFrame(rows, cases.DOCUMENTS).repartition(4).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], BENCHMARK).write.parquet(f"{path}/benchmark.parquet")
    return path, rows, item


def through(spark, folder, names):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:names]):
        docs = stage(spark, docs, folder)
        docs.write.mode("overwrite").parquet(f"{folder}/stage{names}-{i}")
        docs = spark.read.parquet(f"{folder}/stage{names}-{i}")
    return docs


def test_stages_equal_brute_force(spark, folder):
    path, rows, item = folder
    columns = spark.read.parquet(f"{path}/documents.parquet").columns
    good = [r for r in rows if (m := measures(r[1]))["n_words"] >= 50 and 2 * m["n_repeat_words"] <= m["n_words"]]
    first = through(spark, path, 1)
    assert first.columns == columns
    assert sorted(map(str, first.collect())) == sorted(map(str, spark.createDataFrame(good, cases.DOCUMENTS).collect()))

    good.sort(key=lambda r: (r[0] is None, r[0]))
    groups = grouped([plain_fingerprint(r[1]) for r in good])
    single = [r for i, r in enumerate(good) if groups[i] == i]
    second = through(spark, path, 2)
    assert second.columns == columns
    assert sorted(str(r["doc_id"]) for r in second.collect()) == sorted(str(r[0]) for r in single)
    assert not {r[0] for r in single} & set(range(30, 35))

    third = {r["doc_id"]: r for r in through(spark, path, 3).collect()}
    seen = set()
    for r in single:
        cut = chunks.Chunks(r[1])
        digests = cut.digests().tolist()
        kept, at = [], 0
        for start, end, _, _ in cut.repeats([i for i, d in enumerate(digests) if d in seen], chunks.LEAST_WORDS):
            kept.append(cut.data[at:start])
            at = end
        seen |= set(digests)
        assert third[r[0]]["text"] == b"".join([*kept, cut.data[at:]]).decode()
    assert all(len(third[i]["text"]) < 0.9 * len(dict((r[0], r[1]) for r in rows)[i]) for i in (41, 42, 43))

    fourth = {r["doc_id"] for r in through(spark, path, 4).collect()}
    need = decontaminate.shingles(decontaminate.words_of(item))
    clean = {d for d, r in third.items() if len(need & decontaminate.shingles(decontaminate.words_of(r["text"]))) < 0.8 * len(need)}
    assert fourth == clean and 50 not in fourth


def test_run_gives_tokens_of_what_is_left(spark, folder):
    path, _, _ = folder
    left = {r["doc_id"]: r["text"] for r in through(spark, path, 4).collect()}
    rows = corpus_pipeline.run(spark, path).collect()
    assert {r["doc_id"]: r["text"] for r in rows} == left
    assert all(r["n_tokens"] * 4 == len(r["ids"]) for r in rows)


def test_every_stage_takes_an_empty_table(spark, folder):
    path, _, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, path).count() == 0


def test_every_stage_takes_awkward_rows_and_more_columns(spark, folder, documents):
    path, _, _ = folder
    docs = cases.clashing(documents)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns and out.count() <= docs.count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, path).count() == docs.count()


def test_rules_are_those_of_the_operator():
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality rules" and quality_rules.RULES
