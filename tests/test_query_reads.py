"""How registered queries write and read what they work on."""

from __future__ import annotations

import glob
import re

import pytest

from tagloom.plans import catalog_records, catalog_text
from tagloom.sources import records


@pytest.fixture
def tables(spark, tmp_path):
    """A small documents, part, orders and lineitem table."""
    d = tmp_path / "tables"
    spark.sql("SELECT id AS doc_id, concat('a text ', id) AS text, 'en' AS lang, 's' AS source, 9L AS n_chars FROM range(80)").write.parquet(f"{d}/documents.parquet")
    spark.sql("SELECT id AS p_partkey, concat('part ', id) AS p_name, concat('Brand#', id % 5) AS p_brand, 'T' AS p_type, int(id % 30) AS p_size FROM range(40)").write.parquet(f"{d}/part.parquet")
    spark.sql("SELECT id AS o_orderkey, '1' AS o_orderpriority, date_add(date'2024-01-01', int(id)) AS o_orderdate FROM range(60)").write.parquet(f"{d}/orders.parquet")
    spark.sql("SELECT id % 60 AS l_orderkey, id % 40 AS l_partkey FROM range(200)").write.parquet(f"{d}/lineitem.parquet")
    return str(d)


def scratch(monkeypatch, module, tmp_path):
    monkeypatch.setattr(module, "scratch_path", lambda spark, name: f"{tmp_path}/made/{name}")
    return f"{tmp_path}/made"


def test_each_file_of_the_subset_has_its_own_task(spark, tables, tmp_path, monkeypatch):
    made = scratch(monkeypatch, catalog_records, tmp_path)
    found = catalog_records.src_parquet_subset(spark, tables).collect()
    wanted = [i for i in range(80) if i % 8 in catalog_records.SUBSET]
    assert sorted(r.abstract for r in found) == sorted(f"a text {i}" for i in wanted)
    files = glob.glob(f"{made}/grants/file=*/*.parquet")
    assert len({re.search(r"part-(\d+)", f)[1] for f in files}) == len(files) == 8


def test_taxonomy_files_are_bounded(spark, tables, tmp_path, monkeypatch):
    made = scratch(monkeypatch, catalog_records, tmp_path)
    monkeypatch.setattr(catalog_records, "XML_RECORDS", 3)
    found = catalog_records.src_taxonomy_xml(spark, tables)
    assert found.select("ui").distinct().count() == found.count() == 40
    assert all(open(f).read().count("<DescriptorRecord>") <= 3 for f in glob.glob(f"{made}/descriptors/part-*"))


def test_csv_records_are_cut_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text('doc_id,text\n1,"a\nb"\nx,c\n')
    good, bad = records.read_csv(spark, str(tmp_path / "a.csv"), "doc_id BIGINT, text STRING")
    for df in (good, bad):
        assert "MapInArrow" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r) for r in good.collect()] == [(1, "a\nb")] and [r.line for r in bad.collect()] == ["x,c"]


def test_responses_are_built_once(spark, tables):
    found = catalog_text.ingest_responses(spark, tables)
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_orders_arrive_in_several_files_a_batch(spark, tables, tmp_path, monkeypatch):
    made = scratch(monkeypatch, catalog_text, tmp_path)
    assert sum(r.n for r in catalog_text.stream_monthly(spark, tables).collect()) == 60
    assert len(glob.glob(f"{made}/months/data/batch_id=*")) < len(glob.glob(f"{made}/incoming/*.parquet"))
