from __future__ import annotations

from compare import rows

from tagloom.operators import taxonomy

NODES = [
    ("D1", "Root", None, "A11", ["A11", "Z1"]),
    ("D2", "Child", None, "A11.118", ["A11.118"]),
    ("D3", "Grandchild", "x: Do not use", "A11.118.637", ["A11.118.637"]),
    ("D4", "Neighbour", None, "A111.5", ["A111.5"]),
    ("D5", "Elsewhere", "fine", "B01", ["B01", "A11.9"]),
    ("D6", "Nowhere", None, None, None),
]
SCHEMA = "ui string, name string, annotation string, tree_number string, tree_numbers array<string>"


def names(df):
    return [r[0] for r in rows(df, "name")]


def test_subtree(frame, spark):
    nodes = frame(NODES, SCHEMA)
    root = spark.createDataFrame([("Root",), ("Missing",), ("Nowhere",)], "name string")
    assert names(taxonomy.subtree(nodes, root)) == ["Child", "Grandchild", "Root"]
    assert names(taxonomy.subtree(nodes, root, dot_aware=False)) == ["Child", "Grandchild", "Neighbour", "Root"]
    assert names(taxonomy.subtree(nodes, root, all_trees=True)) == ["Child", "Elsewhere", "Grandchild", "Root"]
    both = spark.createDataFrame([("Root",), ("Child",)], "name string")
    assert names(taxonomy.subtree(nodes, both)) == ["Child", "Grandchild", "Root"]


def test_subtree_has_no_nested_loop(frame, spark):
    root = spark.createDataFrame([("Root",)], "name string")
    for aware in (True, False):
        plan = taxonomy.subtree(frame(NODES, SCHEMA), root, dot_aware=aware)._jdf.queryExecution().toString()
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_inclusion_list(frame, spark):
    excluded = spark.createDataFrame([("Root",)], "DescriptorName string")
    got = taxonomy.inclusion_list(frame(NODES, SCHEMA), excluded)
    assert [r[0] for r in rows(got)] == ["Child", "Elsewhere", "Neighbour", "Nowhere"]


def test_category_names(spark):
    rows_ = spark.createDataFrame([(1, ("c1", "for")), (2, ("c9", "for"))], "id int, category struct<id: string, category_type: string>")
    dims = spark.createDataFrame([("c1", "One")], "category_id string, name string")
    got = rows(taxonomy.join_category_name(rows_, dims), "id", "category_name", "category_type")
    assert got == [(1, "One", "for"), (2, None, "for")]


def test_portfolio(spark):
    sample = spark.createDataFrame([(1, "a", "s")], "id int, abstract string, stratum string")
    active = spark.createDataFrame([(9, "z"), (7, None), (8, "y")], "id int, Synopsis string")
    got = rows(taxonomy.union_portfolio(sample, active, 1, "id"), "id", "abstract", "stratum", "active_portfolio")
    assert got == [(1, "a", "s", 0), (8, "y", None, 1)]
