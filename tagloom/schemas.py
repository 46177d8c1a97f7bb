"""Explicit schemas of the records the jobs read and write."""

from __future__ import annotations

# One article per JSON line. ``year`` is text: both "2023" and 2023 load.
ARTICLE = (
    "journal STRING, meshMajor ARRAY<STRING>, year STRING, "
    "abstractText STRING, title STRING, pmid STRING"
)

# Text with tags. ``meta`` keeps its JSON text because its shape is free.
TAGGED_TEXT = "text STRING, tags ARRAY<STRING>, meta STRING"

PUBLICATION = (
    "title STRING, abstract STRING, mesh_terms ARRAY<STRING>, "
    "categories ARRAY<STRUCT<id: STRING, category_type: STRING>>"
)

GRANT = "title STRING, abstract STRING, for_first_level_name STRING"

DESCRIPTOR = (
    "DescriptorUI STRING, DescriptorName STRUCT<String: STRING>, "
    "Annotation STRING, TreeNumberList STRUCT<TreeNumber: ARRAY<STRING>>"
)

CATEGORY = "category_id STRING, name STRING"
EXCLUSION = "DescriptorName STRING"
ACTIVE_GRANT = "Synopsis STRING"

# One generated answer set per request.
RESPONSE = (
    "request_id STRING, failed BOOLEAN, "
    "choices ARRAY<STRUCT<message: STRUCT<role: STRING, content: STRING>>>, "
    "metadata STRUCT<featured_tag: STRING, tags: ARRAY<STRING>, required_examples: INT, "
    "existing_example: STRING, year: STRING, model_key: STRING>"
)

GENERATED_ARTICLE = (
    "journal STRING, meshMajor ARRAY<STRING>, year STRING, abstractText STRING, pmid STRING, "
    "title STRING, existing_example STRING, required_examples INT, featured_tag STRING"
)
