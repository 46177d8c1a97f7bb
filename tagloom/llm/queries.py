"""One query per operator over its whole table, and their SQL where it can be said in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import (
    bpe,
    chunks,
    decontaminate,
    html_extract,
    importance,
    langid,
    mixing,
    quality_rules,
    simhash,
    trie,
    url_filter,
    warc,
    whitening,
)
from tagloom.llm.common import table


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    documents, benchmark = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return decontaminate.find_leaks(documents, benchmark)


def op2_html(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extract(table(spark, folder, "pages"))


def op3_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(table(spark, folder, "documents"))


def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return langid.identify(documents, langid.train(documents))


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op6_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return chunks.repeats(table(spark, folder, "documents"), within=True)


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages")).drop("url", "payload")


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, folder, "documents"))
    return judged.select(
        F.col("row.doc_id").alias("doc_id"),
        *[c for c in quality_rules.MEASURES if c not in ("n_exclamations", "n_stop_words")],
        "base_failed",
        "kept",
    )


def op9_importance(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return importance.resample(documents, labels, leave_toxic=True)


def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return url_filter.judge_urls(pages, blocked_hosts=url_filter.hosts_named(pages))


def op11_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"), keep=["doc_id"])
    return mixed.select("doc_id", *[f"mix.{c}" for c in ("size", "source_size", "target", "taken")])


def op12_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns, members = trie.with_heads(trie.numbered_turns(table(spark, folder, "conversations")))
    return trie.prefix_trie(turns, members)


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


def _rules_sql() -> str:
    """The threshold table as SQL conditions."""
    parts = []
    for r in quality_rules.RULES:
        m, per = f"CAST({r.measure} AS DOUBLE)", f"CAST({r.per} AS DOUBLE)"
        if r.least is not None:
            parts.append(f"({per} = 0 OR {m} >= {r.least} * {per})")
        if r.most is not None:
            parts.append(f"({per} = 0 OR {m} <= {r.most} * {per})")
    return " AND ".join(parts)


_STOP = ", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)

OP8_SQL = rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT doc_id, rid, t,
    list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), windows AS (
  SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
  FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), repeated AS (
  SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, win) > 1
), covered AS (
  SELECT rid, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM repeated) GROUP BY rid
), m AS (
  SELECT doc_id, len(words) AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    length(regexp_replace(t, '[^!]', '', 'g')) AS n_exclamations,
    len(list_filter(words, lambda x: x IN ({_STOP}))) AS n_stop_words,
    len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM w LEFT JOIN covered USING (rid)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {_rules_sql()} AS kept
FROM b
"""

OP7_SQL = f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
    sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p
), r AS (
  SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= {warc.LEAST_SHARED} AND page_id IS DISTINCT FROM first THEN first END AS refers_to
  FROM f
)
SELECT *, CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type FROM r
"""


def _url_cases() -> tuple[str, str]:
    """Rules and verdicts as branches, the longest rule first."""
    fits, verdicts = [], []
    for verdict, host, path in sorted(url_filter.RULES, key=lambda r: -len(r[1] + r[2])):
        test = f"(('.' || host) LIKE '%.{host}' AND starts_with(path, '{path}'))"
        fits.append(f"WHEN {test} THEN '{host}{path}'")
        verdicts.append(f"WHEN {test} THEN '{verdict}'")
    names = ", ".join(f"'{n}'" for n in url_filter.BLOCKED_NAMES)
    verdicts.append(f"WHEN list_has_any(string_split(host, '.'), [{names}]) THEN 'block'")
    return "\n    ".join(fits), "\n    ".join(verdicts)


_RULE, _VERDICT = _url_cases()

OP10_SQL = rf"""
WITH r AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN url[strpos(url, '://') + 3:] ELSE '' END AS rest
  FROM pages
), h AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM r
), p AS (
  SELECT page_id,
    translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest[length(raw) + 1:], '^[^?#]*') AS path
  FROM h
)
SELECT page_id, host, path,
  CASE {_RULE} END AS rule,
  CASE {_VERDICT} ELSE 'allow' END AS verdict
FROM p
"""

# The words per weight at which a source is clamped fall as more of them are, so the clamped ones are
# the first in the order of size per weight.
OP11_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i
  FROM d GROUP BY source
), w AS (
  SELECT source, source_size, {mixing.MAX_EPOCHS} * source_size :: DOUBLE AS cap,
    [{", ".join(f"{float(w)}" for w in mixing.WEIGHTS)}][i % {len(mixing.WEIGHTS)} + 1] :: DOUBLE AS weight,
    {mixing.SHARE} * (sum(source_size) OVER ()) :: DOUBLE AS budget
  FROM s
), c AS (
  SELECT *, cap < weight * (budget - coalesce(sum(cap) OVER before, 0)) / sum(weight) OVER rest AS clamped FROM w
  WINDOW before AS (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    rest AS (ORDER BY cap / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), t AS (
  SELECT source, source_size, least(cap, weight * (budget - coalesce(sum(cap) FILTER (clamped) OVER (), 0))
    / sum(weight) FILTER (NOT clamped) OVER ()) AS target
  FROM c
), e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t
), r AS (
  SELECT doc_id, size, source_size, target, whole, target - whole * source_size AS wanted,
    sum(size) OVER (PARTITION BY d.source ORDER BY
      md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || size) ROWS UNBOUNDED PRECEDING) AS run
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, size, source_size, target,
  CAST(size * (whole + CASE WHEN wanted > 0 AND 2 * run - size < 2 * wanted THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r
"""

# CRC-32 of the digits of an id, bit by bit: a byte is mixed in, then eight shifts follow.
_CRC = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(
      string_split(CAST(conv_id AS VARCHAR), ''), lambda d: [ascii(d) :: BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END))"""

# A node's key is the digests of its turns, one after the other, so its ancestors' keys start it.
OP12_SQL = f"""
WITH d AS (
  SELECT conv_id, turn, coalesce(text, '') AS text,
    md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
  FROM conversations WHERE conv_id IS NOT NULL
), t AS (
  SELECT conv_id, digest, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS pos FROM d
), c AS (
  SELECT conv_id, conv_id - conv_id % {trie.BLOCK} AS base, count(*) AS n, {_CRC} % {trie.HEADS} AS h FROM t GROUP BY conv_id
), m AS (
  SELECT c.conv_id, c.base, c.h, least(c.h, coalesce(b.n, 0)) AS head, least(c.h, coalesce(b.n, 0)) + greatest(c.n - c.h, 0) AS len
  FROM c LEFT JOIN c b ON b.conv_id = c.base
), r AS (
  SELECT m.conv_id, t.pos, digest, text FROM m JOIN t ON t.conv_id = m.base AND t.pos <= m.head
  UNION ALL SELECT conv_id, head + pos - h, digest, text FROM m JOIN t USING (conv_id) WHERE pos > h
), p AS (
  SELECT conv_id, pos, length(text) AS chars, string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY pos) AS key FROM r
  UNION ALL SELECT conv_id, 0, 0, '' FROM m
), nodes AS (
  SELECT key, pos AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(chars) AS saved FROM p GROUP BY key, pos
), children AS (
  SELECT key[:32 * (depth - 1)] AS key, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), linked AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (key)
), totals AS (
  SELECT key[:32 * i] AS key, CAST(count(*) FILTER (n_children = 0) AS BIGINT) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS i FROM linked) GROUP BY 1
), ends AS (
  SELECT key, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends_sha256
  FROM p JOIN m USING (conv_id) WHERE pos = len GROUP BY key
)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens,
  coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM linked n JOIN totals USING (key) LEFT JOIN ends USING (key)
  LEFT JOIN nodes up ON n.depth > 0 AND up.key = n.key[:32 * (n.depth - 1)]
"""

QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_html": op2_html,
    "op3_bpe": op3_bpe,
    "op4_language": op4_language,
    "op5_simhash": op5_simhash,
    "op6_chunks": op6_chunks,
    "op7_warc": op7_warc,
    "op8_quality_rules": op8_quality_rules,
    "op9_importance": op9_importance,
    "op10_url_filter": op10_url_filter,
    "op11_mixing": op11_mixing,
    "op12_trie": op12_trie,
    "op13_whitening": op13_whitening,
}

STATEMENTS = {
    "op7_warc": OP7_SQL,
    "op8_quality_rules": OP8_SQL,
    "op10_url_filter": OP10_SQL,
    "op11_mixing": OP11_SQL,
    "op12_trie": OP12_SQL,
}
