"""String, list and JSON expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagloom.functions.columns import as_column

# Runs of two or more letters, digits or underscores in any script.
WORD = r"[\p{L}\p{N}_]{2,}"

GENERATED_ANSWER = "array<struct<abstract: string, title: string>>"


def normalise_heading(heading: Column | str) -> Column:
    """Main heading of ``Main/qualifier*``: cut at the first slash, drop one star."""
    return F.regexp_replace(F.split_part(as_column(heading), F.lit("/"), F.lit(1)), r"\*$", "")


def normalise_headings(headings: Column | str) -> Column:
    """:func:`normalise_heading` on every element; order and repeats stay."""
    return F.transform(as_column(headings), normalise_heading)


def parse_list(text: Column | str, trim: bool = False) -> Column:
    """Items of a comma list without the blank ones; NULL gives an empty list."""
    items = F.filter(
        F.split(F.coalesce(as_column(text), F.lit("")), ",", -1), lambda x: F.trim(x) != ""
    )
    return F.transform(items, lambda x: F.trim(x)) if trim else items


def strip_quotes(text: Column | str) -> Column:
    """Without single and double quotes."""
    return F.translate(as_column(text), "'\"", "")


def strip_breaks(text: Column | str, replacement: str = " ") -> Column:
    """Line breaks and tabs replaced; ``replacement=""`` glues the words together."""
    return F.regexp_replace(as_column(text), r"[\n\t]", replacement)


def render_prompt(template: str, topic: Column | str, abstract: Column | str) -> Column:
    """``template`` with ``{TOPIC}`` filled in first and ``{ABSTRACT}`` second."""
    with_topic = F.replace(F.lit(template), F.lit("{TOPIC}"), as_column(topic))
    return F.replace(with_topic, F.lit("{ABSTRACT}"), as_column(abstract))


def parse_generated(answer: Column | str) -> Column:
    """Struct(abstract, title) of a strict JSON answer, NULL when it does not hold both.

    The answer is parsed as the only element of an array, so text after the
    object makes it invalid, as it should be.
    """
    parsed = F.from_json(
        F.concat(F.lit("["), F.trim(as_column(answer), F.lit(" \n\r\t")), F.lit("]")),
        GENERATED_ANSWER,
        {"mode": "PERMISSIVE", "allowSingleQuotes": "false"},
    )
    found = F.get(parsed, F.lit(0))
    whole = (F.size(parsed) == 1) & found.abstract.isNotNull() & found.title.isNotNull()
    return F.when(whole, found)


def parse_term_list(text: Column | str) -> Column:
    """Array from a printed list such as ``['a', "b's"]``."""
    item = r"""'((?:[^'\\]|\\.)*)'|"((?:[^"\\]|\\.)*)\""""
    quoted = F.regexp_extract_all(as_column(text), F.lit(item), F.lit(0))
    return F.transform(
        quoted,
        lambda x: F.regexp_replace(F.substring(x, F.lit(2), F.length(x) - 2), r"\\(.)", "$1"),
    )


def words(text: Column | str, lowercase: bool = True) -> Column:
    """Words of the whole text, in order."""
    source = F.lower(as_column(text)) if lowercase else as_column(text)
    return F.regexp_extract_all(source, F.lit(WORD), F.lit(0))


def ngrams(tokens: Column, low: int, high: int) -> Column:
    """Runs of ``low`` to ``high`` neighbouring tokens, joined by a space."""
    if (low, high) == (1, 1):
        return tokens

    def runs(n: int) -> Column:
        starts = F.when(
            F.size(tokens) >= n, F.sequence(F.lit(1), F.size(tokens) - F.lit(n - 1))
        ).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, F.lit(n)), " "))

    return F.concat(*[runs(n) for n in range(low, high + 1)])


def without_words(tokens: Column, stop_words: Sequence[str]) -> Column:
    """Tokens that are not stop words; repeats stay."""
    if not stop_words:
        return tokens
    return F.filter(tokens, lambda t: ~t.isin(*stop_words))
