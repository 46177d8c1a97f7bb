"""Quality rules: a table of thresholds compiled into one projection of ratios.

All columns are Spark expressions; no Python runs on the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import held, unpack

# The characters that count as symbols.
SYMBOLS = "#*$%&|<>"

# Frequent function words of English, German, Spanish and French.
STOP_WORDS = (
    "the of and to in a is that it for as with was on be by this are at from or an not "
    "der die das und den von zu mit ist des im ein eine nicht sich auf für dem als auch "
    "el los las y que un una por con se para del al es su como más lo "
    "le la les de du et en une qui pour dans par est sur au plus pas avec ce il elle"
).split()


class Rule(NamedTuple):
    """``measure / per`` must lie between ``least`` and ``most``; ``per`` 0 passes."""

    name: str
    measure: str
    per: str
    least: float | None = None
    most: float | None = None


RULES = (
    Rule("word_length", "word_chars", "n_words", least=2.5, most=12.0),
    Rule("symbols", "n_symbols", "n_words", most=0.1),
    Rule("shouting", "n_exclamations", "n_words", most=0.25),
    Rule("stop_words", "n_stop_words", "n_words", least=0.05),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", most=0.5),
)

MEASURES = (
    "n_words word_chars n_symbols n_exclamations n_stop_words n_lines n_dup_lines n_repeat_words"
).split()


def measured(rows: DataFrame, text: Column) -> DataFrame:
    """Adds the columns ``MEASURES`` of ``text`` to ``rows``.

    Words are the runs of characters other than ASCII white space. ``n_repeat_words`` is the
    number of words in windows of three words that occur twice or more; stop words count as
    they are written in lower case. A null text is empty.

    A text whose windows all differ in a 64-bit hash repeats nothing. In the others equal
    windows are found by sorting keys made of hash and place, and their words are compared.
    Neither grows with the square of the text.
    """
    spaced = F.col("_text")
    for c in "\t\n\x0b\f\r":
        spaced = F.replace(spaced, F.lit(c), F.lit(" "))
    rows = _with(rows, _text=F.coalesce(text, F.lit("")))
    rows = _with(
        rows,
        _words=F.array_remove(F.split(spaced, " "), ""),
        _lines=F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        n_symbols=F.regexp_count("_text", F.lit(f"[{SYMBOLS}]")).cast("long"),
        n_exclamations=F.regexp_count("_text", F.lit("!")).cast("long"),
    )
    after = F.greatest(F.size("_words") - 2, F.lit(0))
    two = F.zip_with(
        F.slice("_words", 1, after), F.slice("_words", 2, after), lambda a, b: F.xxhash64(a, b)
    )
    rows = _with(
        rows,
        _hashes=F.zip_with(two, F.slice("_words", 3, after), lambda h, c: F.xxhash64(h, c)),
        word_chars=F.length(F.array_join("_words", "")).cast("long"),
        n_words=F.size("_words").cast("long"),
        n_stop_words=F.size(F.filter("_words", lambda w: w.isin(STOP_WORDS))).cast("long"),
        n_lines=F.size("_lines").cast("long"),
        n_dup_lines=(F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
    ).drop("_text", "_lines")
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    bits = F.ceil(F.log2(F.size("_hashes") + F.lit(1))).cast("int")
    rows = _with(rows, _repeats=repeats, _bits=bits)
    keys = F.transform("_hashes", lambda h, i: F.call_function("shiftleft", h, "_bits") + i)
    rows = _with(rows, _keys=F.when(F.col("_repeats"), F.sort_array(keys)))
    pairs = F.zip_with("_keys", F.slice("_keys", 2, F.size("_keys")), _equal_hash)
    rows = _with(rows, _pairs=F.filter(pairs, lambda p: p.isNotNull())).drop("_keys")
    sure = F.forall("_pairs", _equal_words)
    exact = F.when(sure, F.col("_pairs")).otherwise(_pairs_by_words())
    starts = F.sort_array(F.array_distinct(F.flatten(exact)))
    rows = _with(rows, _starts=F.when(F.col("_repeats"), starts)).drop("_words", "_hashes", "_pairs")
    steps = F.zip_with(
        "_starts",
        F.slice("_starts", 2, F.size("_starts")),
        lambda a, b: F.least(F.lit(3).cast("long"), b - a),
    )
    covered = F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)
    return _with(rows, n_repeat_words=F.coalesce(covered, F.lit(0).cast("long"))).drop(
        "_starts", "_repeats", "_bits"
    )


def _equal_hash(a: Column, b: Column) -> Column:
    """The places of two neighbours among the sorted keys if their hashes agree."""
    top = [F.call_function("shiftrightunsigned", x, "_bits") for x in (a, b)]
    low = F.call_function("shiftleft", F.lit(1).cast("long"), "_bits") - 1
    return F.when(top[0] == top[1], F.array(a.bitwiseAND(low), b.bitwiseAND(low)))


def _equal_words(pair: Column) -> Column:
    i, j = pair[0].cast("int"), pair[1].cast("int")
    return (
        (F.get("_words", i) == F.get("_words", j))
        & (F.get("_words", i + 1) == F.get("_words", j + 1))
        & (F.get("_words", i + 2) == F.get("_words", j + 2))
    )


def _pairs_by_words() -> Column:
    """Places of equal windows from the words alone, for texts in which hashes collide."""
    n = F.size("_hashes")
    two = F.zip_with(
        F.slice("_words", 1, n), F.slice("_words", 2, n), lambda a, b: F.concat(a, F.lit(" "), b)
    )
    three = F.zip_with(two, F.slice("_words", 3, n), lambda a, b: F.concat(a, F.lit(" "), b))
    placed = F.sort_array(
        F.transform(three, lambda w, i: F.struct(w.alias("w"), i.cast("long").alias("i")))
    )
    pairs = F.zip_with(
        placed,
        F.slice(placed, 2, n),
        lambda a, b: F.when(a["w"] == b["w"], F.array(a["i"], b["i"])),
    )
    return F.filter(pairs, lambda p: p.isNotNull())


def _with(rows: DataFrame, **columns: Column) -> DataFrame:
    return rows.withColumns(columns)


def base_failed() -> Column:
    """Fewer than 50 words, or more than half of the words in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def passes(rule: Rule) -> Column:
    """The rule as a condition on the measures, in whole numbers times thresholds."""
    measure, per = F.col(rule.measure).cast("double"), F.col(rule.per).cast("double")
    holds = F.lit(True)
    if rule.least is not None:
        holds = holds & (measure >= F.lit(rule.least) * per)
    if rule.most is not None:
        holds = holds & (measure <= F.lit(rule.most) * per)
    return (per == 0) | holds


def verdict(rules: Sequence[Rule] = RULES) -> Column:
    """Names of the rules that a text breaks."""
    return F.filter(
        F.array(*[F.when(~passes(r), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull()
    )


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """One row per document: ``row`` (its columns as a struct), the measures, ``base_failed``,
    ``broken`` (names of the broken rules) and ``kept``.

    Null and empty texts have no words, so they fail the base rule. Repeated rows are judged
    alike, an empty table gives an empty one, and other columns can have any name.
    """
    packed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    rows = measured(packed, F.col(f"row.`{text}`"))
    rows = rows.withColumns({"base_failed": base_failed(), "broken": verdict(rules)})
    kept = ~F.col("base_failed") & (F.size("broken") == 0)
    names = [*MEASURES, "base_failed", "broken"]
    return held(rows.select("row", F.struct(*names, kept.alias("kept")).alias("_m")), **{
        n: F.col(f"_m.{n}") for n in [*names, "kept"]
    }).drop("_m")


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """The documents that no rule rejects, with all their columns."""
    return unpack(judge(docs, rules, text).filter("kept"), docs.columns)
