"""Rows that every operator must take: nulls, empty and long texts, ties, repeats."""

from __future__ import annotations

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, words: int, line: int = 12) -> str:
    """Words of a made-up language, in lines."""
    rng = random.Random(seed)
    out = []
    for i in range(words):
        common = rng.random() < 0.35
        word = rng.choice(("the", "of", "and", "in", "to", "is")) if common else "".join(
            rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))
        )
        out.append(word + ("\n" if i % line == line - 1 else " "))
    return "".join(out).strip()


def documents() -> list[tuple]:
    """Twelve kinds of rows, with extra columns filled in."""
    base = prose(1, 200)
    texts = [
        (1, base),
        (2, base),
        (3, base + " tail"),
        (3, base + " tail"),
        (4, None),
        (5, ""),
        (6, " \n\t "),
        (None, base),
        (None, None),
        (7, "one two"),
        (8, prose(2, 60_000)),
        (9, "word " * 500),
        (10, "Ünïcödé \U0001f600 텍스트 \x1c mixed space " * 30),
    ]
    return [(i, t, "en", "s", len(t) if t is not None else None) for i, t in texts]


def clashing(df):
    """``df`` with more columns, named like those that operators make themselves."""
    names = "rid row fp key root component_id place found cut digest n_words kept words digests _text"
    have = set(df.columns)
    return df.selectExpr("*", *[f"'x' AS `{n}`" for n in names.split() if n not in have])
