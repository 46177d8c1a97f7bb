from __future__ import annotations

import random
import zlib
from collections import Counter

import cases
import numpy as np
import pytest

from tagloom.llm import langid

SYLLABLES = {"aa": "ka ro ti mu sel ", "bb": "zen vor dül pra ", "cc": "esh lia qon uri "}


def text_in(language, seed, words=60):
    rng = random.Random(seed)
    parts = SYLLABLES[language].split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(words))


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, text_in(g, i), g) for i in range(240) for g in [sorted(SYLLABLES)[i % 3]]]
    rows += [(1_000, None, "aa"), (1_001, "123 !", "bb"), (1_002, text_in("cc", 1), None), (None, text_in("aa", 2), "aa")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)


def plain_kn(texts, order):
    """Interpolated Kneser-Ney by its recursion, with counts as dicts."""
    top = Counter()
    for t in texts:
        ready = langid.prepared(t)
        top.update(ready[i - order : i] for i in range(order, len(ready) + 1))
    counts = {order: top}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    ones = {k: sum(c == 1 for c in v.values()) for k, v in counts.items()}
    twos = {k: sum(c == 2 for c in v.values()) for k, v in counts.items()}
    discount = {k: min(0.95, max(0.1, ones[k] / (ones[k] + 2 * twos[k]) if ones[k] else 0.5)) for k in counts}

    def p(gram, letters):
        k = len(gram)
        below = 1 / (letters + 1) if k == 1 else p(gram[1:], letters)
        same = {g: c for g, c in counts[k].items() if g[:-1] == gram[:-1]}
        total = sum(same.values())
        if not total:
            return below
        return max(same.get(gram, 0) - discount[k], 0) / total + discount[k] * len(same) / total * below

    return p, {g for g in counts[1]}


def test_probabilities_follow_the_recursion():
    texts = {"aa": [text_in("aa", i, 8) for i in range(2)], "bb": [text_in("bb", i, 8) for i in range(2)]}
    counts = {}
    for g, own in texts.items():
        counts[g] = Counter()
        for t in own:
            ready = langid.prepared(t)
            counts[g].update(ready[i - langid.ORDER : i] for i in range(langid.ORDER, len(ready) + 1))
    model = langid.fit(counts)
    plain = {g: plain_kn(own, langid.ORDER) for g, own in texts.items()}
    letters = len(set().union(*(s for _, s in plain.values())))
    for probe in ("karo zen", "dülxyz", "titi"):
        ready = langid.prepared(probe)
        got = model.entropies([ready])[0]
        for i, g in enumerate(model.languages):
            logs = [np.log2(plain[g][0](ready[j - 4 : j], letters)) for j in range(4, len(ready) + 1)]
            # the first character is predicted from padding of its own length
            assert got[i] == pytest.approx(-np.mean(logs), abs=1e-3)


def test_batches_do_not_change_a_text():
    counts = {g: Counter() for g in ("aa", "bb")}
    for g in counts:
        ready = langid.prepared(text_in(g, 1, 300))
        counts[g].update(ready[i - 4 : i] for i in range(4, len(ready) + 1))
    model = langid.fit(counts)
    texts = [langid.prepared(text_in(g, s, n)) for g in counts for s, n in ((2, 1), (3, 50))]
    together = model.entropies(texts)
    assert np.allclose(together, np.concatenate([model.entropies([t]) for t in texts]), atol=1e-5)


def test_held_out_accuracy(table):
    model = langid.train(table)
    rows = langid.identify(cases.clashing(table.withColumnRenamed("lang", "language")), model).collect()
    assert len(rows) == 244
    for r in rows:
        doc = r["doc_id"]
        assert 0 <= r["score"] <= 1
        assert r["held_out"] == (doc is not None and zlib.crc32(str(doc).encode()) % 4 == 2)
        if doc is not None and doc < 240:
            assert r["lang_pred"] == sorted(SYLLABLES)[doc % 3] and not r["rejected"]
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1_000]["lang_pred"] == by_id[1_001]["lang_pred"] == "und"
    assert by_id[1_002]["lang_pred"] == "cc" and by_id[None]["lang_pred"] == "aa"


def test_strange_texts_are_rejected(spark, table):
    model = langid.train(table, documents=40, calibration=10)
    odd = spark.createDataFrame([(1, "XYWJ hhhh ффф " * 20)], "doc_id long, text string")
    row = langid.identify(odd, model).first()
    assert row["rejected"] and row["lang_pred"] in SYLLABLES


def test_held_out_rows_are_not_learned_from(spark):
    rows = [(i, text_in("aa", i), "aa" if zlib.crc32(str(i).encode()) % 4 != 2 else "wrong") for i in range(80)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["aa"]


def test_empty_tables(spark, table):
    empty = table.limit(0)
    model = langid.train(empty)
    assert model.languages == []
    assert {r["lang_pred"] for r in langid.identify(table, model).collect()} == {"und"}
    assert langid.identify(empty, langid.train(table)).count() == 0
    assert langid.train(spark.createDataFrame([(1, "12", "aa"), (3, None, "bb")], table.schema)).languages == []


def test_a_model_too_large_is_an_error(table, monkeypatch):
    monkeypatch.setattr(langid, "MAX_MODEL_BYTES", 2 * 20 * 300)
    with pytest.raises(ValueError, match="bytes"):
        langid.train(table)


def test_long_texts_are_scored_in_pieces(table, monkeypatch):
    model = langid.train(table)
    texts = [langid.prepared(r.text) for r in table.collect() if langid.prepared(r.text)]
    texts.append(langid.prepared(" ".join(texts)))
    whole = model.entropies(texts)
    for piece in (1, 7, 1_000):
        monkeypatch.setattr(langid, "PIECE", piece)
        assert np.allclose(model.entropies(texts[-3:]), whole[-3:], atol=1e-9)


def test_figures_are_no_letters():
    assert langid.prepared("½ ² ⅷ 7") == langid.prepared(None) == ""
    assert "abc" in langid.prepared("½ ABC")
