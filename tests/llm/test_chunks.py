from __future__ import annotations

import cases
import numpy as np
import pytest
from compare import rows

from tagloom.llm import chunks


def plain_gear(data):
    out, h = [], 0
    for b in data:
        h = ((h << 4) + int(chunks._GEAR[b])) & 0xFFFFFFFF
        out.append(h)
    return out


def test_gear_is_the_rolling_hash():
    data = cases.prose(3, 200).encode()
    assert chunks.gear(np.frombuffer(data, np.uint8)).tolist() == plain_gear(data)


@pytest.mark.parametrize("text", [r[1] for r in cases.documents()])
def test_chunks_cover_the_words(text):
    cut = chunks.Chunks(text)
    whole = (text or "").encode()
    parts = [whole[a:b] for a, b in zip(cut.first, cut.last)]
    assert [w for p in parts for w in p.split()] == whole.split()
    assert all(p == p.strip() and p for p in parts)
    assert cut.n == len(parts)
    if cut.n:
        assert cut.words.tolist() == [len(p.split()) for p in parts]
        assert cut.words.max() <= chunks.LONGEST


def test_chunks_resist_insertions():
    text = cases.prose(4, 3_000)
    words = text.split(" ")
    moved = " ".join(["new", "words", *words[:1_500], "inserted", *words[1_500:]])
    one, two = set(chunks.Chunks(text).digests().tolist()), set(chunks.Chunks(moved).digests().tolist())
    assert len(one - two) <= 6


def planted(spark, lengths=(51, 60, 80, 200), copies=4):
    rows, passages = [], []
    for p, n in enumerate(lengths * 8):
        passage = cases.prose(900 + p, n, line=10**9)
        passages.append(passage)
        for c in range(copies):
            at = 1000 + p * 10 + c
            rows.append((at, f"{cases.prose(at, 40 + c)} {passage} {cases.prose(20_000 + at, 30 + 7 * c)}"))
    clean = [(i, cases.prose(50_000 + i, 150)) for i in range(40)]
    return spark.createDataFrame([*rows, *clean], "doc_id long, text string"), passages


def test_planted_passages_are_found_and_clean_texts_left_alone(spark):
    df, passages = planted(spark)
    rows = chunks.repeats(df).collect()
    texts = dict(df.collect())
    for r in rows:
        assert texts[r["doc_id"]][r["span_start"] : r["span_end"]] == r["passage"]
        assert len(r["passage"].split()) == r["n_words"] >= chunks.LEAST_WORDS
        assert r["first_doc_id"] < r["doc_id"]
        assert r["passage"].strip() in texts[r["first_doc_id"]]
    found = {r["doc_id"] for r in rows}
    assert found == {1000 + p * 10 + c for p in range(len(passages)) for c in (1, 2, 3)}


def test_cut_texts_hold_a_passage_once(spark):
    df, passages = planted(spark)
    texts = {r["doc_id"]: r["text"] for r in chunks.cut_repeats(df).collect()}
    assert len(texts) == df.count()
    for p, passage in enumerate(passages):
        whole = [i for i, t in texts.items() if passage in t]
        assert whole == [1000 + p * 10]
    before = dict(df.collect())
    assert all(texts[i] == before[i] for i in range(40))


def test_words_said_over_and_over_are_found(spark):
    rows = []
    for period in (1, 2, 3, 5):
        passage = " ".join((["ka", "lo", "mi", "ru", "te"][:period] * 80)[:70])
        for c in (0, 1):
            at = 10 * period + c
            rows.append((at, f"{cases.prose(at, 33 + 8 * c)} {passage} {cases.prose(700 + at, 25 + 6 * c)}"))
    got = chunks.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in got if r["doc_id"] % 10} == {11, 21, 31, 51}
    assert all(r["n_words"] >= 40 for r in got if r["doc_id"] % 10)


def test_awkward_rows(documents, nothing):
    df = cases.clashing(documents)
    cut = chunks.cut_repeats(df)
    assert cut.columns == df.columns and cut.count() == df.count()
    rows = cut.collect()
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append(r)
    assert by_id[1][0]["text"] == cases.documents()[0][1]
    assert by_id[2][0]["text"] == "" and by_id[2][0]["n_chars"] == 0
    assert [r["text"] for r in by_id[3]][0] == [r["text"] for r in by_id[3]][1]
    assert by_id[4][0]["text"] is None and by_id[5][0]["text"] == ""
    assert sorted(r["text"] or "" for r in by_id[None]) == ["", ""]
    assert by_id[8][0]["text"] == dict((r[0], r[1]) for r in cases.documents())[8]
    assert chunks.repeats(nothing).count() == 0 and chunks.cut_repeats(nothing).count() == 0
    assert {r["doc_id"] for r in chunks.repeats(df).collect()} == {2, 3, None}


def test_stock_phrases_of_several_documents_are_no_passage(spark):
    """Twelve chunks that follow each other in document 100 alone, each from another one."""
    text = cases.prose(77, 120, line=10**9)
    cut = chunks.Chunks(text)
    parts = [text.encode()[a:b].decode() for a, b in zip(cut.first, cut.last)]
    # Words that end chunks decide with their neighbours, so each phrase stands between its own.
    rows = [(i, " ".join(parts[max(i - 1, 0) : i + 2])) for i in range(1, len(parts) - 1)]
    rows = [r for r in rows if len(r[1].split()) < chunks.LEAST_WORDS + 8]
    rows.append((100, text))
    held = dict(rows)
    seen = {d for i, t in rows if i < 100 for d in chunks.Chunks(t).digests().tolist()}
    marked = [i for i, d in enumerate(cut.digests().tolist()) if d in seen]
    assert any(w >= 60 for _, _, w, _ in cut.repeats(marked, chunks.LEAST_WORDS))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in chunks.repeats(df).collect():
        assert r["passage"].strip() in held[r["first_doc_id"]]


def brute(rows, least):
    """Chunks of each text that lie in a run of chunks which one earlier text has as well."""
    lists = {i: chunks.Chunks(t) for i, t in rows}
    found = {i: c.digests().tolist() for i, c in lists.items()}
    out = {}
    for i, own in found.items():
        marked = set()
        for j, other in found.items():
            if j >= i:
                continue
            for a in range(len(own)):
                for b in range(len(other)):
                    n = 0
                    while a + n < len(own) and b + n < len(other) and own[a + n] == other[b + n]:
                        n += 1
                    if lists[i].words[a : a + n].sum() >= least:
                        marked |= set(range(a, a + n))
        out[i] = marked
    return out


def test_cut_equals_brute_force_over_neighbouring_chunks(spark):
    rng = np.random.default_rng(5)
    phrases = [cases.prose(300 + i, n, line=10**9) for i, n in enumerate([9, 14, 25, 33, 48, 70, 12, 21])]
    phrases += ["of " * 35, "ka lo mi ru te na " * 9]
    rows = [(i, " ".join(phrases[p].strip() for p in rng.integers(0, len(phrases), 5))) for i in range(24)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r["text"] for r in chunks.cut_repeats(df).collect()}
    spans = chunks.repeats(df).collect()
    texts, want = dict(rows), brute(rows, chunks.LEAST_WORDS)
    for i, text in rows:
        cut = chunks.Chunks(text)
        gone = [(a, b) for a, b, _, _ in cut.repeats(sorted(want[i]), 1)] if want[i] else []
        kept, at = "", 0
        for a, b in gone:
            kept, at = kept + text[at:a], b
        assert got[i] == kept + text[at:]
        covered = {p for r in spans if r["doc_id"] == i for p in range(r["span_start"], r["span_end"])}
        assert covered == {p for a, b in gone for p in range(a, b)}
    for r in spans:
        assert r["passage"].strip() in texts[r["first_doc_id"]] and r["n_words"] >= chunks.LEAST_WORDS


def test_one_word_never_stands_for_a_stretch(spark):
    rows = [(1, f"of {cases.prose(61, 60)}"), (2, f"{cases.prose(62, 40)} {'of ' * 300}{cases.prose(63, 40)}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert chunks.repeats(df).count() == 0
    assert dict(chunks.cut_repeats(df).collect()) == dict(rows)


def test_stretches_are_compared_as_a_whole(spark):
    """What is reported of a stretch is never longer than the stretch of the first document."""
    rows = [(i, f"{cases.prose(70 + i, 40)} {'of ' * n}{cases.prose(80 + i, 40)}") for i, n in enumerate([90, 300, 300])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = chunks.repeats(df).collect()
    assert {r["doc_id"] for r in got} == {1, 2}
    assert all(r["passage"].strip() in rows[r["first_doc_id"]][1] for r in got)
    assert max(r["n_words"] for r in got if r["doc_id"] == 1) >= 50
    assert max(r["n_words"] for r in got if r["doc_id"] == 2) >= 250
    cut = dict(chunks.cut_repeats(df).collect())
    assert [cut[i].split().count("of") < 40 for i in range(3)] == [False, True, True]


def test_repeats_within_a_text_and_between_null_ids(spark):
    one, two, three = (cases.prose(400 + i, 60, line=10**9) for i in range(3))

    def mixed(at, passage):
        return f"{cases.prose(at, 40)} {passage} {cases.prose(at + 1, 35)}"

    rows = [(1, f"{mixed(410, one)} {mixed(420, one)} {mixed(430, one)}"), (2, f"{mixed(440, two)} {'of ' * 300}{mixed(450, one)}")]
    rows += [(None, mixed(460, three)), (None, mixed(470, three)), (5, mixed(480, two + " " + two)), (5, mixed(490, three))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = chunks.repeats(df, within=True).collect()
    pairs = {(r["doc_id"], r["first_doc_id"]) for r in got if r["n_words"] < 200}
    assert pairs == {(1, 1), (2, 1), (5, 2), (None, 5)}
    assert [(r["doc_id"], r["first_doc_id"]) for r in got if r["n_words"] >= 200] == [(2, 2)]
    texts = [r["text"] for r in chunks.cut_repeats(df, within=True).collect()]
    assert len(texts) == len(rows)
    for passage in (one, two, three):
        assert sum(t.count(passage) for t in texts) == 1
    assert 20 <= max(t.count("of of") for t in texts) * 2 <= 40

    alone = spark.createDataFrame([(None, mixed(460, three)), (None, mixed(470, three))], "doc_id long, text string")
    assert [r["first_doc_id"] for r in chunks.repeats(alone, within=True).collect()] == [None]
    assert sum(r["text"].count(three) for r in chunks.cut_repeats(alone, within=True).collect()) == 1


def test_windows_of_one_digest_but_other_words_are_no_repeats(spark, monkeypatch):
    texts = [(i, cases.prose(50 + i, 120)) for i in range(6)] + [(9, cases.prose(50, 120))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    true = rows(chunks.repeats(docs), "doc_id", "span_start", "span_end", "first_doc_id")
    plain = chunks._digest
    # The first half of every digest is the same number.
    monkeypatch.setattr(chunks, "_digest", lambda data, seed=0: bytes(8) + plain(data, seed)[8:])
    assert rows(chunks.repeats(docs), "doc_id", "span_start", "span_end", "first_doc_id") == true
    assert {r[0] for r in true} == {9}
