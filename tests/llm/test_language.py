"""Language labels against sums over all chains, held-out accuracy and planted changes of language."""

import itertools
import zlib

import duckdb
import numpy as np
import pytest

from gleaner.llm import language

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, score double, n_words long, words string, rank int"


@pytest.fixture(scope="module")
def rows():
    return duckdb.sql(f"select doc_id, text, lang from '{FOLDER}/documents.parquet' order by doc_id").fetchall()


@pytest.fixture(scope="module")
def field(rows):
    known = [(lang, [w.lower() for w in language._WORD.findall(text)][:120]) for i, text, lang in rows if zlib.crc32(str(i).encode()) % 5]
    return language.train(known)


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, 2.0, 3, "w", 1) for i, t, lang in rows], SCHEMA).repartition(3)


def test_equals_sums_over_all_chains():
    rng = np.random.default_rng(2)
    change = rng.normal(size=(3, 3))
    odds_of = language.odds(rng.normal(size=(50, 3)) * 3)
    chains = language.Transfers(change)
    counts = np.array([1, 7, 4])
    words = rng.integers(0, 50, counts.sum()).astype(np.int32)
    monkey, language.BLOCK = language.BLOCK, 3
    try:
        got = np.concatenate([f for _, f in chains.label(words, counts, odds_of)])
    finally:
        language.BLOCK = monkey
    at = 0
    for n in counts.tolist():
        own = odds_of[words[at : at + n]]
        total = np.zeros((n, 3))
        for path in itertools.product(range(3), repeat=n):
            weight = chains.change[:, path[0]].sum() * own[0, path[0]]
            for t in range(1, n):
                weight *= chains.change[path[t - 1], path[t]] * own[t, path[t]]
            total[np.arange(n), path] += weight
        assert got[at : at + n] == pytest.approx(total / total.sum(axis=1, keepdims=True))
        at += n


def test_blocks_change_nothing(field, rows, monkeypatch):
    texts = [t for _, t, _ in rows[:40]] + ["", "one", rows[0][1] * 30]
    whole = field.shares(texts)
    monkeypatch.setattr(language, "AT_ONCE", 5)
    monkeypatch.setattr(language, "BLOCK", 16)
    monkeypatch.setattr(language, "STRETCH", 333)
    again = language.Field(field.names, field.weights, field.change, field.lexicon).shares(texts)
    assert (whole[1] == again[1]).all() and whole[0] == pytest.approx(again[0], abs=1e-9)


def test_features_of_a_word_do_not_depend_on_its_neighbours():
    words = ["a", "abcdefgh", "über", "x" * 500, "\U00010400\U00010401"]
    owner, slots = language.feature_slots(words)
    for i, word in enumerate(words):
        alone = language.feature_slots([word])[1]
        assert sorted(slots[owner == i]) == sorted(alone) and (slots < language.SLOTS).all()


def test_held_out_accuracy(spark, rows):
    found = {r["doc_id"]: r for r in language.language(docs_of(spark, rows)).collect()}
    assert len(found) == len(rows)
    held = [(found[i]["lang_pred"], lang) for i, _, lang in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i, r in found.items() if r["held_out"]} == {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(a == b for a, b in held) >= 0.99 * len(held) > 150
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_change_of_language_is_found(spark, field, rows):
    by_lang = {}
    for i, text, lang in rows:
        if zlib.crc32(str(i).encode()) % 5 == 0 and len(text) > 900:
            by_lang.setdefault(lang, []).append(text[200:500].rsplit(" ", 1)[0].split(" ", 1)[1])
    right = total = 0
    for a, b in itertools.permutations(sorted(by_lang), 2):
        for x, y in zip(by_lang[a][:4], by_lang[b][:4]):
            text = x + " " + y
            spans = field.spans(text)
            assert [s[0] for s in spans] == sorted(s[0] for s in spans) and all(text[s[0] : s[1]].strip() for s in spans)
            for start, end, name in spans:
                right += max(0, min(end, len(x)) - start) if name == a else max(0, end - max(start, len(x) + 1)) if name == b else 0
                total += end - start
    assert right > 0.95 * total > 5000
    [row] = language.language(docs_of(spark, [(1, text, None)]), field, spans=True).collect()
    assert [(s["start"], s["end"], s["lang"]) for s in row["spans"]] == spans


def test_odd_rows(spark, rows):
    long = " ".join(t for _, t, lang in rows if lang == "fr")
    odd = [(2001, None, "en"), (2002, "", "en"), (2003, "12 ²³ Ⅷ !?", "en"), (None, rows[0][1], "en"), (2005, long * 3, None), (2006, "中文 Здра", None)]
    twice = [rows[3]] * 50
    found = language.language(docs_of(spark, rows[:400] + odd + twice)).collect()
    assert len(found) == 456
    by_id = {}
    for r in found:
        by_id.setdefault(r["doc_id"], set()).add((r["lang_pred"], r["score"], r["n_words"], r["held_out"]))
    for i in (2001, 2002, 2003):
        [(name, score, n, _)] = by_id[i]
        assert (name, score, n) == ("und", 0.0, 0)
    assert len(by_id[rows[3][0]]) == 1 and next(iter(by_id[2005]))[0] == "fr" and next(iter(by_id[None]))[3] is False
    assert next(iter(by_id[2006]))[0] in ("de", "en", "es", "fr")


def test_nothing_to_learn_and_empty_table(spark):
    assert language.language(docs_of(spark, [])).count() == 0
    [row] = language.language(docs_of(spark, [(1, "some words", None)])).collect()
    assert (row["lang_pred"], row["score"]) == ("und", 0.0)
    one = language.language(docs_of(spark, [(i, "some words here", "en") for i in range(9)])).collect()
    assert {(r["lang_pred"], round(r["score"], 6)) for r in one} == {("en", 1.0)}


def test_labels_of_held_out_rows_are_not_read(spark, rows):
    some = rows[:300]
    turned = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 5 == 0 else lang) for i, t, lang in some]
    a = {(r["doc_id"], r["lang_pred"], r["score"]) for r in language.language(docs_of(spark, some)).collect()}
    b = {(r["doc_id"], r["lang_pred"], r["score"]) for r in language.language(docs_of(spark, turned)).collect()}
    assert a == b
