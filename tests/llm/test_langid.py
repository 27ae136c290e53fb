import zlib
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from plotcover.llm import langid
from plotcover.llm import queries as q


def test_held_out_accuracy(spark, sf_dir):
    labels = {d: (lang, t) for d, lang, t in
              duckdb.sql(f"select doc_id, lang, text from '{sf_dir}/documents.parquet'").fetchall()}
    rows = q.op4_language_id(spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(labels)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
    hits = [r.lang_pred == labels[r.doc_id][0] for r in rows
            if r.held_out and len(labels[r.doc_id][1]) > 100]
    assert np.mean(hits) > 0.97


def test_und_null_empty_long_repeated_and_clashing_columns(spark):
    train = [(i, f"das ist ein satz und der hund {i}", "de") for i in range(30)] + \
        [(100 + i, f"the dog and this is a sentence {i}", "en") for i in range(30)]
    cases = [(1000, None, None), (1001, "", "en"), (1002, "12 !? ...", "de"),
             (1003, "the dog is this " * 30_000, None), (1004, "das hund", "xx"),
             (1004, "das hund", "xx"), (None, "the and this", None)]
    docs = spark.createDataFrame([r + (0.5,) for r in train + cases],
                                 "doc_id long, text string, lang string, score double")
    model = langid.train(docs.where("lang in ('de', 'en')"))
    rows = langid.identify(docs, model).collect()
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    assert [got[i][0] for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert got[1003][0][0] == "en" and got[None][0][0] == "en"
    assert len(got[1004]) == 2 and len(set(got[1004])) == 1 and got[1004][0][0] == "de"
    assert langid.identify(docs.limit(0), model).collect() == []


def test_no_or_one_language(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    none = langid.train(docs)
    assert none.predict(pa.array(["abc"]))[0] == ["und"]
    one = langid.train(docs.fillna("en"))
    assert [list(x) for x in one.predict(pa.array(["zzz", "1"]))[:2]] == [["en", "und"], [1.0, 0.0]]


@pytest.mark.parametrize("n", [2, 4, 7, 12])
def test_codewords_differ(n):
    code = langid.codewords(n).astype(int)
    apart = (code[:, None, :] != code[None, :, :]).sum(2)
    assert apart[~np.eye(n, dtype=bool)].min() >= (1 if n == 2 else 2)


def test_ambiguity_flag():
    model = langid.Model(["a", "b"], langid.codewords(2), np.zeros((1 << 15, 1), np.float32),
                         np.ones(1), langid.codewords(2).astype(float))
    langs, score, ambiguous = model.predict(pa.array(["some text"]))
    assert langs == ["a"] and score[0] == 0.5 and ambiguous[0]


def naive_grams(text):
    """Hashed n-grams of one text, letter by letter, with the root of their counts."""
    mask, out = (1 << 32) - 1, {}
    line = [0]
    for c in (text or "").lower():
        code = ord(c) if c.isalpha() else 0
        if code or line[-1]:
            line.append(code)
    line = line[1:]
    for i in range(2, len(line)):
        a, b, c = line[i - 2:i + 1]
        pair = (b * 0x9E3779B1 & mask) ^ (c * 0x85EBCA77 & mask)
        for h in ((pair ^ (a * 0xC2B2AE3D & mask)) * 0x27D4EB2F, pair * 0x165667B1):
            out[(h & mask) >> 17] = out.get((h & mask) >> 17, 0) + 1
    return {g: n ** 0.5 for g, n in out.items()}


def test_against_a_naive_predictor(spark, sf_dir):
    rows = [r for r in duckdb.sql(f"select doc_id, lang, text from '{sf_dir}/documents.parquet' order by 1").fetchall()
            if r[2]][:60]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = langid.train(docs)
    langs = sorted({r[1] for r in rows if r[1]})
    share = {lang: {} for lang in langs}
    for _, lang, text in rows:
        for g, w in naive_grams(text).items() if lang else ():
            share[lang][g] = share[lang].get(g, 0) + w
    total = {lang: sum(share[lang].values()) + 0.1 * (1 << 15) for lang in langs}

    def mean_share(side, g):
        return sum((share[x].get(g, 0) + 0.1) / total[x] for x in side) / len(side)

    sides = [([x for x, c in zip(langs, bit) if c > 0], [x for x, c in zip(langs, bit) if c < 0])
             for bit in langid.codewords(len(langs)).T]
    got = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    for doc_id, _, text in rows[:12]:
        grams = naive_grams(text)
        loss = [0.0] * len(langs)
        for (one, zero), trust in zip(sides, model.trust):
            margin = sum(w * np.log(mean_share(one, g) / mean_share(zero, g)) for g, w in grams.items())
            margin /= max(1, sum(grams.values())) ** 0.5
            for i, lang in enumerate(langs):
                loss[i] += trust * np.log1p(np.exp(-margin if lang in one else margin))
        assert got[doc_id].lang_pred == langs[int(np.argmin(loss))]
        score = 1 / sum(np.exp((min(loss) - x) / model.heat) for x in loss)
        assert abs(got[doc_id].score - score) < 1e-3


def test_mixed_texts_are_ambiguous_and_scores_are_calibrated(spark, sf_dir):
    table = Path(sf_dir).parent / "sf0.01" / "documents.parquet"     # enough rows for a rate
    rows = [r for r in duckdb.sql(f"select doc_id, lang, text from '{table}' order by 1").fetchall()
            if r[1] and len(r[2] or "") > 200]
    learn, rest = ([r for r in rows if (zlib.crc32(str(r[0]).encode()) % 3 == 1) == held] for held in (False, True))
    model = langid.train(spark.createDataFrame(learn, "doc_id long, lang string, text string"))
    assert np.mean(model.predict(pa.array([r[2] for r in rest]))[2]) < 0.03
    mixed = []
    for a in rest:
        b = next((r for r in rest if r[1] != a[1] and r[0] > a[0]), None)
        if b:
            one, two = a[2].split(), b[2].split()
            n = min(len(one), len(two))
            mixed.append(" ".join(one[:n] + two[:n]))
    assert np.mean(model.predict(pa.array(mixed))[2]) > 0.7
    # held-out stretches of eight letters: as often right as the scores say
    cuts = [(r[1], r[2][at:at + 8]) for r in rest for at in range(0, 160, 40)]
    langs, score, _ = model.predict(pa.array([c for _, c in cuts]))
    right = np.mean([a == b for a, (b, _) in zip(langs, cuts)])
    assert abs(right - score.mean()) < 0.06, (right, score.mean(), model.heat)


def test_only_texts_without_a_known_language_go(spark):
    train = [(i, "das ist ein satz und der hund", "de") for i in range(9)] + \
        [(10 + i, "the dog and this is a sentence", "en") for i in range(9)]
    docs = spark.createDataFrame(train, "doc_id long, text string, lang string")
    model = langid.train(docs)
    more = spark.createDataFrame([(1, None, "de"), (2, "12 !?", "en"), (3, "der hund and the dog", None)], docs.schema)
    kept = langid.keep_identified(docs.unionByName(more), model)
    assert kept.columns == docs.columns
    assert kept.count() == len(train) + 1 and kept.where("lang is null").count() == 1
